"""Primary and foreign keys: suggestions and their quality."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import clean
from assay.functions.names import column_name
from assay.operators.profile import LONG, NO_MARKERS, cells

# Columns with these words in their names can be part of a composite key.
PART_NAMES = ("date", "snapshot", "line", "sequence")
MOST_PARTS, POOL = 3, 8
#: About how many keys of all combinations together are looked at for two alike.
WITNESSES = 4_000_000
#: About how many rows, taken by chance, are looked at first, which rules out what is far from a key.
GLANCE = 100_000
#: Combinations that one pass looks at.
AT_ONCE = 8
#: Rows that share the values of a combination are kept, for the combinations around it, if they are no more than this.
FEW = 2_000_000
#: Types whose values differ as their texts do.
_PLAIN_KEYS = ("tinyint", "smallint", "int", "bigint", "decimal", "date")


def _digest(c: Column) -> Column:
    """A text, or its digest where it is long, so that no long value is shuffled."""
    return F.when(F.length(c) > LONG, F.sha2(c, 256)).otherwise(c)


def match_keys(df: DataFrame, c: str) -> Column:
    """The match key of a column's texts; those of numbers, dates and flags have no white space to see to."""
    text = F.col(c).cast("string")
    return F.lower(text) if df.select(c).dtypes[0][1].split("(")[0] in NO_MARKERS else clean.match_key(text)


def key_candidates(df: DataFrame) -> DataFrame:
    """(column_name, row_count, missing, distinct_keys) of every column, keys compared stripped
    and in lower case."""
    value = F.col("value")
    keyed = cells(df).groupBy("column_name", _digest(clean.join_key(value)).alias("key")).agg(
        F.count("*").alias("n"), F.count_if(clean.is_missing(value)).alias("missing")
    )
    return keyed.groupBy("column_name").agg(
        F.sum("n").alias("row_count"), F.sum("missing").alias("missing"), F.count("key").alias("distinct_keys")
    )


def _rank(name: str, place: int) -> int:
    plain = column_name(name)
    return 100 * (plain == "id") + 120 * plain.endswith("_id") + 20 * ("line_id" in plain) + max(0, 30 - place)


def composite_counts(df: DataFrame, combos: list[tuple[str, ...]]) -> DataFrame:
    """(combo, distinct_keys, row_count) of combinations of columns, null equal to null.

    Each combination is a grouping of its own columns, so no row is expanded for another's.
    """
    found = None
    for combo in combos:
        groups = df.groupBy(*[f"`{c}`" for c in combo]).agg(F.count("*").alias("__n"))
        one = groups.agg(F.count("*").alias("distinct_keys"), F.coalesce(F.sum("__n"), F.lit(0).cast("bigint")).alias("row_count"))
        one = one.select(F.lit("+".join(combo)).alias("combo"), "*")
        found = one if found is None else found.unionByName(one)
    return found


def _plain(df: DataFrame) -> DataFrame:
    """Columns named by number, so that no name needs care."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])


def _is(df: DataFrame, c: str, kinds: tuple[str, ...]) -> bool:
    return dict(df.dtypes)[c].split("(")[0] in kinds


def _parts(df: DataFrame, combo: tuple[str, ...]) -> list[Column]:
    """What tells rows apart by these columns of df: one column's join key, or several columns' values."""
    columns = [F.col(f"c{df.columns.index(c)}") for c in combo]
    return [clean.join_key(columns[0].cast("string"))] if len(columns) == 1 and not _is(df, combo[0], _PLAIN_KEYS) else columns


def _alike(df: DataFrame, combos: list[tuple[str, ...]], rows: DataFrame, part: int) -> dict[tuple[str, ...], int]:
    """Combinations of which some of the rows are seen to share the values, and how many such rows:
    of each, the rows whose key falls in one of `part` parts of the key space are looked at."""
    looked = []
    for i, combo in enumerate(combos):
        parts = _parts(df, combo)
        name = F.xxhash64(F.lit(1), *parts)
        key = F.struct(F.lit(i).alias("i"), name.alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))
        looked.append(key if part == 1 else F.when(F.pmod(name, F.lit(part)) == 0, key))
    # A few at a time: Java doesn't compile the code of very many.
    several = [rows.select(F.explode(F.array(*looked[i : i + AT_ONCE])).alias("k")) for i in range(0, len(looked), AT_ONCE)]
    keys = reduce(DataFrame.unionAll, several).where("k IS NOT NULL").select("k.*")
    twice = keys.groupBy("i", "a", "b").agg(F.count("*").alias("n")).where("n > 1")
    return {combos[r["i"]]: r["n"] for r in twice.groupBy("i").agg(F.sum("n").alias("n")).collect()}  # at most one row a combination


def _disproved(df: DataFrame, combos: list[tuple[str, ...]], rows: int) -> dict[tuple[str, ...], int | None]:
    """What disproved() finds, with about how many rows share their values; None: very many."""
    plain = _plain(df)
    gone: dict[tuple[str, ...], int | None] = {}
    if combos and rows > 4 * GLANCE:
        some = plain.where(F.rand(1) < GLANCE / rows).persist()
        gone = dict.fromkeys(_alike(df, combos, some, 1))
        some.unpersist()
    if left := [c for c in combos if c not in gone]:
        part = max(1, rows * len(left) // WITNESSES)
        gone |= {c: n * part for c, n in _alike(df, left, plain, part).items()}
    return gone


def disproved(df: DataFrame, combos: list[tuple[str, ...]], rows: int) -> list[tuple[str, ...]]:
    """Combinations of which two rows are seen to share the values: surely no keys.

    A glance at some rows rules out most; one pass looks at the others: of each, the rows whose key
    falls in one of many parts of the key space (all rows of a small table), so what is shuffled is
    bounded. A combination that isn't disproved may still be none; is_unique() tells.
    """
    return list(_disproved(df, combos, rows))


def _twice(df: DataFrame, combo: tuple[str, ...]) -> DataFrame:
    """(h): hashes of keys that two rows or more have; keys with no such hash are surely distinct."""
    return _plain(df).select(F.xxhash64(*_parts(df, combo)).alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")


def _hashed_among(df: DataFrame, combo: tuple[str, ...], hashes: DataFrame) -> DataFrame:
    """The rows, columns named by number, whose key's hash is one of a few."""
    return _plain(df).withColumn("h", F.xxhash64(*_parts(df, combo))).join(F.broadcast(hashes), "h", "left_semi").drop("h")


def _none_twice(rows: DataFrame, df: DataFrame, combo: tuple[str, ...]) -> bool:
    """Whether none of the rows, columns named by number, share the values, compared as they are."""
    parts = [p.alias(f"k{i}") for i, p in enumerate(_parts(df, combo))]
    return rows.select(*parts).groupBy(*[f"k{i}" for i in range(len(parts))]).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def is_unique(df: DataFrame, combo: tuple[str, ...]) -> bool:
    """Whether no two rows share these columns' values (of one column: its join keys), counted exactly.

    Hashes are counted; where two rows have the same, their values decide.
    """
    twice = _twice(df, combo).persist()
    try:
        if not twice.count():
            return True
        if not _none_twice(_hashed_among(df, combo, twice.limit(1000)), df, combo):
            return False
        return _none_twice(_plain(df), df, combo)
    finally:
        twice.unpersist()


def complete_columns(df: DataFrame) -> tuple[int, list[str]]:
    """Rows, and the columns without a missing value, from one pass."""
    plain = _plain(df)
    missing = [F.col(f"c{i}").isNull() if _is(df, c, NO_MARKERS) else clean.is_missing(F.col(f"c{i}").cast("string")) for i, c in enumerate(df.columns)]
    row = plain.agg(F.count("*").alias("n"), *[F.count_if(m).alias(f"c{i}") for i, m in enumerate(missing)]).first()
    return row["n"], [c for i, c in enumerate(df.columns) if not row[f"c{i}"]]


def _first_unique(df: DataFrame, combos: list[tuple[str, ...]], rows: int) -> tuple[str, ...] | None:
    """The first combination in order that is unique: those before it are all proven not to be."""
    gone = set(disproved(df, combos, rows))
    return next((c for c in combos if c not in gone and is_unique(df, c)), None)


def minimal_keys(df: DataFrame, columns: list[str] | None = None, most_parts: int = MOST_PARTS) -> list[tuple[str, ...]]:
    """All combinations of up to most_parts columns without missing values that are unique and of
    which no smaller one is: level by level, leaving out what holds a key already.

    Rows that share the values of a combination share those of all within it. So where few rows
    share a smaller combination's values, these rows alone are asked about all that hold it.
    """
    rows, complete = complete_columns(df)
    pool = [c for c in (columns or df.columns) if c in complete]
    found: list[tuple[str, ...]] = []
    about: dict[tuple[str, ...], int | None] = {}
    few: dict[tuple[str, ...], tuple[DataFrame, int]] = {}

    def keep(combo: tuple[str, ...]) -> int:
        """How many hashes repeat; the rows that have them are kept if they are few."""
        twice = _twice(df, combo).persist()
        if (n := twice.count()) <= FEW // 2:
            kept = _hashed_among(df, combo, twice).persist()
            few[combo] = kept, kept.count()
        about[combo] = few[combo][1] if combo in few else None
        twice.unpersist()
        return n

    def unique(combo: tuple[str, ...]) -> bool:
        within = [s for n in range(1, len(combo)) for s in combinations(combo, n)]
        if not any(s in few for s in within):
            near = [s for s in within if about.get(s) is not None and about[s] <= FEW]
            if near:
                keep(min(near, key=about.get))
        if known := [s for s in within if s in few]:
            return _none_twice(few[min(known, key=lambda s: few[s][1])][0], df, combo)
        return not keep(combo) or (_none_twice(few[combo][0], df, combo) if combo in few else is_unique(df, combo))

    try:
        for size in range(1, most_parts + 1):
            combos = [c for c in combinations(pool, size) if not any(set(k) <= set(c) for k in found)]
            gone = _disproved(df, combos, rows)
            about |= gone
            found += [c for c in combos if c not in gone and unique(c)]
        return found
    finally:
        for kept, _ in few.values():
            kept.unpersist()


def suggest_primary_key(df: DataFrame) -> list[str]:
    """The best unique column without missing values; else the first unique pair, then triple.

    Nothing is ruled out by an estimate: a combination goes only when two rows are seen to share
    its values, and the one that is taken was counted exactly.
    """
    rows, complete = complete_columns(df)
    place = df.columns.index
    singles = sorted(complete, key=lambda c: (-_rank(c, place(c)), place(c)))
    if found := _first_unique(df, [(c,) for c in singles], rows):
        return list(found)
    pool = [c for c in complete if column_name(c).endswith("_id") or any(p in column_name(c) for p in PART_NAMES)][:POOL]
    for size in range(2, MOST_PARTS + 1):
        if found := _first_unique(df, list(combinations(pool, size)), rows):
            return list(found)
    return []


def key_quality(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows with a missing part, duplicate groups and rows, groups equal but for case
    and edges, and OK or REVIEW_PK.

    Numbers and dates are compared as they are: their texts differ as they do. Only with texts in
    the key are groups grouped again.
    """
    missing = F.lit(False)
    for c in key:
        missing = missing | (F.col(c).isNull() if _is(df, c, NO_MARKERS) else clean.is_missing(F.col(c).cast("string")))
    groups = df.select(*key, missing.alias("__missing")).groupBy(*key).agg(F.count("*").alias("n"), F.count_if("__missing").alias("m"))
    repeated = F.col("n") > 1
    if all(_is(df, c, _PLAIN_KEYS) for c in key):
        loose = groups.select("m", repeated.cast("bigint").alias("g"), F.when(repeated, F.col("n")).otherwise(0).alias("r"), "n")
    else:
        loose = groups.groupBy(*[F.col(c) if _is(df, c, _PLAIN_KEYS) else clean.join_key(F.col(c).cast("string")).alias(c) for c in key]).agg(
            F.sum("m").alias("m"), F.count_if(repeated).alias("g"), F.sum(F.when(repeated, F.col("n")).otherwise(0)).alias("r"), F.sum("n").alias("n")
        )
    zero = F.lit(0).cast("bigint")
    out = loose.agg(
        F.coalesce(F.sum("m"), zero).alias("missing_rows"), F.coalesce(F.sum("g"), zero).alias("duplicate_groups"),
        F.coalesce(F.sum("r"), zero).alias("duplicate_rows"), F.count_if(F.col("n") > 1).alias("normalized_duplicate_groups"),
    )
    clear = F.expr("missing_rows + duplicate_groups + normalized_duplicate_groups = 0")
    return out.select(F.lit(" + ".join(key)).alias("primary_key"), "*", F.when(clear, "OK").otherwise("REVIEW_PK").alias("status"))


def duplicate_key_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """All rows whose key occurs more than once, with the number of its rows; nulls are equal.

    Keys are counted first, so rows of one key needn't meet in one task.
    """
    groups = df.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.count("*").alias("key_rows")).where("key_rows > 1")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])
    return df.join(groups, same).drop(*[f"__{k}" for k in key])


def match_rate(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """One row: child rows with a key, how many find it in the parent, and the share."""
    rows = child.select(match_keys(child, child_col).alias("k")).where("k <> ''").groupBy("k").agg(F.count("*").alias("n"))
    parents = parent.select(match_keys(parent, parent_col).alias("p")).where("p <> ''").distinct()
    zero = F.lit(0).cast("bigint")
    out = rows.join(parents, F.col("k") == F.col("p"), "left").agg(
        F.coalesce(F.sum("n"), zero).alias("total_rows"), F.coalesce(F.sum(F.when(F.col("p").isNotNull(), F.col("n"))), zero).alias("matched_rows")
    )
    return out.withColumn("match_rate", F.coalesce(F.try_divide("matched_rows", "total_rows"), F.lit(0.0)))


def propose_foreign_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]], least_rate: float = 0.80) -> list[tuple]:
    """(child table, column, parent table, column, rate) of the best parent of each `_id` column.

    A parent has a single-column key of the same normalised name; all candidates are measured in
    one query, one row each.
    """
    found = None
    for child, df in tables.items():
        for c in df.columns:
            for parent, key in keys.items():
                if parent == child or len(key) != 1 or not column_name(c).endswith("_id") or column_name(key[0]) != column_name(c):
                    continue
                one = match_rate(df, f"`{c}`", tables[parent], f"`{key[0]}`").select(
                    F.lit(child).alias("t"), F.lit(c).alias("c"), F.lit(parent).alias("p"), F.lit(key[0]).alias("pc"), "*"
                )
                found = one if found is None else found.unionByName(one)
    best: dict[tuple[str, str], tuple] = {}
    for r in found.where(F.col("match_rate") >= least_rate).toLocalIterator() if found is not None else ():
        rank = (r["match_rate"], r["matched_rows"])
        if (r["t"], r["c"]) not in best or rank > best[r["t"], r["c"]][0]:
            best[r["t"], r["c"]] = (rank, (r["t"], r["c"], r["p"], r["pc"], r["match_rate"]))
    return [row for _, row in best.values()]
