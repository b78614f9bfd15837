"""Guards before a table is published, and validation of typed tables."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.config import KEY_LENGTH
from assay.functions import clean
from assay.functions.names import is_currency_column
from assay.operators.profile import with_examples
from assay.operators.transform import CLEANED, before_after, target_columns, typed_with_cleaned, without_exact_duplicates
from assay.plans.contract import Contract, TableSpec
from assay.types import LOGICAL

# Codes of the guards.
TARGET_EXISTS, DATATYPE, MISSING_RATE, NOT_NULL, KEY_NULL, KEY_TWICE, KEY_TOO_LONG = (
    "51000", "51001", "51002", "51003", "51004", "51005", "51006",
)
ISSUE = "table_name string, column_name string, issue_type string, issue_count bigint, example string, severity string"


class GuardError(ValueError):
    """Rows that break a contract; nothing was published."""


def too_long(column: str):
    """Longer than a key may be, in UTF-16 code units."""
    return F.octet_length(F.encode(F.col(column), "UTF-16LE")) > 2 * KEY_LENGTH


def row_guards(table: TableSpec) -> list[tuple[str, str, Column]]:
    """(code, column, whether a row breaks it) over transform.typed_with_cleaned()."""
    found = []
    keyed = set(table.primary_key) | {fk.column for fk in table.foreign_keys}
    for c in table.columns:
        if c.datatype != "string":
            found.append((DATATYPE, c.name, F.col(CLEANED + c.name).isNotNull() & F.col(c.name).isNull()))
        elif c.name in keyed:
            found.append((KEY_TOO_LONG, c.name, F.coalesce(too_long(c.name), F.lit(False))))
        if not c.nullable:
            found.append((NOT_NULL, c.name, F.col(c.name).isNull()))
        if c.name in table.primary_key:
            found.append((KEY_NULL, c.name, F.col(c.name).isNull()))
    for c in table.conversions:
        missing = F.col(c.amount_column).isNotNull() & F.col(c.currency_column).isNotNull() & F.col(c.rate_output_column).isNull()
        found.append((MISSING_RATE, c.rate_output_column, missing))
    return found


def repeated_keys(rows: DataFrame, table: TableSpec) -> DataFrame:
    """One row (code, column_name, bad_rows): how many keys of a typed table occur more than once."""
    twice = rows.groupBy(*table.primary_key).agg(F.count("*").alias("n")).where("n > 1")
    return twice.agg(F.lit(KEY_TWICE).alias("code"), F.lit("+".join(table.primary_key)).alias("column_name"), F.count("*").alias("bad_rows"))


def guard_counts(frame: DataFrame, table: TableSpec) -> DataFrame:
    """(code, column_name, bad_rows) of all row guards, counted in one pass over
    transform.typed_with_cleaned(), and of repeated keys in one
    grouping, after exact duplicates go where that is approved."""
    counters = row_guards(table)
    row = frame.agg(*[F.count_if(bad).alias(f"g{i}") for i, (_, _, bad) in enumerate(counters)])
    named = [F.struct(F.lit(code).alias("code"), F.lit(name).alias("column_name"), F.col(f"g{i}").alias("bad_rows")) for i, (code, name, _) in enumerate(counters)]
    out = row.select(F.inline(F.array(*named)))
    if table.primary_key:
        rows = without_exact_duplicates(frame.select(*target_columns(table)), table)
        out = out.unionByName(repeated_keys(rows, table))
    return out


def enforced(frame: DataFrame, table: TableSpec) -> DataFrame:
    """The same rows, but any that breaks a row guard fails the job that reads it."""
    fine = F.lit(True)
    for code, name, bad in reversed(row_guards(table)):
        fine = F.when(bad, F.raise_error(F.lit(f"{code} {table.name}.{name}")).cast("boolean")).otherwise(fine)
    return frame.where(fine)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key, where there is one, isn't in the parent."""
    keys = parent.select(F.col(parent_column).alias("__key")).where("__key IS NOT NULL").distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__key"), "left_anti")


def check(frame: DataFrame, table: TableSpec) -> None:
    """Raise GuardError with every guard that fails."""
    bad = [f"{r.code} {table.name}.{r.column_name}: {r.bad_rows} rows" for r in guard_counts(frame, table).where("bad_rows > 0").toLocalIterator()]
    if bad:
        raise GuardError("\n".join(bad))


def _issue(df: DataFrame, table: str, column: str, kind: str, severity: str = "FAIL", example: str | None = None) -> DataFrame:
    """An issue from a one-column count."""
    return df.select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(kind).alias("issue_type"), F.col("n").cast("bigint").alias("issue_count"),
        (F.col(example) if example else F.lit("")).alias("example"), F.lit(severity).alias("severity"),
    ).where("issue_count > 0")


def _fixed(spark, table: str, column: str, kind: str, severity: str = "FAIL", example: str = "") -> DataFrame:
    return spark.createDataFrame([(table, column, kind, 1, example, severity)], ISSUE)


def nullability(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_rows) of columns that mustn't be null, counted in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.unpivot([], columns, "column_name", "null_rows")


def grouped(df: DataFrame) -> DataFrame:
    """Different rows with how often each occurs (__n).

    All that is validated starts here, so that Spark shuffles a table once and uses that again.
    """
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias("__n"))


def _of(rows: DataFrame, condition: Column) -> DataFrame:
    """Those of grouped() rows that meet a condition, written so that it isn't pushed below the grouping,
    which then would be another one and not used again."""
    return rows.where(F.when(condition, F.col("__n")) > 0)


def duplicate_policy(df: DataFrame, table: TableSpec) -> DataFrame:
    """What exact duplicates mean: accepted if kept, failing if to be fixed or undecided."""
    if table.keeps("EXACT_DUPLICATE"):
        kind, severity = "EXACT_DUPLICATE_ACCEPTED", "WARNING"
    elif table.fixes("EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES"):
        kind, severity = "EXACT_DUPLICATE", "FAIL"
    else:
        kind, severity = "EXACT_DUPLICATE_UNDECIDED", "FAIL"
    groups = grouped(df).where("__n > 1").agg(F.sum("__n").alias("n"))
    return _issue(groups, table.name, "", kind, severity)


def _row_issues(df: DataFrame, table: TableSpec) -> DataFrame | None:
    """Nulls in required columns and in keys, counted together."""
    have = set(df.columns)
    checks = [(c.name, "NON_NULLABLE_HAS_NULL", F.col(c.name).isNull()) for c in table.columns if not c.nullable and c.name in have]
    if key := [k for k in table.primary_key if k in have]:
        checks.append(("+".join(key), "PK_NULL", reduce(or_, [F.col(k).isNull() for k in key])))
    if not checks:
        return None
    zero = F.lit(0).cast("bigint")
    row = grouped(df).agg(*[F.coalesce(F.sum(F.when(bad, F.col("__n"))), zero).alias(f"n{i}") for i, (_, _, bad) in enumerate(checks)])
    issues = [
        F.struct(F.lit(table.name).alias("table_name"), F.lit(column).alias("column_name"), F.lit(kind).alias("issue_type"), F.col(f"n{i}").alias("issue_count"), F.lit("").alias("example"), F.lit("FAIL").alias("severity"))
        for i, (column, kind, _) in enumerate(checks)
    ]
    return row.select(F.inline(F.array(*issues))).where("issue_count > 0")


def reference_issues(df: DataFrame, table: TableSpec, typed: dict[str, DataFrame], contract: Contract) -> list[DataFrame]:
    """What is wrong with a typed table's references; typed: the typed tables by name."""
    spark, have, parts = df.sparkSession, set(df.columns), []
    for fk in table.foreign_keys:
        parent = contract.table(fk.parent_table)
        frame = typed.get(parent.name) if parent else None
        column = parent.column(fk.parent_column) if parent else None
        if frame is None:
            parts.append(_fixed(spark, table.name, fk.column, "FK_PARENT_MISSING", example=fk.parent_table))
        elif not column or column.name not in frame.columns or fk.column not in have:
            parts.append(_fixed(spark, table.name, fk.column, "FK_COLUMN_MISSING", example=f"{fk.parent_table}.{fk.parent_column}"))
        else:
            lost = with_examples(orphans(df, fk.column, frame, column.name), [], F.col(fk.column).cast("string"), F.lit(1), 5)
            parts.append(_issue(lost, table.name, fk.column, "FK_ORPHAN", example="example"))
    return parts


def validate_table(df: DataFrame, table: TableSpec, typed: dict[str, DataFrame], contract: Contract, references: bool = True) -> DataFrame:
    """All issues of a typed table; references: whether those are looked at, too."""
    spark, have = df.sparkSession, set(df.columns)
    parts = [_fixed(spark, table.name, c.name, "MISSING_REQUIRED_COLUMN") for c in table.columns if c.name not in have]
    for c in table.columns:
        if c.name not in have:
            continue
        if df.schema[c.name].dataType != LOGICAL[c.datatype]:
            parts.append(_fixed(spark, table.name, c.name, "DATATYPE_VALIDATION", example=df.schema[c.name].dataType.simpleString()))
        if is_currency_column(c.name):
            wrong = F.col(c.name).isNotNull() & ~clean.is_currency_code(F.col(c.name))
            bad = with_examples(_of(grouped(df), wrong), [], F.col(c.name), F.col("__n"), 5)
            parts.append(_issue(bad, table.name, c.name, "INVALID_CURRENCY_CODE", example="example"))
    if (rows := _row_issues(df, table)) is not None:
        parts.append(rows)
    key = [k for k in table.primary_key if k in have]
    if not table.primary_key and not table.allow_no_primary_key:
        parts.append(_fixed(spark, table.name, "", "NO_REVIEWED_PRIMARY_KEY"))
    if key:
        groups = _of(grouped(df), reduce(and_, [F.col(k).isNotNull() for k in key])).groupBy(*key).agg(F.sum("__n").alias("c")).where("c > 1")
        twice = with_examples(groups, [], F.concat_ws("+", *key), F.col("c"), 5)
        parts.append(_issue(twice, table.name, "+".join(key), "PK_DUPLICATE", example="example"))
    parts += reference_issues(df, table, typed, contract) if references else []
    parts.append(duplicate_policy(df, table))
    return reduce(DataFrame.unionByName, parts)


def validate_all(typed: dict[str, DataFrame], contract: Contract, references: bool = True) -> DataFrame:
    return reduce(DataFrame.unionByName, [validate_table(typed[t.name], t, typed, contract, references) for t in contract.tables if t.name in typed])


def status(issues: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_name, status): FAIL over WARNING over PASS, for each of tables (table_name)."""
    rank = F.max(F.when(F.col("severity") == "FAIL", 2).when(F.col("severity") == "WARNING", 1).otherwise(0))
    worst = issues.groupBy("table_name").agg(rank.alias("r"))
    named = F.when(F.col("r") == 2, "FAIL").when(F.col("r") == 1, "WARNING").otherwise("PASS")
    return tables.join(worst, "table_name", "left").select("table_name", named.alias("status"))


def review(raw: dict[str, DataFrame], contract: Contract, typed: dict[str, DataFrame], rates: DataFrame | None = None) -> DataFrame:
    """The review before sign-off, a row a table: before_after with what validation says.

    raw: by source name; typed: by target name. invalid_after adds up the failing issues' counts.
    """
    counts = reduce(DataFrame.unionByName, [before_after(raw[t.source], t, contract, rates) for t in contract.tables])
    issues = validate_all(typed, contract)
    failing = issues.where("severity = 'FAIL'").groupBy("table_name").agg(F.sum("issue_count").alias("invalid_after"))
    judged = status(issues, counts.select("table_name")).join(failing, "table_name", "left")
    return counts.join(judged, "table_name").withColumn("invalid_after", F.coalesce("invalid_after", F.lit(0).cast("bigint"))).select(
        *counts.columns, "invalid_after", "status"
    )


def summary(reviewed: DataFrame) -> DataFrame:
    """The short form of a review: rows in and out, changed, removed as duplicates, status."""
    removed = (F.col("input_rows") - F.col("output_rows")).alias("removed_duplicates")
    return reviewed.select("table_name", "input_rows", "output_rows", "changed_rows", removed, "status")


def duplicate_report(raw: DataFrame, table: TableSpec, contract: Contract, rates: DataFrame | None = None) -> DataFrame:
    """One row: exact duplicates removed, rows that remain, and of these the rows that share a key
    (never removed)."""
    every = typed_with_cleaned(raw, table, contract, rates).select(*target_columns(table))
    kept = without_exact_duplicates(every, table).groupBy(*table.primary_key).agg(F.count("*").alias("__n"))
    zero = F.lit(0).cast("bigint")
    left = kept.agg(F.coalesce(F.sum("__n"), zero).alias("remaining_rows"), F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), zero).alias("duplicate_key_rows"))
    name = F.lit(table.name).alias("table_name")
    both = raw.agg(F.count("*").alias("input_rows")).select(name, "*").join(left.select(name, "*"), "table_name")
    return both.select("table_name", "input_rows", (F.col("input_rows") - F.col("remaining_rows")).alias("removed_rows"), "remaining_rows", "duplicate_key_rows")


def post_build(typed: dict[str, DataFrame], contract: Contract) -> DataFrame:
    """(table_name, check, subject, n) of published tables: rows, repeated keys, rows without a
    parent; tables and parents that aren't there are left out."""
    parts = []

    def add(counted: DataFrame, table: str, what: str, subject: str) -> None:
        parts.append(counted.select(F.lit(table).alias("table_name"), F.lit(what).alias("check"), F.lit(subject).alias("subject"), F.col("n").cast("bigint").alias("n")))

    for t in contract.tables:
        if (df := typed.get(t.name)) is None:
            continue
        add(df.agg(F.count("*").alias("n")), t.name, "ROWS", "")
        if t.primary_key:
            twice = df.groupBy(*t.primary_key).agg(F.count("*").alias("c")).where("c > 1")
            add(twice.agg(F.count("*").alias("n")), t.name, "REPEATED_KEYS", "+".join(t.primary_key))
        for fk in t.foreign_keys:
            parent = contract.table(fk.parent_table)
            if parent and parent.name in typed:
                lost = orphans(df, fk.column, typed[parent.name], parent.column(fk.parent_column).name)
                add(lost.agg(F.count("*").alias("n")), t.name, "ORPHANS", f"{fk.column} -> {parent.name}")
    return reduce(DataFrame.unionByName, parts)
