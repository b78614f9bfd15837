"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import row_hash, saved, unused

WEIGHTS = (5, 2, 1)
#: No source and no document is used more often than this.
MOST_TIMES = 3
#: Tokens of one slot of the schedule.
BLOCK = 1024
#: Fraction of the golden ratio: its multiples' fractions are spread evenly.
GOLDEN = 0.6180339887498949
#: Digits of the shuffling hash by which a source's running sums are split between tasks.
SPLIT = 3
CHUNK = 1 << 16


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, place, target) for rows of (source, size): one row per source.

    Sources in code-point order, null last, weigh 5, 2, 1, repeating. Targets share all sizes
    by weight but stop at three times the source's size; the excess goes to the others by
    weight. Sorted by cap over weight, the capped sources come first, so the common level is
    that of the first source it doesn't reach. Windows here see one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    totals = totals.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(MOST_TIMES))
    everything = Window.partitionBy(F.lit(0))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    totals = totals.withColumn("level", level)
    free = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    common = F.first(free, ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.coalesce(F.least("cap", F.col("common") * F.col("weight")), F.col("cap"))
    return totals.withColumn("common", common).select("source", "source_size", "place", target.alias("target"))


def slots(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, place, k): the schedule; slot n goes to the source in whose share of the
    cumulative targets the fraction of n times the golden ratio falls, as its k-th slot.

    A source that no point hits gets one slot at the end. Points meet sources by the cell of
    the unit interval that they share, not by comparing all with all.
    """
    spark = targets.sparkSession
    total, cells = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.count("*")).first()
    number = max(1, -(-int(total) // block)) if total else 0
    cells = max(1024, 4 * cells)
    share = F.col("target") / F.lit(total or 1.0)
    order = Window.partitionBy(F.lit(0)).orderBy("place")
    ends = targets.where("target > 0").select("place", F.sum(share).over(order).alias("hi")).withColumn(
        "lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0))
    ).withColumn("hi", F.when(F.lead("hi").over(order).isNull(), F.lit(2.0)).otherwise(F.col("hi")))
    cell = F.explode(F.sequence(F.floor(F.col("lo") * cells).cast("int"), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)).cast("int")))
    ranges = ends.withColumn("cell", cell)
    turns = F.col("id") * F.lit(GOLDEN)
    points = spark.range(number).select(F.col("id").alias("slot"), (turns - F.floor(turns)).alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * cells).cast("int"))
    met = points.join(ranges, (points.cell == ranges.cell) & (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("slot", "place")
    missed = ends.join(met.select("place").distinct(), "place", "left_anti").select((F.lit(number) + F.col("place")).cast("bigint").alias("slot"), "place")
    met = met.unionByName(missed).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = met.groupBy("place", "chunk").agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("place", "chunk").orderBy("slot")) - 1
    ranked = met.withColumn("own", own).join(counts.withColumn("earlier", earlier).drop("n"), ["place", "chunk"])
    return ranked.select("slot", "place", (F.col("own") + F.col("earlier")).cast("bigint").alias("k"))


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """(doc_id, source, size, part, at, start): every row's place in its source's shuffled tokens. What row_col holds is kept as `row`.

    Sources are shuffled by MD5 of the id, rows without one by MD5 of the text, so that they don't
    all meet in one task; rows that tie are alike or ordered by size. Running
    sums go by source and leading hash digits, then over the digits' totals, so no task holds
    a whole source.
    """
    size = F.coalesce(F.regexp_count("text", F.lit("[^ \t-\r]+")), F.lit(0)).cast("bigint")
    row = ["row"] if row_col else []
    own = [F.col(row_col).alias("row")] if row_col else []
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"), *own)
    sized = sized.select("doc_id", "source", size.alias("size"), *row, F.md5(F.coalesce(F.col("doc_id").cast("string"), "text", F.lit("")).cast("binary")).alias("h"))
    sized = sized.withColumn("part", F.substring("h", 1, SPLIT))
    rows = Window.partitionBy("source", "part").orderBy("h", "size")
    inner = sized.withColumn("at", F.row_number().over(rows)).withColumn(
        "inner", F.sum("size").over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    )
    inner = saved(inner.drop("h"))
    parts = inner.groupBy("source", "part").agg(F.sum("size").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), before.alias("before"))
    return inner.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "source", "size", "part", "at", (F.col("inner") + F.col("before")).alias("start"), *row
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, row_col: str | None = None
) -> DataFrame:
    """The mix as pieces: each row of docs with the slots that take tokens of it.

    Columns doc_id, source, size, source_size, target, part, at (these two name the row), slot,
    first, tokens; a row that no slot takes appears once with a null slot and 0 tokens. A
    source's k-th slot takes the k-th of equal blocks (within one token) of its rounded target
    from its shuffled tokens, which start again from the beginning when used up.

    Null texts have size 0; a null source is a source of its own, last in order; rows with a
    null id are shuffled like the rest; repeated rows are each placed. With no words at all
    every target is 0. An empty table gives an empty result; other columns are ignored, but for
    row_col, which is kept as `row`.
    """
    rows = saved(placed(docs, id_col, text_col, source_col, row_col))
    targets = saved(source_targets(rows.select("source", "size")))
    schedule = saved(slots(targets, block))
    used = schedule.groupBy("place").agg(F.count("*").alias("n_slots"))
    known = targets.join(used, "place", "left").select(
        F.col("source").alias("s"), "place", "source_size", "target", F.round("target").cast("bigint").alias("t"), F.coalesce("n_slots", F.lit(1)).alias("n")
    )
    known = known.withColumn("b", F.expr("t div n")).withColumn("longer", F.col("t") % F.col("n"))
    frame = rows.join(known, F.col("source").eqNullSafe(F.col("s")))
    rounds = F.explode_outer(F.filter(F.sequence(F.lit(0), F.lit(MOST_TIMES)), lambda j: (F.col("size") > 0) & (F.col("start") + j * F.col("source_size") < F.col("t"))))
    frame = frame.withColumn("round", rounds).withColumn("lo", F.col("start") + F.col("round") * F.col("source_size"))
    frame = frame.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("t")))
    slot_of = "CASE WHEN {p} < longer * (b + 1) THEN {p} div (b + 1) ELSE longer + ({p} - longer * (b + 1)) div greatest(b, 1) END"
    first, last = F.expr(slot_of.format(p="lo")), F.expr(slot_of.format(p="(hi - 1)"))
    frame = frame.withColumn("k", F.explode_outer(F.when(F.col("round").isNotNull(), F.sequence(first, last))))
    begins = F.col("k") * F.col("b") + F.least("k", "longer")
    ends = begins + F.col("b") + F.when(F.col("k") < F.col("longer"), 1).otherwise(0)
    frame = frame.withColumn("from", F.greatest("lo", begins)).withColumn("tokens", F.coalesce(F.least("hi", ends) - F.col("from"), F.lit(0)))
    return frame.join(schedule, ["place", "k"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "part", "at", "slot",
        (F.col("from") - F.col("lo")).alias("first"), "tokens", *(["row"] if row_col else []),
    )


def taken(pieces: DataFrame) -> DataFrame:
    """One row per document row of a mix: how many of its tokens the slots take.

    Rows with null ids or sources and repeated rows each give a row, known by their place in the
    shuffle; an empty mix gives an empty result.
    """
    row = ["source", "part", "at", "doc_id", "size", "source_size", "target"]
    total = F.sum(F.when(F.col("slot").isNotNull(), F.col("tokens")).otherwise(0)).alias("taken")
    return pieces.groupBy(*row).agg(total).select("doc_id", "source", "size", "source_size", "target", "taken")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """The mix as documents: each row of docs, texts and all other columns kept, with what the mix takes of it.

    Columns doc_id, source, size, source_size, target, taken as in taken(), then pieces: structs (slot, first,
    tokens) by slot, of which the schedule puts `tokens` words from word `first` on into `slot`. Then the
    other columns of docs; one with a name of those before gets "_" behind its own. A row that no slot takes has 0
    and no pieces. Repeated rows each have a place: which of them has which is open, as they are alike.
    An empty table gives an empty result. Each text is shuffled once; repeated rows meet in one task.
    """
    row, copy, found = (unused(docs, n) for n in ("__row", "__copy", "__mixed"))
    marked = docs.withColumn(row, row_hash(F.col(id_col), F.col(source_col).cast("string"), F.col(text_col).cast("string")))
    pieces = mix(marked, id_col, text_col, source_col, block, row)
    there = F.col("slot").isNotNull()
    each = pieces.groupBy("row", "part", "at", "size", "source_size", "target").agg(
        F.sum(F.when(there, F.col("tokens")).otherwise(0)).alias("taken"), F.array_sort(F.collect_list(F.when(there, F.struct("slot", "first", "tokens")))).alias("pieces")
    )
    own = ("size", "source_size", "target", "taken", "pieces")
    mixed = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("part", "at", *own))).alias("places"))
    numbered = marked.withColumn(copy, F.row_number().over(Window.partitionBy(row).orderBy(row)))
    joined = numbered.join(mixed.select(F.col("row").alias(row), F.col("places").alias(found)), row)
    place = F.col(found)[F.col(copy) - 1]
    columns = [F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), *[place[n].alias(n) for n in own]]
    names = {"doc_id", "source", *own}
    others = [c for c in docs.columns if c not in (id_col, source_col)]
    for column in others:
        name = column
        while name.lower() in names or name != column and name.lower() in {c.lower() for c in others}:
            name += "_"
        names.add(name.lower())
        columns.append(F.col(f"`{column}`").alias(name))
    return joined.select(*columns)
