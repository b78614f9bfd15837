"""Profiles that grow with their files: a state for each file, merged without reading it again.

Counts add up, extremes and first examples of parts give those of the whole, and distinct values
are sketched (HyperLogLog), as sketches merge, too. A run over a folder that got new files reads
these alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.config import NULL_MARKERS
from assay.functions import clean
from assay.operators.profile import LONG, type_parts, type_tests

#: Examples kept of each kind and column; 2 to this power registers make a sketch's error about 1.6 %.
EXAMPLES, REGISTERS = 5, 12

#: name: aggregate over cells that adds up.
COUNTS = {
    "row_count": "count(*)", "real_null": "count_if(value IS NULL)", "marker_null": "count_if(marker)",
    "edge": "count_if(edge)", "repeated": "count_if(repeated)", "control": "count_if(control)", "stray": "count_if(edge OR repeated OR control)",
}
#: Counts of type_tests().
TYPES = ("effective", "numbers", "integers", "dates", "times", "flags")


def _state(df: DataFrame, by: list[Column]) -> DataFrame:
    """One row for each group and column: counts, extremes, a sketch and first examples of markers.

    One pass: a row is turned to its cells within the task, and each is stripped and keyed once. Cells
    are counted by marker first, so that the few distinct ones are there to choose examples from.
    """
    names = [f"__by{i}" for i in range(len(by))]
    cells = F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])).alias("place", "value")
    value = F.col("value")
    each = df.select(*[b.alias(n) for b, n in zip(by, names)], cells).withColumn("bare", clean.stripped(value))
    each = each.withColumn("key", clean.match_key(F.col("bare"), bare=True))
    each = each.withColumn("marker", F.coalesce(F.col("key").isin(*NULL_MARKERS), F.lit(False)))
    each = each.select(
        *names, "place", "value", "marker", F.when(F.col("marker"), F.substring(value, 1, LONG)).alias("shown"),
        F.coalesce(value != F.col("bare"), F.lit(False)).alias("edge"),
        *[F.coalesce(f(value), F.lit(False)).alias(n) for n, f in (("repeated", clean.repeated_space), ("control", clean.control_space))],
        *[part.alias(n) for n, part in type_parts(value, F.col("key")).items()],
    )
    known = F.when(F.col("known"), value)
    measures = [F.expr(e).alias(n) for n, e in COUNTS.items()]
    measures += [F.count_if(test).alias(n) for n, test in type_tests().items()]
    measures += [
        F.min(known).alias("least"), F.max(known).alias("most"),
        F.hll_sketch_agg(F.xxhash64(known), REGISTERS).alias("sketch"),
    ]
    found = each.groupBy(*names, "place", "shown").agg(*measures)
    first = F.row_number().over(Window.partitionBy(*names, "place").orderBy(F.col("shown").asc_nulls_last()))
    markers = F.array_sort(F.collect_list(F.when(F.col("first") <= EXAMPLES, F.col("shown")))).alias("markers")
    found = found.withColumn("first", first).groupBy(*names, "place").agg(*_sums(), markers)
    column = F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("place") + 1)
    return found.withColumn("column_name", column).select(*names, "column_name", *COUNTS, *TYPES, "least", "most", "sketch", "markers")


def _sums() -> list[Column]:
    """Aggregates that unite states, but for the markers."""
    return [*[F.sum(n).alias(n) for n in [*COUNTS, *TYPES]], F.min("least").alias("least"), F.max("most").alias("most"), F.hll_union_agg("sketch").alias("sketch")]


def profile_state(df: DataFrame) -> DataFrame:
    """The state of a table: one row a column."""
    return _state(df, [])


def merged(states: DataFrame) -> DataFrame:
    """One state from several of the same columns, in whatever parts the rows came."""
    # Few values a file: those that are first in any part.
    markers = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("markers")))), 1, EXAMPLES)
    return states.groupBy("column_name").agg(*_sums(), markers.alias("markers"))


def report(state: DataFrame) -> DataFrame:
    """What a state tells of each column: missing values, stray white space, types, and whether it is
    constant or empty; distinct values by estimate."""
    kind = F.when(F.col("effective") == 0, "ALL_MISSING_COLUMN").when(F.col("least") == F.col("most"), "CONSTANT_COLUMN").otherwise("")
    return state.select(
        "column_name", *COUNTS, *TYPES, kind.alias("issue_type"), F.array_join("markers", " | ").alias("example"),
        F.hll_sketch_estimate("sketch").alias("distinct_estimate"),
    )


def files_state(spark: SparkSession, source: DataFrame, kept: str, form: str = "parquet") -> DataFrame:
    """The merged state of all files (of format form) that a DataFrame reads; their own states are
    kept as a table in the folder `kept`, so that only files without one are read.

    Files are known by name: one that changed under its name is not seen to. States of files that
    are gone stay, but don't count.
    """
    files = sorted(source.inputFiles())
    names = spark.createDataFrame([(f,) for f in files], "file string")
    known = _kept(spark, kept)
    done = {r["file"] for r in known.join(names, "file").select("file").distinct().collect()} if known is not None else set()  # one row a file
    if new := [f for f in files if f not in done]:
        fresh = spark.read.schema(source.schema).format(form).load(new)
        _state(fresh, [F.input_file_name()]).withColumnRenamed("__by0", "file").write.mode("append").parquet(kept)
    return merged(_kept(spark, kept).join(names, "file"))


def _kept(spark: SparkSession, folder: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.parquet(folder) if there else None
