"""Profiling of raw tables.

What can be counted row by row is one aggregate over all columns: a single scan, no shuffle of
values. Only distinct values and variants need a grouping of (column, value).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.config import NULL_MARKERS
from assay.functions import clean
from assay.functions.names import column_name

#: An issue row: table, column, kind, count, examples, detail.
ISSUE_COLUMNS = ("table_name", "column_name", "issue_type", "issue_count", "example", "detail")

# By these names a column holds identifiers, dates or flags, whatever its values.
TEXT_NAMES = ("_id", "code", "sku", "tax", "phone", "mobile", "tracking", "postal", "zip")
DATE_NAMES = ("date", "time", "_at", "effective", "day")
FLAG_STARTS, FLAG_ENDS = ("is_", "has_"), ("_flag", "_indicator")
#: Types whose texts are never a marker of a missing value.
NO_MARKERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "boolean")
#: Longer values are compared by their digest.
LONG = 64
FLAG_TEXTS = ("true", "false", "yes", "no", "y", "n", "0", "1")


def value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, n): how often each column holds each value, as text; null counts."""
    return cells(df).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def cells(df: DataFrame) -> DataFrame:
    """(column_name, value): every cell, as text."""
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return texts.unpivot([], texts.columns, "column_name", "value")


def _each(df: DataFrame, **measures: Callable[[Column], Column]) -> DataFrame:
    """(column_name, measures): aggregates of every column's text, all in one pass."""
    found = []
    for i, c in enumerate(df.columns):
        text = F.col(f"`{c}`").cast("string")
        found.append(F.struct(F.lit(c).alias("column_name"), *[m(text).alias(k) for k, m in measures.items()]).alias(f"c{i}"))
    return df.agg(*found).select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(found))])))


def with_examples(df: DataFrame, keys: list[str], value: Column, n: Column, most: int) -> DataFrame:
    """(keys, n, example): the sum of n, and the first `most` distinct values in order, joined.

    However many values there are, only those first ones of each group are gathered.
    """
    counted = df.groupBy(*keys, value.alias("__value")).agg(F.sum(n).alias("n"))
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("n"), F.lit(None).cast("string").alias("example"))
    # Not a condition on the value alone, which would be pushed below what counted shares with totals.
    known = counted.where(F.when(F.col("__value").isNotNull(), F.col("n")) >= 0)
    if keys:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("__value"))
        known = known.withColumn("__place", place).where(F.col("__place") <= most)
    else:
        known = known.orderBy("__value").limit(most)
    shown = known.groupBy(*keys).agg(F.lit(0).cast("bigint").alias("n"), clean.examples(F.col("__value"), most).alias("example"))
    return totals.unionByName(shown).groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"), F.coalesce(F.max("example"), F.lit("")).alias("example")
    )


def profile_table(name: str, df: DataFrame) -> DataFrame:
    """One row: rows, columns, null cells, and rows that have an exact copy."""
    nulls = sum((F.col(f"`{c}`").isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    groups = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias("__n"), F.first(nulls).alias("__nulls"))
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        F.coalesce(F.sum("__n"), zero).alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.coalesce(F.sum(F.col("__n") * F.col("__nulls")), zero).alias("real_null_cells"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), zero).alias("duplicate_row_count"),
    ).select(F.lit(name).alias("table_name"), "*")


def profile_columns(df: DataFrame) -> DataFrame:
    """A row for each column: missing values of either kind, and distinct values with and without
    them. Long values are grouped by a digest, so they aren't shuffled."""
    value = F.col("value")
    key = F.when(F.length(value) > LONG, F.sha2(value, 256)).otherwise(value)
    groups = cells(df).groupBy("column_name", key.alias("key"), value.isNull().alias("null"), clean.is_marker(value).alias("marker")).agg(F.count("*").alias("n"))
    rows = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("bigint"))
    missing = F.col("null") | F.col("marker")
    return groups.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        rows(F.col("null")).alias("real_null_count"),
        rows(F.col("marker")).alias("marker_count"),
        rows(missing).alias("missing_count"),
        F.count("*").alias("unique_count"),
        F.count_if(~missing).alias("effective_unique_count"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """(column_name, real_null, marker_null, example) of the columns that miss values."""
    # Of a type that has no markers only nulls are told apart.
    plain = lambda c: F.when(F.col(f"`{c}`").isNotNull(), F.lit("0"))
    texts = df.select(*[plain(c).alias(c) if kind.split("(")[0] in NO_MARKERS else F.col(f"`{c}`").cast("string").alias(c) for c, kind in df.dtypes])
    found = _each(texts, real_null=lambda c: F.count_if(c.isNull()), marker_null=lambda c: F.count_if(clean.is_marker(c)))
    shown = with_examples(cells(texts).where(clean.is_marker(F.col("value"))), ["column_name"], F.col("value"), F.lit(1), 5)
    named = found.where("real_null + marker_null > 0").join(F.broadcast(shown.drop("n")), "column_name", "left")
    return named.select("column_name", "real_null", "marker_null", F.coalesce("example", F.lit("")).alias("example"))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """One row: groups of equal rows and the rows in them; none without such groups."""
    groups = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias("__n")).where("__n > 1")
    return groups.agg(F.count("*").alias("duplicate_group_count"), F.sum("__n").alias("affected_rows")).where("duplicate_group_count > 0")


def text_variants(df: DataFrame) -> DataFrame:
    """Values that differ in case and white space only: a row for each such key of a column."""
    known = value_counts(df).where(~clean.is_missing(F.col("value"))).withColumn("variant_key", clean.match_key(F.col("value")))
    place = F.row_number().over(Window.partitionBy("column_name", "variant_key").orderBy("value"))
    first = F.array_join(F.array_sort(F.collect_list(F.when(F.col("place") <= 10, F.col("value")))), " | ")
    groups = known.withColumn("place", place).groupBy("column_name", "variant_key").agg(
        F.count("*").alias("variant_count"), F.sum("n").alias("affected_rows"), first.alias("variants")
    )
    return groups.where("variant_count > 1")


def whitespace_issues(df: DataFrame) -> DataFrame:
    """(column_name, edge, repeated, control, total) of the columns with stray white space."""
    return _each(
        df,
        edge=lambda c: F.count_if(clean.edge_space(c)),
        repeated=lambda c: F.count_if(clean.repeated_space(c)),
        control=lambda c: F.count_if(clean.control_space(c)),
        total=lambda c: F.count_if(clean.edge_space(c) | clean.repeated_space(c) | clean.control_space(c)),
    ).where("total > 0")


def structure_issues(df: DataFrame) -> DataFrame:
    """(column_name, issue_type) of columns without values or with one value only."""
    known = lambda c: F.when(~clean.is_missing(c), c)
    found = _each(df, least=lambda c: F.min(known(c)), most=lambda c: F.max(known(c)))
    kind = F.when(F.col("least").isNull(), "ALL_MISSING_COLUMN").when(F.col("least") == F.col("most"), "CONSTANT_COLUMN")
    return found.select("column_name", kind.alias("issue_type")).where("issue_type IS NOT NULL")


#: Texts that count as a date or time have one of these characters; a cheap look at how all date shapes begin
#: spares most failures of parsing.
_DATED, _DATE_START, _TIMED = "[-/:T ]", r"^ *\d{1,4}([-/]\d{1,2}[-/]\d|\d{4} *$)", r"\d{1,2}:\d{2}"
#: What can be a number has a digit after signs, brackets and commas.
_NUMERIC = r"^[\s+\-(.,]*\d"


def type_parts(c: Column, key: Column | None = None) -> dict[str, Column]:
    """A text read once as a number and as a timestamp: what the measures of types go by.

    key: the text's match key, where there is a column of it already.
    """
    key = clean.match_key(c) if key is None else key
    return {
        "known": c.isNotNull() & ~key.isin(*NULL_MARKERS), "number": F.when(c.rlike(_NUMERIC), clean.to_decimal(c)),
        "dated": F.coalesce(F.when(c.rlike(_DATE_START) & c.rlike(_DATED), clean.to_timestamp(c)).isNotNull(), F.lit(False)),
        "timed": c.rlike(_TIMED), "flag": (F.length(c) < 64) & key.isin(*FLAG_TEXTS),
    }


def type_tests() -> dict[str, Column]:
    """Whether a text reads as what, over the columns of type_parts()."""
    number, known = F.col("number"), F.col("known")
    tests = {
        "numbers": number.isNotNull(), "integers": (F.floor(number) == number) & number.try_cast("bigint").isNotNull(),
        "dates": F.col("dated"), "times": F.col("dated") & F.col("timed"), "flags": F.col("flag"),
    }
    return {"effective": known} | {n: F.coalesce(known & test, F.lit(False)) for n, test in tests.items()}


def type_evidence(df: DataFrame) -> DataFrame:
    """For each column, in rows that have a value: how many read as what.

    A row is turned to its cells within the task, so that each cell is read once by one piece of
    code for all columns; only counts leave the task.
    """
    cells_ = F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])).alias("place", "value")
    keyed = df.select(cells_).withColumn("key", clean.match_key(F.col("value")))
    read = keyed.select("place", *[part.alias(n) for n, part in type_parts(F.col("value"), F.col("key")).items()])
    read = read.select("place", *[test.alias(n) for n, test in type_tests().items()])
    found = []
    for i, c in enumerate(df.columns):
        counts = [F.count_if((F.col("place") == i) & F.col(n)).alias(n) for n in type_tests()]
        found.append(F.struct(F.lit(c).alias("column_name"), *counts).alias(f"m{i}"))
    return read.agg(*found).select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(found))])))


def infer_type(name: str, evidence: dict) -> str:
    """The logical type that a column's name and evidence speak for."""
    n = evidence["effective"]
    name = column_name(name)
    if not n or any(t in name for t in TEXT_NAMES):
        return "string"
    if (name.startswith(FLAG_STARTS) or name.endswith(FLAG_ENDS)) and evidence["flags"] == n:
        return "boolean"
    dated = "datetime" if evidence["times"] else "date"
    if any(re.search(rf"(^|_){t.strip('_')}(_|$)", name) for t in DATE_NAMES) and evidence["dates"] >= 0.80 * n:
        return dated
    if evidence["numbers"] >= 0.98 * n:
        return "integer" if evidence["integers"] >= 0.98 * n else "decimal"
    return dated if evidence["dates"] >= 0.95 * n else "string"


def suggest_types(df: DataFrame) -> dict[str, str]:
    """Suggested type of every column; one row of evidence a column comes to the driver."""
    return {r["column_name"]: infer_type(r["column_name"], r.asDict()) for r in type_evidence(df).collect()}


def type_proposal(df: DataFrame) -> DataFrame:
    """(column_name, datatype, numeric_ratio, date_ratio) of every column."""
    found = []
    for r in type_evidence(df).collect():  # one row a column
        n = r["effective"]
        found.append((r["column_name"], infer_type(r["column_name"], r.asDict()), r["numbers"] / n if n else 0.0, r["dates"] / n if n else 0.0))
    return df.sparkSession.createDataFrame(found, "column_name string, datatype string, numeric_ratio double, date_ratio double")


def datatype_issues(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column_name, invalid_count, example): values that don't read as the column's type."""
    value = F.col("value")
    bad = F.lit(False)
    for name, datatype in types.items():
        if datatype != "string":
            bad = F.when(F.col("column_name") == name, clean.to_logical(value, datatype).isNull()).otherwise(bad)
    typed = [c for c in df.columns if types.get(c, "string") != "string"]
    if not typed:
        return df.sparkSession.createDataFrame([], "column_name string, invalid_count bigint, example string")
    # Only bad cells are grouped.
    wrong = cells(df.select(*[f"`{c}`" for c in typed])).where(~clean.is_missing(value)).where(bad)
    return with_examples(wrong, ["column_name"], value, F.lit(1), 10).withColumnRenamed("n", "invalid_count")


def all_issues(name: str, df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Every issue of a table in one schema (ISSUE_COLUMNS)."""
    types = suggest_types(df) if types is None else types
    none = F.lit("")

    def issue(found: DataFrame, kind: Column, column: Column, count: Column, example: Column, detail: Column) -> DataFrame:
        return found.select(
            F.lit(name).alias("table_name"), column.alias("column_name"), kind.alias("issue_type"),
            count.cast("bigint").alias("issue_count"), example.alias("example"), detail.alias("detail"),
        )

    column = F.col("column_name")
    parts = [
        issue(missing_values(df), F.lit("MISSING_VALUE"), column, F.expr("real_null + marker_null"), F.col("example"),
              F.concat(F.lit("real_null="), "real_null", F.lit("; marker_null="), "marker_null")),
        issue(exact_duplicates(df), F.lit("EXACT_DUPLICATE"), none, F.col("affected_rows"), none,
              F.concat(F.lit("groups="), "duplicate_group_count")),
        issue(text_variants(df), F.lit("TEXT_VARIANT"), column, F.col("affected_rows"), F.col("variants"),
              F.concat(F.lit("Normalized value: "), "variant_key")),
        issue(whitespace_issues(df), F.lit("WHITESPACE"), column, F.col("total"), none,
              F.concat(F.lit("edge="), "edge", F.lit("; repeated="), "repeated", F.lit("; control="), "control")),
        issue(structure_issues(df), F.col("issue_type"), column, F.lit(1), none, none),
        issue(datatype_issues(df, types), F.lit("DATATYPE_PARSE"), column, F.col("invalid_count"), F.col("example"), none),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
