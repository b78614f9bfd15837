"""Reviews as DataFrames: what is wrong with a schema review and with decisions, found by Spark.

contract.compile_contract() does this on the driver for the review of one set of tables, and goes
on to the contract itself. Here a review may have a row for each column of every table of a large
lake; the errors, in the same words, are rows of a result.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.config import DECISIONS
from assay.plans.contract import DECISION_FIELDS, FIX_ACTIONS, SCHEMA_FIELDS
from assay.types import ALIASES, LOGICAL

_TRUE, _FALSE = ("true", "1", "yes", "y"), ("false", "0", "no", "n", "")


def _clean(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """The fields as trimmed texts, null as an empty one; ValueError names those that aren't there."""
    if absent := [f for f in fields if f not in df.columns]:
        raise ValueError(f"no column {', '.join(absent)}")
    return df.select(*[F.coalesce(F.regexp_replace(F.col(f).cast("string"), r"(?U)^\s+|\s+$", ""), F.lit("")).alias(f) for f in fields])


def logical_type(c: Column) -> Column:
    """Canonical name of a logical type, null if it is none."""
    key = F.lower(F.trim(c))
    named = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    key = F.coalesce(F.try_element_at(named, key), key)
    return F.when(key.isin(*LOGICAL), key)


def flag(c: Column) -> Column:
    """A flag's text as a boolean; null if it is neither true nor false."""
    key = F.lower(c)
    return F.when(key.isin(*_TRUE), True).when(key.isin(*_FALSE), False)


def position(c: Column) -> Column:
    """A position from 1 on, written with or without a fraction; null if it is none."""
    number = F.when(c.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$"), c.try_cast("double"))
    return F.when(F.floor(number) >= 1, F.floor(number).cast("bigint"))


def _error(rows: DataFrame, where: Column, *text: Column | str) -> DataFrame:
    parts = [F.lit(t) if isinstance(t, str) else t for t in text]
    return rows.select(F.col("table_name"), F.concat(where, F.lit(": "), *parts).alias("error"))


def _quote(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def _listed(c: Column) -> Column:
    return F.array_join(F.sort_array(c), ", ")


def schema_errors(review: DataFrame) -> DataFrame:
    """(table_name, error) of a schema review, a row a column: unknown types, flags and positions,
    blank names, references that aren't one or lead nowhere, columns twice, tables without a key or
    of two minds.

    Names are compared whatever their case where one column is looked up by another's reference.
    Nulls count as empty texts; an empty review has no error. Rows of one table are grouped, never
    gathered whole: what is gathered are the names that are wrong.
    """
    r = _clean(review, SCHEMA_FIELDS)
    col, empty = F.col, F.lit("")
    where = F.concat(col("table_name"), F.lit("."), col("source_column"))
    table = col("table_name")
    parts = [_error(r.where("source_column = '' OR column_name = ''"), where, "blank column name")]
    parts.append(_error(r.where(logical_type(col("datatype")).isNull()), where, "unknown data type ", _quote(col("datatype"))))
    for name, at in (("nullable", where), ("is_pk", where), ("is_fk", where)):
        parts.append(_error(r.where(flag(col(name)).isNull()), at, f"{name}: ", _quote(col(name)), " is neither true nor false"))
    parts.append(_error(r.where(flag(col("allow_no_primary_key")).isNull()), table, "allow_no_primary_key: ", _quote(col("allow_no_primary_key")), " is neither true nor false"))
    keyed = r.where(F.coalesce(flag(col("is_pk")), F.lit(False)))
    parts.append(_error(keyed.where("pk_order <> ''").where(position(col("pk_order")).isNull()), where, "pk_order: ", _quote(col("pk_order")), " is no position"))
    refers = F.coalesce(flag(col("is_fk")), F.lit(False))
    parts.append(_error(r.where(refers != (col("fk_reference") != empty)), where, "is_fk and fk_reference disagree"))
    named = r.where(refers & (col("fk_reference") != empty)).withColumn("parent", F.regexp_extract("fk_reference", r"^(.+)\.([^.]+)$", 1)).withColumn("parent_column", F.regexp_extract("fk_reference", r"^(.+)\.([^.]+)$", 2))
    parts.append(_error(named.where("parent = ''"), where, "fk_reference ", _quote(col("fk_reference")), " isn't table.column"))
    # Of a parent, its source and target name count, and so do both names of its column.
    targets = r.select(
        F.explode(F.array(F.lower("table_name"), F.lower("silver_table_name"))).alias("p"), F.lower("source_column").alias("s"), F.lower("column_name").alias("t")
    ).select("p", F.explode(F.array("s", "t")).alias("pc")).distinct()
    lost = named.where("parent <> ''").join(targets, (F.lower(col("parent")) == col("p")) & (F.lower(col("parent_column")) == col("pc")), "left_anti")
    parts.append(_error(lost, where, "no ", col("parent"), ".", col("parent_column")))
    for what, column in (("source", "source_column"), ("target", "column_name")):
        twice = r.where(col(column) != empty).groupBy("table_name", column).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(_error(twice.groupBy("table_name").agg(F.collect_list(column).alias("x")), table, f"{what} columns twice: ", _listed(col("x"))))
    names = r.groupBy("table_name", "silver_table_name").agg(F.count("*").alias("n")).groupBy("table_name").agg(F.collect_list("silver_table_name").alias("x"))
    quoted = F.concat(F.lit("["), F.array_join(F.transform(F.sort_array("x"), _quote), ", "), F.lit("]"))
    parts.append(_error(names.where((F.size("x") != 1) | (col("x")[0] == empty)), table, "needs one target name, has ", quoted))
    keyless = F.coalesce(flag(col("allow_no_primary_key")), F.lit(False))
    tables = r.groupBy("table_name").agg(
        F.count_if(F.coalesce(flag(col("is_pk")), F.lit(False))).alias("keys"), F.bool_or(keyless).alias("any"), F.bool_and(keyless).alias("every")
    )
    parts.append(_error(tables.where("any <> every"), table, "allow_no_primary_key differs between rows"))
    parts.append(_error(tables.where("keys = 0 AND NOT every"), table, "no primary key, and none isn't allowed"))
    return reduce(DataFrame.unionByName, parts)


def relationships(review: DataFrame) -> DataFrame:
    """(table_name, column_name, parent_table, parent_column) of every reference that leads
    somewhere, by target names."""
    r = _clean(review, SCHEMA_FIELDS)
    named = r.where(F.coalesce(flag(F.col("is_fk")), F.lit(False))).select(
        F.col("silver_table_name").alias("table_name"), "column_name", F.lower(F.regexp_extract("fk_reference", r"^(.+)\.([^.]+)$", 1)).alias("p"), F.lower(F.regexp_extract("fk_reference", r"^(.+)\.([^.]+)$", 2)).alias("pc")
    )
    columns = r.select("silver_table_name", F.col("column_name").alias("parent_column"), F.explode(F.array_distinct(F.array(F.lower("table_name"), F.lower("silver_table_name")))).alias("p"), F.array_distinct(F.array(F.lower("source_column"), F.lower("column_name"))).alias("names"))
    columns = columns.select(F.col("silver_table_name").alias("parent_table"), "parent_column", "p", F.explode("names").alias("pc"))
    return named.join(columns, ["p", "pc"]).select("table_name", "column_name", "parent_table", "parent_column").distinct()


def decision_errors(decisions: DataFrame, review: DataFrame) -> DataFrame:
    """(table_name, error) of decisions on issues: of unknown tables or columns, without a verdict, with
    unknown actions, or kept or blocked without a reason. Nulls count as empty texts."""
    r = _clean(review, SCHEMA_FIELDS)
    d = _clean(decisions, DECISION_FIELDS).withColumn("verdict", F.upper("decision"))
    d = d.withColumn("did", F.when(F.col("action") != "", F.upper("action")).otherwise(F.upper("suggested_action")))
    either = lambda *c: F.explode(F.array_distinct(F.array(*[F.lower(x) for x in c])))
    tables = r.select(either("table_name", "silver_table_name").alias("t")).distinct().withColumn("known", F.lit(True))
    columns = r.select(either("table_name", "silver_table_name").alias("t"), F.array_distinct(F.array(F.lower("source_column"), F.lower("column_name"))).alias("names"))
    columns = columns.select("t", F.explode("names").alias("c")).distinct().withColumn("there", F.lit(True))
    d = d.withColumn("t", F.lower("table_name")).withColumn("c", F.lower("column_name")).join(tables, "t", "left").join(columns, ["t", "c"], "left")
    where = F.concat(F.lit("decision "), F.col("issue_id"), F.lit(" ("), F.col("table_name"), F.lit("."), F.col("column_name"), F.lit(" "), F.col("issue_type"), F.lit(")"))
    own = d.where("known")
    no_reason = (F.col("verdict") != "FIX") & (F.col("reason") == "")
    return reduce(DataFrame.unionByName, [
        _error(d.where("known IS NULL"), where, "unknown table"), _error(own.where("column_name <> '' AND there IS NULL"), where, "unknown column"),
        _error(own.where(~F.col("verdict").isin(*DECISIONS)), where, "decision ", _quote(F.col("decision")), f" is none of {', '.join(DECISIONS)}"),
        _error(own.where((F.col("verdict") == "FIX") & ~F.col("did").isin(*FIX_ACTIONS)), where, "unknown action ", _quote(F.col("did"))),
        _error(own.where(no_reason), where, F.col("verdict"), " needs a reason"),
    ])


def blocking(decisions: DataFrame) -> DataFrame:
    """(table_name, error) of decisions that block publishing."""
    d = _clean(decisions, DECISION_FIELDS).where(F.upper("decision") == "BLOCK")
    return d.select("table_name", F.concat("table_name", F.lit("."), "column_name", F.lit(" "), F.upper("issue_type"), F.lit(": "), "reason").alias("error"))


def missing_columns(review: DataFrame, present: DataFrame) -> DataFrame:
    """(table_name, error): reviewed tables and columns that the sources, rows of (table_name,
    source_column), don't have."""
    r, p = _clean(review, SCHEMA_FIELDS), _clean(present, ("table_name", "source_column"))
    tables = p.select("table_name").distinct()
    gone = r.select("table_name").distinct().join(tables, "table_name", "left_anti")
    lost = r.join(tables, "table_name", "left_semi").select("table_name", "source_column").distinct().join(p, ["table_name", "source_column"], "left_anti")
    absent = lost.select("table_name", F.concat("table_name", F.lit("."), "source_column", F.lit(": no such column")).alias("error"))
    return gone.select("table_name", F.concat("table_name", F.lit(": no such table")).alias("error")).unionByName(absent)


def described(review: DataFrame) -> DataFrame:
    """(table_name, place, line): the readable summary of a review, a line a table (place 0) and a line a
    column, in the order of their names, columns of the same names by what is said of them."""
    r = _clean(review, SCHEMA_FIELDS)
    keys = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(flag(F.col("is_pk")), F.struct(F.coalesce(position(F.col("pk_order")), F.lit(0)).alias("at"), "column_name")))), lambda k: k["column_name"]), ", ")
    heads = r.groupBy("table_name", "silver_table_name").agg(F.coalesce(F.nullif(keys, F.lit("")), F.lit("none")).alias("k"))
    heads = heads.select("table_name", F.lit(0).alias("place"), F.concat("table_name", F.lit(" -> "), "silver_table_name", F.lit(" (key: "), "k", F.lit(")")).alias("line"))
    tail = F.when(flag(F.col("nullable")), "").otherwise(" not null")
    kind = F.coalesce(logical_type(F.col("datatype")), F.lit("string"))
    place = F.row_number().over(Window.partitionBy("table_name").orderBy("source_column", "column_name", kind, tail))
    lines = r.select("table_name", place.alias("place"), F.concat(F.lit("  "), "source_column", F.lit(" -> "), "column_name", F.lit(": "), kind, tail).alias("line"))
    return heads.unionByName(lines)
