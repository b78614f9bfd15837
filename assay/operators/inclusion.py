"""Which columns' values lie in which other columns, for all columns of all tables together.

Values meet once, by a digest, with the set of columns that hold them; references between tables
fall out of these sets, whatever the columns' names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.keys import match_keys

#: Share of a column's rows that must be found in a parent for a reference to be proposed.
LEAST_RATE = 0.80


def _keys(name: str, df: DataFrame) -> DataFrame:
    """(table_name, column_name, key): a digest of each cell's match key; cells without one are left out."""
    texts = df.select(*[match_keys(df, f"`{c}`").alias(c) for c in df.columns])
    cells = texts.unpivot([], texts.columns, "column_name", "text").where("text <> ''")
    digest = F.struct(F.xxhash64(F.lit(1), "text").alias("a"), F.xxhash64(F.lit(2), "text").alias("b"))
    return cells.select(F.lit(name).alias("table_name"), "column_name", digest.alias("key"))


def held_values(tables: dict[str, DataFrame]) -> DataFrame:
    """(key, held): for each value the columns that hold it, and in how many rows.

    Rows are counted by value and column before values meet, so one that a third of all rows
    hold is a row a task; what then meets under a value is at most a row a column.
    """
    cells = reduce(DataFrame.unionByName, [_keys(n, df) for n, df in tables.items()])
    counted = cells.groupBy("key", "table_name", "column_name").agg(F.count("*").alias("n"))
    return counted.groupBy("key").agg(F.collect_list(F.struct("table_name", "column_name", "n")).alias("held"))


def dependencies(tables: dict[str, DataFrame]) -> DataFrame:
    """A row for each two columns of different tables that share a value: child_table, child_column,
    parent_table, parent_column, total_rows, matched_rows, match_rate, parent_unique.

    total_rows: the child's rows with a value; matched_rows: those whose value the parent has
    (white space and case aside, as in keys.match_rate). parent_unique: whether no value is twice
    in the parent. Nulls and blanks are no values; an empty table has no row.
    """
    held = held_values(tables)
    child, parent = F.explode("held").alias("child"), F.explode("held").alias("parent")
    met = held.select("held", child).select("child", parent)
    same = (F.col("child.table_name") == F.col("parent.table_name")) & (F.col("child.column_name") == F.col("parent.column_name"))
    met = met.where(same | (F.col("child.table_name") != F.col("parent.table_name")))
    # A column paired with itself gives its rows and distinct values.
    pairs = met.groupBy(
        F.col("child.table_name").alias("child_table"), F.col("child.column_name").alias("child_column"),
        F.col("parent.table_name").alias("parent_table"), F.col("parent.column_name").alias("parent_column"),
    ).agg(F.sum("child.n").alias("matched_rows"), F.count("*").alias("shared"))
    pairs = pairs.withColumn("itself", (F.col("child_table") == F.col("parent_table")) & (F.col("child_column") == F.col("parent_column")))
    # A row for each pair of columns, so the rest is small: gathered once for a parent, once for a child.
    own = F.struct("matched_rows", (F.col("matched_rows") == F.col("shared")).alias("unique"))
    totals = F.broadcast(pairs.where("itself").select("child_table", "child_column", own.alias("own")))
    as_child = totals.select("child_table", "child_column", F.col("own.matched_rows").alias("total_rows"))
    as_parent = totals.select(F.col("child_table").alias("parent_table"), F.col("child_column").alias("parent_column"), F.col("own.unique").alias("parent_unique"))
    return pairs.where("NOT itself").join(as_child, ["child_table", "child_column"]).join(as_parent, ["parent_table", "parent_column"]).select(
        "child_table", "child_column", "parent_table", "parent_column", "total_rows", "matched_rows",
        (F.col("matched_rows") / F.col("total_rows")).alias("match_rate"), "parent_unique",
    )


def proposed(found: DataFrame, least_rate: float = LEAST_RATE) -> DataFrame:
    """Of each child column the unique parent that most of its rows find; of equal ones the first by name."""
    best = F.min_by(F.struct("parent_table", "parent_column", "match_rate"), F.struct((-F.col("match_rate")).alias("r"), "parent_table", "parent_column"))
    chosen = found.where(F.col("parent_unique") & (F.col("match_rate") >= least_rate)).groupBy("child_table", "child_column").agg(best.alias("p"))
    return chosen.select("child_table", "child_column", "p.*")
