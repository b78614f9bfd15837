"""From raw text tables to typed tables, as a contract says."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions import clean
from assay.functions.names import is_currency_column
from assay.operators import fx
from assay.plans.contract import ColumnSpec, Contract, TableSpec
from assay.plans.contract import _mapping as mapping_of
from assay.types import LOGICAL

#: Prefix of the cleaned but untyped columns that guards compare with the typed ones.
CLEANED = "__cleaned_"
#: Whether cleaning changed any text of a row.
CHANGED = "__changed"


@dataclass(frozen=True)
class Expression:
    """A target column before and after typing."""

    spec: ColumnSpec
    cleaned: Column
    typed: Column


def expressions(table: TableSpec, contract: Contract) -> list[Expression]:
    """Cleaning in order: missing-value texts, white space, mapping, currency alias, type.

    The first three only where a fix of the column is approved.
    """
    found = []
    for spec in table.columns:
        c = F.col(f"`{spec.source}`").cast("string")
        if table.fixes("MISSING_VALUE", "STANDARDIZE_NULL_MARKERS", spec.name):
            c = clean.without_markers(c)
        if table.fixes("WHITESPACE", "STANDARDIZE_TEXT", spec.name):
            c = clean.tidy(c)
        if table.fixes("TEXT_VARIANT", "APPLY_VALUE_MAPPING", spec.name):
            c = clean.map_values(c, mapping_of(table, spec.name))
        if is_currency_column(spec.name):
            c = clean.currency_code(c, contract.aliases)
        found.append(Expression(spec, c, clean.to_logical(c, spec.datatype)))
    return found


def typed_with_cleaned(raw: DataFrame, table: TableSpec, contract: Contract, rates: DataFrame | None = None) -> DataFrame:
    """Typed columns, conversions, the cleaned text of each column that has a type, and whether
    the row changed."""
    every = expressions(table, contract)
    columns = [e.typed.alias(e.spec.name) for e in every]
    columns += [e.cleaned.alias(CLEANED + e.spec.name) for e in every if e.spec.datatype != "string"]
    columns.append(changed(every).alias(CHANGED))
    frame = raw.select(*columns)
    for c in table.conversions:
        if rates is None:
            raise ValueError(f"{table.source}: conversions need exchange rates")
        frame = fx.with_rate(frame, rates, c.currency_column, c.date_column, c.rate_output_column, contract.base_currency, c.missing_rate_rule)
        frame = frame.withColumn(c.output_column, fx.converted(c.amount_column, c.rate_output_column))
    return frame


def changed(every: list[Expression]) -> Column:
    """Whether cleaning changes any of a row's texts."""
    return reduce(or_, [~F.col(f"`{e.spec.source}`").cast("string").eqNullSafe(e.cleaned) for e in every], F.lit(False))


def target_columns(table: TableSpec) -> list[str]:
    return [c.name for c in table.columns] + [x for c in table.conversions for x in (c.rate_output_column, c.output_column)]


def target_schema(table: TableSpec) -> T.StructType:
    """Schema of the typed table; converted columns can always be null."""
    fields = [T.StructField(c.name, LOGICAL[c.datatype], c.nullable) for c in table.columns]
    return T.StructType(fields + [T.StructField(n, LOGICAL["decimal"], True) for n in target_columns(table)[len(fields) :]])


def transform(raw: DataFrame, table: TableSpec, contract: Contract, rates: DataFrame | None = None) -> DataFrame:
    """The typed table; exact duplicates go, after cleaning, if that fix is approved."""
    return without_exact_duplicates(typed_with_cleaned(raw, table, contract, rates).select(*target_columns(table)), table)


def without_exact_duplicates(frame: DataFrame, table: TableSpec) -> DataFrame:
    """Equal rows once, if that fix is approved; else all rows."""
    return frame.distinct() if table.fixes("EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES") else frame


def _nulls(columns: list[Column]) -> Column:
    return sum((c.isNull().cast("bigint") for c in columns), F.lit(0).cast("bigint"))


def before_after(raw: DataFrame, table: TableSpec, contract: Contract, rates: DataFrame | None = None) -> DataFrame:
    """One row: rows, rows that cleaning changed, missing cells, bad values, and duplicate rows
    beyond the first, of the raw table and the typed one.

    The raw table is counted in one pass and grouped in another, the typed one grouped once.
    """
    every = expressions(table, contract)
    sources = [F.col(f"`{e.spec.source}`").cast("string") for e in every]
    target = transform(raw, table, contract, rates)
    zero = F.lit(0).cast("bigint")
    total = lambda c: F.coalesce(F.sum(c), zero)
    invalid = sum(((e.cleaned.isNotNull() & e.typed.isNull()).cast("bigint") for e in every), zero)
    before = raw.agg(
        F.count("*").alias("input_rows"), F.count_if(changed(every)).alias("changed_rows"),
        total(_nulls(sources)).alias("null_before"), total(invalid).alias("invalid_before"),
    )
    groups = raw.groupBy(*[f"`{e.spec.source}`" for e in every]).agg(F.count("*").alias("__n"))
    twice = groups.agg(total(F.col("__n") - 1).alias("duplicate_before"))
    rows = target.groupBy(*[f"`{c}`" for c in target.columns]).agg(F.count("*").alias("__n"))
    nulls = _nulls([F.col(f"`{c}`") for c in target.columns])
    after = rows.agg(total("__n").alias("output_rows"), total(F.col("__n") - 1).alias("duplicate_after"), total(nulls * F.col("__n")).alias("null_after"))
    # Each part is one row.
    name = lambda df: df.select(F.lit(table.name).alias("table_name"), "*")
    return name(before).join(name(twice), "table_name").join(name(after), "table_name").select(
        "table_name", "input_rows", "output_rows", "changed_rows", "duplicate_before", "duplicate_after", "null_before", "null_after", "invalid_before"
    )
