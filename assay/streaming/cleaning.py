"""Cleaning of streams: a contract's expressions keep no state, so they run on micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assay.operators import guards
from assay.operators.transform import target_columns, typed_with_cleaned
from assay.plans.contract import Contract, TableSpec


def clean_stream(raw: DataFrame, table: TableSpec, contract: Contract, rates: DataFrame | None = None) -> DataFrame:
    """The typed rows of a raw stream; exchange rates are a static side."""
    return typed_with_cleaned(raw, table, contract, rates).select(*target_columns(table))


def write_stream(raw: DataFrame, table: TableSpec, contract: Contract, path: str, checkpoint: str, rates: DataFrame | None = None) -> StreamingQuery:
    """Guard each micro-batch and write it as parquet under its number; a failing batch stops the query.

    A batch that is run again writes over its own folder, so nothing is there twice; reading
    path gives the numbers as the column batch. Keys are unique within a batch only: across
    batches, merge by key downstream.
    """

    def each(batch: DataFrame, number: int) -> None:
        frame = typed_with_cleaned(batch, table, contract, rates)
        guards.check(frame, table)
        frame.select(*target_columns(table)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(rows: DataFrame, time_col: str, window: str, late: str) -> DataFrame:
    """(start, rows): rows by event-time window, late ones within the watermark included."""
    counted = rows.withWatermark(time_col, late).groupBy(F.window(time_col, window)).agg(F.count("*").alias("rows"))
    return counted.select(F.col("window.start").alias("start"), "rows")
