"""Raw tables and control files."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable, Mapping
from functools import reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, location: str, kind: str = "parquet", **options: str) -> DataFrame:
    """A raw table: parquet, csv (all text, `NA` kept as text, empty fields null), json, jdbc, or a catalog table."""
    if kind == "table":
        return spark.read.table(location)
    if kind == "jdbc":
        return spark.read.format("jdbc").options(dbtable=location, **options).load()
    if kind == "csv":
        options = {"header": "true", "inferSchema": "false", "multiLine": "true", "escape": '"'} | options
    return spark.read.format(kind).options(**options).load(location)


def read_tables(spark: SparkSession, locations: Mapping[str, str], kind: str = "parquet", expected: int | None = None) -> dict[str, DataFrame]:
    """All raw tables by name; expected: how many there must be."""
    if expected is not None and len(locations) != expected:
        raise ValueError(f"{len(locations)} tables, {expected} expected")
    return {name: read_table(spark, location, kind) for name, location in locations.items()}


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as raw tables have them."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def ready(spark: SparkSession) -> bool:
    return spark.sql("SELECT 1 AS one").first()["one"] == 1


def read_json(path: str | Path, required: bool = True) -> dict:
    """A JSON object; {} for an absent file that isn't required."""
    path = Path(path)
    if not path.exists() and not required:
        return {}
    found = json.loads(path.read_text(encoding="utf-8-sig"))
    if not isinstance(found, dict):
        raise ValueError(f"{path}: not a JSON object")
    return found


def write_json(path: str | Path, value: Mapping) -> None:
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def read_review(path: str | Path) -> list[dict[str, str]]:
    """Rows of a control CSV, every field as text."""
    with open(path, encoding="utf-8-sig", newline="") as file:
        return list(csv.DictReader(file))


def write_review(path: str | Path, rows: Iterable[Mapping[str, object]], columns: list[str]) -> None:
    """A control CSV with a byte-order mark, for spreadsheets. Rows are few: one an issue or column."""
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        writer = csv.DictWriter(file, columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)


def write_table(df: DataFrame, location: str, kind: str = "csv") -> None:
    """A table of texts as CSV (null as nothing, an empty text as two quotes) or JSON lines, to be
    read again by read_table()."""
    options = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"} if kind == "csv" else {"ignoreNullFields": "false"}
    as_text(df).write.format(kind).options(**options).save(location)


def inventory(spark: SparkSession, locations: Mapping[str, str], kind: str = "parquet") -> DataFrame:
    """(table_name, status, row_count, column_count) of the tables there should be: FOUND, EMPTY or
    MISSING, rows counted by Spark. Run before a build, so that it doesn't stop half-way."""
    parts = []
    for name, location in locations.items():
        try:
            df = read_table(spark, location, kind)
        except AnalysisException:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit("MISSING").alias("status"), F.lit(0).cast("bigint").alias("row_count"), F.lit(0).alias("column_count")))
            continue
        row = df.agg(F.count("*").alias("row_count"))
        status = F.when(F.col("row_count") > 0, "FOUND").otherwise("EMPTY")
        parts.append(row.select(F.lit(name).alias("table_name"), status.alias("status"), "row_count", F.lit(len(df.columns)).alias("column_count")))
    return reduce(DataFrame.unionByName, parts)
