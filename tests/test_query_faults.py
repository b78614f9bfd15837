"""Queries in sessions and on tables that are less tidy than those they were first run on."""

from pyspark.sql import functions as F

import __spark_entry__
from assay.plans import review_frames as frames
from assay.plans.contract import SCHEMA_FIELDS

SF = "/root/testdata/sf0.001"


def test_published_beside_temporary_views(spark):
    spark.range(1).createOrReplaceTempView("left_by_another_query")
    assert "left_by_another_query" in {r["tableName"] for r in spark.sql("SHOW TABLES IN default").collect()}
    left = {r["check"]: r["n"] for r in __spark_entry__.queries()["published"](spark, SF).collect() if not r["table_name"]}
    assert left == {"REFUSED": 1, "NOTHING_LEFT": 0}


def test_described_in_one_order(spark):
    """Columns of the same names stand in one order, however the rows come."""
    same = [dict.fromkeys(SCHEMA_FIELDS, "") | {"table_name": "t", "silver_table_name": "s", "source_column": "c", "column_name": "c", "datatype": k, "nullable": n} for k in ("text", "date", "int") for n in ("yes", "no")]
    told = []
    for rows in (same, same[::-1]):
        df = spark.createDataFrame([tuple(r[f] for f in SCHEMA_FIELDS) for r in rows], ", ".join(f"{f} string" for f in SCHEMA_FIELDS)).coalesce(1)
        told.append([(r.place, r.line) for r in frames.described(df).where(F.col("place") > 0).orderBy("place").collect()])
    assert told[0] == told[1] and len({x for _, x in told[0]}) == 6
