"""Partitioned reads, held against the database that comes with Spark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assay.sources import files, jdbc

URL = "jdbc:derby:memory:assay_jdbc;create=true"


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 97 != 0, F.col("id") * 3 - 500).alias("k"), F.concat(F.lit("n'"), F.col("id") % 13).alias("name"),
        F.expr("date_add(DATE'2025-01-01', CAST(id % 30 AS INT))").alias("day"),
    )
    df = df.toDF("K", "NAME", "DAY")
    df.repartition(2).write.mode("overwrite").option("createTableColumnTypes", "NAME VARCHAR(40)").jdbc(URL, "things")
    return df


def same(a, b):
    key = lambda r: repr(tuple(r))
    assert sorted(a.collect(), key=key) == sorted(b.select(*a.columns).collect(), key=key)


def test_parts_by_range(spark, table):
    assert jdbc.bounds(spark, URL, "things", "k") == (-497, 2497, 1000)
    read = jdbc.read_partitioned(spark, URL, "things", "k", rows_a_task=130)
    assert read.rdd.getNumPartitions() == 8
    sizes = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 160
    same(read, table)
    assert jdbc.read_partitioned(spark, URL, "things", "k").rdd.getNumPartitions() == 1
    assert jdbc.read_partitioned(spark, URL, "things", "k", rows_a_task=1, most_tasks=5).rdd.getNumPartitions() == 5
    same(jdbc.read_partitioned(spark, URL, "things", "k", rows_a_task=1, most_tasks=5), table)
    same(files.read_table(spark, "things", "jdbc", url=URL), table)


@pytest.mark.parametrize("predicates", [
    jdbc.ranges("name", ["n'11", "n'3", "n'5"]), jdbc.ranges("day", [dt.date(2025, 1, 10), dt.date(2025, 1, 20)]), jdbc.ranges("k", []), jdbc.ranges("k", [0]), jdbc.remainders("k", 7), jdbc.remainders("k", 1),
])
def test_parts_by_conditions(spark, table, predicates):
    read = jdbc.read_partitioned(spark, URL, "things", predicates=predicates)
    assert read.rdd.getNumPartitions() == len(predicates)
    same(read, table)


def test_filters_and_columns_reach_the_database(spark, table):
    found = jdbc.read_partitioned(spark, URL, "things", "k", rows_a_task=300).where("k > 2000 AND day = DATE'2025-01-05'").select("name")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(K,2000)" in plan and "ReadSchema: struct<NAME:string>" in plan
    same(found, table.where("k > 2000 AND day = DATE'2025-01-05'").select("name"))


def test_empty_tables_and_inventory(spark, table):
    table.limit(0).write.mode("overwrite").jdbc(URL, "nothing")
    assert jdbc.read_partitioned(spark, URL, "nothing", "k").count() == 0
    listed = jdbc.inventory(spark, URL, "SELECT tablename FROM sys.systables WHERE tabletype = 'T'")
    assert {"THINGS", "NOTHING"} <= {r.tablename for r in listed.collect()}
    assert jdbc.sql_server_url("host\\one", "erp") == "jdbc:sqlserver://host\\one;databaseName=erp;encrypt=true;trustServerCertificate=false"
