"""A packed database: odd values, and readers in other processes than the one that made it."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

from assay.sources import jdbc

ON_CLUSTER = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__
shared = sys.argv[1]
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "800m", "spark.driver.memory": "1g", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1",
        "spark.sql.warehouse.dir": f"{shared}/warehouse", "spark.checkpoint.dir": f"file://{shared}/checkpoint", "spark.local.dir": f"{shared}/local"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
rows = __spark_entry__.queries()["jdbc_customers"](spark, "/root/testdata/sf0.001")
given = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(*rows.columns)
print("SAME", rows.count(), rows.exceptAll(given).count() + given.exceptAll(rows).count(), rows.rdd.getNumPartitions())
spark.stop()
"""


def test_odd_values(spark, tmp_path):
    rows = [(1, 'a"b,c'), (2, None), (3, ""), (4, "x\ny"), (5, " lead "), (6, 'é\r\nü""'), (None, "n")]
    url = jdbc.packed(spark.createDataFrame(rows, "K bigint, NAME string").repartition(3), "odd", {"K": "BIGINT", "NAME": "VARCHAR(100)"}, str(tmp_path / "odd"))
    read = jdbc.read_partitioned(spark, url, "odd", "k", rows_a_task=2)
    assert read.rdd.getNumPartitions() == 4 and sorted(map(tuple, read.collect()), key=repr) == sorted(rows, key=repr)
    empty = jdbc.packed(spark.createDataFrame([], "K bigint"), "nothing", {"K": "BIGINT"}, f"file://{tmp_path}/nothing")
    assert jdbc.read_partitioned(spark, empty, "nothing", "k").count() == 0
    with pytest.raises(ValueError, match="local files only"):
        jdbc.packed(spark.range(1), "one", {"id": "BIGINT"}, "hdfs://there/one")


def test_read_by_executors_of_their_own(tmp_path):
    home = tmp_path / "home"
    home.mkdir()
    for file in Path(pyspark.__file__).parent.iterdir():
        (home / file.name).symlink_to(file)
    repo = str(Path(__file__).parents[1])
    env = {**os.environ, "SPARK_HOME": str(home), "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable, "PYTHONPATH": repo}
    ran = subprocess.run([sys.executable, "-c", ON_CLUSTER, str(tmp_path)], capture_output=True, text=True, env=env, cwd=tmp_path, timeout=240)
    assert "SAME 150 0 " in ran.stdout, ran.stdout + ran.stderr[-3000:]
