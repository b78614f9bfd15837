"""Queries of publishing: guarded writes, versions, constraints, and the order of builds."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import profile_state
from assay.plans import order, script
from assay.plans.contract import ColumnSpec, Contract, ForeignKey, TableSpec
from assay.queries import (
    _CHANGED, _CUSTOMER, _FIX, _ORDER_COUNTS, _ORDERS, _SILVER, CONTRACT, ORACLE_SQL, ORDER_TABLE, SEGMENTS, _code, _customer, _first, _integer, _marker,
    _missing, _number, _orders, _strip, _sum, _table, query,
)
from assay.sources import jdbc, publish, snapshots
from assay.sources.files import as_text


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database for one query, which goes again with all its versions."""
    name = f"assay_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _spec(source: str, name: str, key: str, columns: dict[str, str], kinds: str, required: str = "", references: dict[str, str] | None = None) -> TableSpec:
    """A table from its columns (source to target) and their types' first letters."""
    types = {"i": "integer", "s": "string", "d": "decimal", "t": "date", "b": "boolean"}
    specs = tuple(ColumnSpec(c, n, types[k], n not in required.split()) for (c, n), k in zip(columns.items(), kinds, strict=True))
    keys = tuple(ForeignKey(c, *p.split(".")) for c, p in (references or {}).items())
    return TableSpec(source, name, specs, tuple(key.split()), keys, decisions=(_FIX("", "EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES"),))


_REGION = _spec("region", "regions", "region_id", {"r_regionkey": "region_id", "r_name": "name"}, "is", "region_id name")
_NATION = _spec("nation", "nations", "nation_id", {"n_nationkey": "nation_id", "n_name": "name", "n_regionkey": "region_id"}, "isi", "nation_id region_id", {"region_id": "region.region_id"})
_BUYER = _spec(
    "customer", "customers", "customer_id", {"c_custkey": "customer_id", "c_name": "name", "c_nationkey": "nation_id", "c_mktsegment": "segment"}, "ssis", "customer_id",
    {"nation_id": "nation.nation_id"},
)
_SALE = _spec(
    "orders", "sales", "order_id",
    {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status", "o_totalprice": "price", "o_orderdate": "order_date", "o_orderpriority": "priority"}, "issdts",
    "order_id customer_id", {"customer_id": "customer.customer_id"},
)


def _raw(spark, sf_dir, *names: str) -> dict[str, DataFrame]:
    return {n: as_text(_table(spark, sf_dir, n)) for n in names}


@query(f"""SELECT code, column_name, bad_rows FROM ({ORACLE_SQL["guard_report"]}) g UNION ALL SELECT 'INPUT', '', count(*) FROM {_ORDERS} o
    UNION ALL SELECT 'CHANGED', '', count(*) FILTER (WHERE {_CHANGED}) FROM {_ORDERS} o UNION ALL SELECT 'OUTPUT', '', count(*) FROM ({_SILVER}) s""")
def guarded_write(spark, sf_dir):
    """What one write of the typed orders, with its one pass over the raw ones, counted on the way."""
    with _database(spark) as database:
        written = publish.write_guarded(_orders(spark, sf_dir), ORDER_TABLE, CONTRACT, f"{publish.root_of(spark, database)}/orders")
    counts = [("INPUT", "", written.input_rows), ("CHANGED", "", written.changed_rows), ("OUTPUT", "", written.rows)]
    return spark.createDataFrame([*written.guards, *counts], "code string, column_name string, bad_rows bigint")


@query(f"""SELECT CAST(1 AS BIGINT) AS version, c_mktsegment AS segment, n_name AS nation, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
    UNION ALL SELECT CAST(2 AS BIGINT), CASE lower(c_mktsegment) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENTS.items())} ELSE c_mktsegment END, upper(n_name), count(*)
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def published_versions(spark, sf_dir):
    """Two versions of the same tables, each read as one: the second with other decisions and raw rows."""
    raw = _raw(spark, sf_dir, "region", "nation", "customer")
    mapped = replace(_BUYER, decisions=(*_BUYER.decisions, _FIX("segment", "TEXT_VARIANT", "APPLY_VALUE_MAPPING")), mappings={"segment": SEGMENTS})
    second = raw | {"nation": raw["nation"].withColumn("n_name", F.upper("n_name"))}
    rows = []
    with _database(spark) as database:
        publish.publish(spark, raw, Contract((_BUYER, _NATION, _REGION)), database)
        publish.publish(spark, second, Contract((_REGION, mapped, _NATION)), database, overwrite=True)
        root = publish.root_of(spark, database)
        for version in snapshots.versions(spark, root):
            tables = snapshots.read(spark, root, version)
            named = tables["customers"].select("segment", "nation_id").join(tables["nations"].select("nation_id", F.col("name").alias("nation")), "nation_id")
            rows += [(version, *r) for r in named.groupBy("segment", "nation").count().collect()]  # at most 125 rows
    return spark.createDataFrame(rows, "version bigint, segment string, nation string, n bigint")


def _kept(table: str, source: str, key: str, required: tuple[str, ...], reference: tuple[str, str] | None, texts: tuple[str, ...]) -> str:
    one = "SELECT '{}' AS table_name, '{}' AS constraint_name, '{}' AS kind, '{}' AS columns, '{}' AS reference, CAST(0 AS BIGINT) AS bad_rows, count(*) AS checked_rows FROM {}"
    parts = [one.format(table, f"pk_{table}", "PRIMARY KEY", key, "", source)] + [one.format(table, f"nn_{table}_{c}", "NOT NULL", c, "", source) for c in required]
    parts += [one.format(table, f"fk_{table}_{reference[0]}", "FOREIGN KEY", *reference, source)] if reference else []
    return " UNION ALL ".join(parts + [one.format(table, f"len_{table}_{c}", "LENGTH", c, "varchar(100)", source) for c in texts])


@query(" UNION ALL ".join((
    _kept("regions", "region", "region_id", ("region_id", "name"), None, ()), _kept("nations", "nation", "nation_id", ("nation_id", "region_id"), ("region_id", "regions.region_id"), ()),
    _kept("customers", "customer", "customer_id", ("customer_id",), ("nation_id", "nations.nation_id"), ("customer_id",)),
    _kept("sales", "orders", "order_id", ("order_id", "customer_id"), ("customer_id", "customers.customer_id"), ("customer_id",)),
)))
def constraints_kept(spark, sf_dir):
    """Keys, references and required columns of published tables as the catalog has them, checked there."""
    with _database(spark) as database:
        publish.publish(spark, _raw(spark, sf_dir, "orders", "customer", "nation", "region"), Contract((_SALE, _BUYER, _NATION, _REGION)), database)
        rows = publish.constraint_report(spark, database).collect()  # one row a constraint
    return spark.createDataFrame(rows, "table_name string, constraint_name string, kind string, columns string, reference string, bad_rows bigint, checked_rows bigint")


_DIRTY_BUYER = _spec("customer_raw", "buyers", "customer_id", {"customer_id": "customer_id", "name": "name", "nation_code": "nation_id"}, "isi", "customer_id", {"nation_id": "nation.nation_id"})
_ITEM = _spec(
    "lineitem", "items", "order_id line", {"l_orderkey": "order_id", "l_linenumber": "line", "l_quantity": "quantity", "l_shipdate": "shipped"}, "iidt", "order_id line",
    {"order_id": "orders.order_id"},
)


@query(f"""SELECT 'regions' AS table_name, 'BUILT' AS status, CAST(count(*) AS VARCHAR) AS what FROM region UNION ALL SELECT 'nations', 'BUILT', CAST(count(*) AS VARCHAR) FROM nation
    UNION ALL SELECT 'buyers', 'FAILED', concat('51001 buyers.nation_id: ', count(*), ' rows') FROM {_CUSTOMER} c WHERE nation_code IS NOT NULL AND {_integer('nation_code')} IS NULL
    UNION ALL SELECT 'sales', 'SKIPPED', 'not built: buyers' UNION ALL SELECT 'items', 'SKIPPED', 'not built: sales'
    UNION ALL SELECT 'level ' || l || ': ' || t, 'ORDER', '' FROM (VALUES (1, 'regions'), (2, 'nations'), (3, 'buyers'), (4, 'sales'), (5, 'items')) v(l, t)""")
def build_order(spark, sf_dir):
    """Tables built parents first: one that fails keeps its descendants back and no other table."""
    raw = _raw(spark, sf_dir, "lineitem", "orders", "nation", "region") | {"customer_raw": _customer(spark, sf_dir)}
    sale = replace(_SALE, foreign_keys=(ForeignKey("customer_id", "customer_raw", "customer_id"),), columns=tuple(replace(c, datatype="integer") if c.name == "customer_id" else c for c in _SALE.columns))
    contract = Contract((_ITEM, sale, _DIRTY_BUYER, _NATION, _REGION))
    with _database(spark) as database:
        found = publish.build_tables(spark, raw, contract, f"{publish.root_of(spark, database)}/{snapshots.RUNS}/one")
    rows = [(o.table, o.status, o.why or str(o.result.rows)) for o in found.values()]
    rows += [(f"level {i}: {', '.join(names)}", "ORDER", "") for i, names in enumerate(order.levels(contract), 1)]
    return spark.createDataFrame(rows, "table_name string, status string, what string")


# ------------------------------------------------------------------ the contract as a script

#: The orders' contract without what their raw rows break, so that the script runs to its end.
_PLAIN = replace(
    ORDER_TABLE, foreign_keys=(), primary_key=(), allow_no_primary_key=True,
    columns=tuple(replace(c, nullable=True, datatype="string" if c.name in ("order_date", "is_open", "units") else c.datatype) for c in ORDER_TABLE.columns),
)


def _viewed(df: DataFrame) -> str:
    """The name of a temporary view of df."""
    name = f"raw_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


@query(_SILVER)
def script_rows(spark, sf_dir):
    """What the script's cleaning and typing makes of the orders, all shapes of values included."""
    contract = Contract((replace(ORDER_TABLE, foreign_keys=()),))
    script.run(spark, contract, {"orders_raw": _viewed(_orders(spark, sf_dir))}, "none", stop=False)
    return spark.sql(f"SELECT DISTINCT {', '.join(c.name for c in ORDER_TABLE.columns)} FROM orders__rows")


@query(ORACLE_SQL["guard_report"].replace("UNION ALL SELECT '51006', 'customer_id', count(*) FILTER (WHERE length(customer_id) > 100)", "UNION ALL SELECT '51006', 'customer_id', count(*) FILTER (WHERE octet_length(encode(customer_id)) > 200)"))
def script_guards(spark, sf_dir):
    """Bad rows as the script counts them."""
    contract = Contract((ORDER_TABLE, TableSpec("customers_raw", "customers_of", (ColumnSpec("customer_id", "customer_id", "string"),), ("customer_id",))))
    sources = {"orders_raw": _viewed(_orders(spark, sf_dir)), "customers_raw": _viewed(_customer(spark, sf_dir))}
    script.run(spark, contract, sources, "none", stop=False)
    return spark.table("orders__guards")


@query(f"""SELECT 'orders' AS table_name, count(DISTINCT order_id) AS row_count, CAST(coalesce(sum({_number('price')}), 0) AS DECIMAL(38,10)) AS total, count(DISTINCT {_code('currency')}) AS currencies
    FROM {_ORDERS} o UNION ALL SELECT 'stopped: 51001 orders.units', count(*) FILTER (WHERE {_integer('units')} IS NULL), 0, 0 FROM {_ORDERS} o""")
def script_tables(spark, sf_dir):
    """The whole script run to its end, and one that stops at bad rows before any table is made."""
    raw = _viewed(_orders(spark, sf_dir))
    with _database(spark) as database:
        script.run(spark, Contract((_PLAIN,)), {"orders_raw": raw}, database)
        made = spark.table(f"{database}.orders").agg(F.count("*"), F.coalesce(F.sum("price"), F.lit(0)).cast("decimal(38,10)"), F.countDistinct("currency")).first()
    strict = replace(_PLAIN, columns=tuple(replace(c, datatype="integer" if c.name == "units" else c.datatype) for c in _PLAIN.columns))
    with _database(spark) as database:
        try:
            script.run(spark, Contract((strict,)), {"orders_raw": raw}, database)
            stopped = ("", 0)
        except Exception as error:  # raise_error's own kind depends on where it was evaluated
            found = re.search(r"(51001 orders\.units): (\d+) rows", str(error))
            stopped = (f"stopped: {found[1]}", int(found[2]))
        left = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").count()
    return spark.createDataFrame([("orders", *made), (stopped[0], stopped[1] + left, Decimal(0), 0)], "table_name string, row_count bigint, total decimal(38,10), currencies bigint")


# ------------------------------------------------------------------ another database


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def jdbc_customers(spark, sf_dir):
    """The customers, loaded into a database of the kind that comes with Spark and read again in parts by key."""
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR(32672)"}
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/assay_{uuid.uuid4().hex}"
    url = jdbc.packed(rows, "customers", {c: kinds[k] for c, k in rows.dtypes}, folder)
    return jdbc.read_partitioned(spark, url, "customers", "c_custkey", rows_a_task=500).toDF(*rows.columns)


# ------------------------------------------------------------------ profiles that grow with their files

_STRAY = "value <> {0} OR contains(value, '  ') OR regexp_matches(value, '[\\t\\r\\n]')".format(_strip("value"))


@query(f"""SELECT column_name, CAST(sum(n) AS BIGINT) AS row_count, {_sum('value IS NULL')} AS real_null, {_sum(_marker('value'))} AS marker_null, {_sum(f"value <> {_strip('value')}")} AS edge,
    {_sum("contains(value, '  ')")} AS repeated, {_sum("regexp_matches(value, '[\\t\\r\\n]')")} AS control, {_sum(_STRAY)} AS stray, e.effective, e.numbers, e.integers, e.dates, e.times, e.flags,
    CASE count(DISTINCT value) FILTER (WHERE NOT {_missing('value')}) WHEN 0 THEN 'ALL_MISSING_COLUMN' WHEN 1 THEN 'CONSTANT_COLUMN' ELSE '' END AS issue_type,
    {_first('value', 5, _marker('value'))} AS example
    FROM {_ORDER_COUNTS} c JOIN ({ORACLE_SQL["datatype_inference"]}) e USING (column_name) GROUP BY ALL""")
def profile_of_files(spark, sf_dir):
    """The profile of a folder that got files twice: the second run reads the new ones alone."""
    raw = _orders(spark, sf_dir)
    with _database(spark) as database:
        folder = publish.root_of(spark, database)
        raw.where("status LIKE 'F%' OR status LIKE ' f%'").repartition(3).write.parquet(f"{folder}/raw")
        profile_state.files_state(spark, spark.read.parquet(f"{folder}/raw"), f"{folder}/states")
        raw.where("NOT (status LIKE 'F%' OR status LIKE ' f%')").repartition(2).write.mode("append").parquet(f"{folder}/raw")
        state = profile_state.files_state(spark, spark.read.parquet(f"{folder}/raw"), f"{folder}/states")
        found = profile_state.report(state).drop("distinct_estimate")
        rows, schema = found.collect(), found.schema  # one row a column
    return spark.createDataFrame(rows, schema)
