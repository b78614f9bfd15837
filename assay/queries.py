"""Queries of the operators over the registered tables, and SQL for the same rows.

The tables are clean, so queries first make raw, dirty text of them by expressions that both
engines evaluate alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.config import CURRENCY_ALIASES, NULL_MARKERS
from assay.functions import clean
from assay.operators import fx, guards, keys, profile, reviews, transform
from assay.plans.contract import ColumnSpec, Contract, Decision, ForeignKey, TableSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# ------------------------------------------------------------------ dirty sources

_DAY = "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"
_MONTH = "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')"
_YEAR = "CAST(year(o_orderdate) AS STRING)"
_WHOLE = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
CUSTOMER = [
    "CAST(c_custkey AS STRING) AS customer_id",
    "CASE c_custkey % 5 WHEN 0 THEN '--' WHEN 1 THEN concat('  ', c_name, ' ') WHEN 2 THEN replace(c_name, '#', chr(9)) ELSE c_name END AS name",
    "CASE c_custkey % 7 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'null' WHEN 2 THEN NULL WHEN 3 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment",
    "CASE c_custkey % 11 WHEN 0 THEN 'unknown' ELSE CAST(c_nationkey AS STRING) END AS nation_code",
    "CASE c_custkey % 2 WHEN 0 THEN 'none' END AS remark",
    "'raw' AS origin",
]
ORDERS = [
    "CAST(o_orderkey AS STRING) AS order_id",
    "CASE o_orderkey % 9 WHEN 0 THEN concat('X', CAST(o_custkey AS STRING)) ELSE CAST(o_custkey AS STRING) END AS customer_id",
    "CASE o_orderkey % 4 WHEN 0 THEN concat(' ', lower(o_orderstatus)) ELSE o_orderstatus END AS status",
    f"CASE o_orderkey % 5 WHEN 0 THEN concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',', lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0'), '.50') WHEN 1 THEN concat('(', {_WHOLE}, '.25)') WHEN 2 THEN 'n/a' ELSE {_WHOLE} END AS price",
    f"CASE o_orderkey % 6 WHEN 0 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}) WHEN 1 THEN concat({_YEAR}, '/', {_MONTH}, '/', {_DAY}, ' 10:05') WHEN 2 THEN concat({_DAY}, '/', {_MONTH}, '/', {_YEAR}) WHEN 3 THEN concat({_MONTH}, '-', {_DAY}, '-', {_YEAR}) WHEN 4 THEN concat({_YEAR}, {_MONTH}, {_DAY}) ELSE 'May 2' END AS order_date",
    "CASE o_orderkey % 3 WHEN 0 THEN concat(' ', o_orderpriority) WHEN 1 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority",
    "CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 't' WHEN 2 THEN '0' WHEN 3 THEN 'F' WHEN 4 THEN 'maybe' END AS is_open",
    "CASE o_orderkey % 4 WHEN 0 THEN '12.5' WHEN 1 THEN '1,000' WHEN 2 THEN '457000.0' ELSE CAST(o_custkey AS STRING) END AS units",
    "CASE o_orderkey % 7 WHEN 0 THEN 'us$' WHEN 1 THEN 'VNĐ' WHEN 2 THEN 'rmb' WHEN 3 THEN ' eur ' WHEN 4 THEN 'xyz9' WHEN 5 THEN 'JPY' END AS currency",
]
#: Typed transactions and rates: a currency is a priority, rates are set on three days a month.
TX = ["o_orderkey AS order_id", "o_orderpriority AS currency", "CAST(o_orderdate AS DATE) AS day", "CAST(floor(o_totalprice) AS DECIMAL(38,10)) AS amount"]
_RATE = "SELECT currency, day AS date, max(amount) AS rate FROM ({tx}) t WHERE day(day) IN (1, 11, 21) AND currency <> '1-URGENT' GROUP BY currency, day"
BASE = "2-HIGH"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(*CUSTOMER)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*ORDERS)


def _doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.unionByName(orders.where("o_orderkey % 50 = 0"))


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*TX)


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tx(spark, sf_dir).where("day(day) IN (1, 11, 21) AND currency <> '1-URGENT'").groupBy("currency", F.col("day").alias("date")).agg(F.max("amount").alias("rate"))


# ------------------------------------------------------------------ SQL of the same

_CUSTOMER = f"(SELECT {', '.join(CUSTOMER)} FROM customer)"
_ORDERS = f"(SELECT {', '.join(ORDERS)} FROM orders)"
_DOUBLED = "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0)"
_TX = f"(SELECT {', '.join(TX)} FROM orders)"
_RATES = f"({_RATE.format(tx=_TX[1:-1])})"
_MARKERS = "(" + ", ".join(f"'{m}'" for m in NULL_MARKERS) + ")"
_WHITE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _strip(x: str) -> str:
    return f"trim({x}, {_WHITE})"


def _key(x: str) -> str:
    return rf"lower(regexp_replace({_strip(x)}, '\s+', ' ', 'g'))"


def _marker(x: str) -> str:
    return f"({x} IS NOT NULL AND {_key(x)} IN {_MARKERS})"


def _missing(x: str) -> str:
    return f"({x} IS NULL OR {_key(x)} IN {_MARKERS})"


def _number(x: str) -> str:
    plain = f"replace(trim({x}), ',', '')"
    text = rf"(CASE WHEN {plain} LIKE '(%)' THEN concat('-', substr({plain}, 2, length({plain}) - 2)) ELSE {plain} END)"
    return rf"(CASE WHEN regexp_full_match({text}, '[+-]?(\d+(\.\d*)?|\.\d+)') THEN TRY_CAST({text} AS DECIMAL(38,10)) END)"


def _integer(x: str) -> str:
    return f"(CASE WHEN floor({_number(x)}) = {_number(x)} THEN TRY_CAST({_number(x)} AS BIGINT) END)"


def _time(x: str) -> str:
    t = f"trim({x})"
    return rf"""(CASE WHEN regexp_matches({t}, '^[12]\d{{3}}-') THEN try_strptime({t}, ['%Y-%m-%d', '%Y-%m-%d %H:%M', '%Y-%m-%d %H:%M:%S'])
        WHEN regexp_matches({t}, '^[12]\d{{3}}/') THEN try_strptime({t}, ['%Y/%m/%d', '%Y/%m/%d %H:%M'])
        WHEN contains({t}, '/') THEN try_strptime({t}, ['%d/%m/%Y', '%d/%m/%Y %H:%M'])
        WHEN contains({t}, '-') THEN try_strptime({t}, ['%m-%d-%Y', '%m-%d-%Y %H:%M'])
        WHEN regexp_full_match({t}, '[12]\d{{3}}[01]\d[0-3]\d') THEN try_strptime({t}, '%Y%m%d') END)"""


def _boolean(x: str) -> str:
    return f"(CASE WHEN lower(trim({x})) IN ('true', '1', 'yes', 'y', 't') THEN true WHEN lower(trim({x})) IN ('false', '0', 'no', 'n', 'f') THEN false END)"


def _code(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CURRENCY_ALIASES.items())
    return f"(CASE upper(trim({x})) {cases} ELSE upper(trim({x})) END)"


def _counts(source: str, columns: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} s GROUP BY {c}" for c in columns]
    return "(" + " UNION ALL ".join(parts) + ")"


def _first(x: str, most: int, where: str = "true") -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct(list({x}) FILTER (WHERE {where} AND {x} IS NOT NULL)))[1:{most}], ' | '), '')"


def _sum(condition: str) -> str:
    return f"CAST(coalesce(sum(n) FILTER (WHERE {condition}), 0) AS BIGINT)"


def _names(expressions: list[str]) -> list[str]:
    return [e.rsplit(" AS ", 1)[1] for e in expressions]


_CUSTOMER_COUNTS = _counts(_CUSTOMER, _names(CUSTOMER))
_ORDER_COUNTS = _counts(_ORDERS, _names(ORDERS))

# ------------------------------------------------------------------ profiling


@query(f"""SELECT 'orders' AS table_name, CAST(sum(c) AS BIGINT) AS row_count, CAST(6 AS BIGINT) AS column_count, CAST(0 AS BIGINT) AS real_null_cells,
    CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS duplicate_row_count FROM (SELECT count(*) AS c FROM {_DOUBLED} d GROUP BY ALL)""".replace("SELECT count(*) AS c FROM", "SELECT count(*) AS c, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM"))
def bronze_profile(spark, sf_dir):
    return profile.profile_table("orders", _doubled(spark, sf_dir))


@query(f"""SELECT column_name, CAST(sum(n) AS BIGINT) AS row_count, {_sum('value IS NULL')} AS real_null_count, {_sum(_marker('value'))} AS marker_count,
    {_sum(_missing('value'))} AS missing_count, count(*) AS unique_count, count(*) FILTER (WHERE NOT {_missing('value')}) AS effective_unique_count
    FROM {_CUSTOMER_COUNTS} c GROUP BY column_name""")
def column_profile(spark, sf_dir):
    return profile.profile_columns(_customer(spark, sf_dir))


@query(f"""SELECT column_name, {_sum('value IS NULL')} AS real_null, {_sum(_marker('value'))} AS marker_null, {_first('value', 5, _marker('value'))} AS example
    FROM {_CUSTOMER_COUNTS} c GROUP BY column_name HAVING {_sum(_missing('value'))} > 0""")
def missing_values(spark, sf_dir):
    return profile.missing_values(_customer(spark, sf_dir))


@query(f"SELECT count(*) FILTER (WHERE segment IS NULL) AS real_null, count(*) FILTER (WHERE {_marker('segment')}) AS marker, count(*) FILTER (WHERE NOT {_missing('segment')}) AS effective FROM {_CUSTOMER} c")
def missing_masks(spark, sf_dir):
    c = F.col("segment")
    return _customer(spark, sf_dir).agg(F.count_if(c.isNull()).alias("real_null"), F.count_if(clean.is_marker(c)).alias("marker"), F.count_if(~clean.is_missing(c)).alias("effective"))


@query(f"SELECT {_first('segment', 5, _marker('segment'))} AS example FROM {_CUSTOMER} c")
def marker_examples(spark, sf_dir):
    c = F.col("segment")
    return profile.with_examples(_customer(spark, sf_dir).where(clean.is_marker(c)), [], c, F.lit(1), 5).select("example")


@query(f"""SELECT column_name, {_sum(f"value <> {_strip('value')}")} AS edge, {_sum("contains(value, '  ')")} AS repeated,
    {_sum("regexp_matches(value, '[\\t\\r\\n]')")} AS control, {_sum(f"value <> {_strip('value')} OR contains(value, '  ') OR regexp_matches(value, '[\\t\\r\\n]')")} AS total
    FROM {_CUSTOMER_COUNTS} c GROUP BY column_name HAVING {_sum(f"value <> {_strip('value')} OR contains(value, '  ') OR regexp_matches(value, '[\\t\\r\\n]')")} > 0""")
def whitespace_report(spark, sf_dir):
    return profile.whitespace_issues(_customer(spark, sf_dir))


@query(f"""SELECT column_name, variant_key, count(*) AS variant_count, CAST(sum(n) AS BIGINT) AS affected_rows, {_first('value', 10)} AS variants
    FROM (SELECT *, {_key('value')} AS variant_key FROM {_ORDER_COUNTS} c WHERE NOT {_missing('value')}) k GROUP BY column_name, variant_key HAVING count(*) > 1""")
def text_variants(spark, sf_dir):
    return profile.text_variants(_orders(spark, sf_dir))


@query(f"""SELECT column_name, CASE count(*) FILTER (WHERE NOT {_missing('value')}) WHEN 0 THEN 'ALL_MISSING_COLUMN' ELSE 'CONSTANT_COLUMN' END AS issue_type
    FROM {_CUSTOMER_COUNTS} c GROUP BY column_name HAVING count(*) FILTER (WHERE NOT {_missing('value')}) < 2""")
def constant_columns(spark, sf_dir):
    return profile.structure_issues(_customer(spark, sf_dir))


_IS_DATE = f"(regexp_matches(value, '[-/:T ]') AND {_time('value')} IS NOT NULL)"


@query(rf"""SELECT column_name, {_sum('k')} AS effective, {_sum(f"k AND {_number('value')} IS NOT NULL")} AS numbers, {_sum(f"k AND {_integer('value')} IS NOT NULL")} AS integers,
    {_sum(f"k AND {_IS_DATE}")} AS dates, {_sum(f"k AND {_IS_DATE} AND regexp_matches(value, '[0-9]{{1,2}}:[0-9]{{2}}')")} AS times,
    {_sum(f"k AND {_key('value')} IN ('true', 'false', 'yes', 'no', 'y', 'n', '0', '1')")} AS flags
    FROM (SELECT *, NOT {_missing('value')} AS k FROM {_ORDER_COUNTS} c) s GROUP BY column_name""")
def datatype_inference(spark, sf_dir):
    return profile.type_evidence(_orders(spark, sf_dir))


@query(f"""SELECT column_name, CAST(sum(n) AS BIGINT) AS invalid_count, {_first('value', 10)} AS example FROM {_ORDER_COUNTS} c WHERE NOT {_missing('value')} AND CASE column_name
    WHEN 'price' THEN {_number('value')} IS NULL WHEN 'order_date' THEN {_time('value')} IS NULL WHEN 'is_open' THEN {_boolean('value')} IS NULL WHEN 'units' THEN {_integer('value')} IS NULL ELSE false END GROUP BY column_name""")
def datatype_issues(spark, sf_dir):
    types = {"price": "decimal", "order_date": "date", "is_open": "boolean", "units": "integer", "status": "string"}
    return profile.datatype_issues(_orders(spark, sf_dir), types)


_GROUPS = f"(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, count(*) AS c FROM {_DOUBLED} d GROUP BY ALL)"


@query(f"SELECT count(*) AS duplicate_group_count, CAST(sum(c) AS BIGINT) AS affected_rows FROM {_GROUPS} g WHERE c > 1")
def exact_duplicates(spark, sf_dir):
    return profile.exact_duplicates(_doubled(spark, sf_dir))


@query(f"SELECT DISTINCT * FROM {_DOUBLED} d")
def remove_exact_duplicates(spark, sf_dir):
    columns = _table(spark, sf_dir, "orders").dtypes
    logical = {"bigint": "integer", "int": "integer"}
    table = TableSpec("orders", "orders", tuple(ColumnSpec(c, c, logical.get(kind, "string")) for c, kind in columns), decisions=(_FIX("", "EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES"),))
    return transform.without_exact_duplicates(_doubled(spark, sf_dir), table)


# ------------------------------------------------------------------ cleaning


@query(f"SELECT customer_id, CASE WHEN lower(trim(segment)) NOT IN {_MARKERS} THEN segment END AS segment FROM {_CUSTOMER} c")
def fake_null_cleanup(spark, sf_dir):
    return _customer(spark, sf_dir).select("customer_id", clean.without_markers(F.col("segment")).alias("segment"))


@query("SELECT doc_id, md5(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'))) AS text_md5 FROM documents")
def text_cleanup(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(clean.tidy(F.col("text")).cast("binary")).alias("text_md5"))


SEGMENTS = {"building": "Construction", "machinery": "Industry", "automobile": "Industry"}


@query(f"SELECT customer_id, CASE lower(trim(segment)) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENTS.items())} ELSE segment END AS segment FROM {_CUSTOMER} c")
def value_mapping(spark, sf_dir):
    return _customer(spark, sf_dir).select("customer_id", clean.map_values(F.col("segment"), SEGMENTS).alias("segment"))


@query(f"SELECT order_id, {_code('currency')} AS currency FROM {_ORDERS} o")
def currency_alias(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", clean.currency_code(F.col("currency")).alias("currency"))


@query(f"SELECT count(*) FILTER (WHERE code IS NOT NULL AND NOT regexp_full_match(code, '[A-Z]{{3}}')) AS invalid_rows, {_first('code', 5, "NOT regexp_full_match(code, '[A-Z]{3}')")} AS example FROM (SELECT {_code('currency')} AS code FROM {_ORDERS} o)")
def currency_validity(spark, sf_dir):
    code = _orders(spark, sf_dir).select(clean.currency_code(F.col("currency")).alias("code"))
    bad = F.col("code").isNotNull() & ~clean.is_currency_code(F.col("code"))
    return profile.with_examples(code.where(bad), [], F.col("code"), F.lit(1), 5).withColumnRenamed("n", "invalid_rows")


@query(f"SELECT order_id, {_number('price')} AS price FROM {_ORDERS} o")
def numeric_clean_decimal(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", clean.to_decimal(F.col("price")).alias("price"))


@query(f"SELECT order_id, {_integer('units')} AS units FROM {_ORDERS} o")
def integer_cast(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", clean.to_integer(F.col("units")).alias("units"))


@query(f"SELECT order_id, {_boolean('is_open')} AS is_open FROM {_ORDERS} o")
def boolean_cast(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", clean.to_boolean(F.col("is_open")).alias("is_open"))


@query(f"SELECT order_id, CAST({_time('order_date')} AS TIMESTAMP) AS at, CAST({_time('order_date')} AS DATE) AS day FROM {_ORDERS} o")
def date_routing(spark, sf_dir):
    c = clean.to_timestamp(F.col("order_date"))
    return _orders(spark, sf_dir).select("order_id", c.alias("at"), c.cast("date").alias("day"))


# ------------------------------------------------------------------ keys


@query(f"""SELECT column_name, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n) FILTER (WHERE {_missing('value')}) AS BIGINT) AS m, count(DISTINCT lower({_strip('value')})) AS distinct_keys
    FROM {_counts('part', ['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size'])} c GROUP BY column_name""".replace(f"CAST(sum(n) FILTER (WHERE {_missing('value')}) AS BIGINT) AS m", f"{_sum(_missing('value'))} AS missing"))
def pk_candidates_single(spark, sf_dir):
    return keys.key_candidates(_table(spark, sf_dir, "part").drop("p_retailprice"))


_COMBOS = [("l_orderkey", "l_linenumber"), ("l_orderkey", "l_partkey"), ("l_orderkey", "l_partkey", "l_suppkey")]


@query(" UNION ALL ".join(f"SELECT '{'+'.join(c)}' AS combo, count(*) AS distinct_keys, CAST(sum(c) AS BIGINT) AS row_count FROM (SELECT {', '.join(c)}, count(*) AS c FROM lineitem GROUP BY ALL)" for c in _COMBOS))
def pk_candidates_composite(spark, sf_dir):
    return keys.composite_counts(_table(spark, sf_dir, "lineitem"), _COMBOS)


_KEYED = "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"


@query(f"""SELECT 'l_orderkey + l_linenumber' AS primary_key, CAST(0 AS BIGINT) AS missing_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups,
    CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS normalized_duplicate_groups,
    CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'OK' ELSE 'REVIEW_PK' END AS status FROM {_KEYED} k""")
def pk_quality(spark, sf_dir):
    return keys.key_quality(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, key_rows FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_rows FROM lineitem) WHERE key_rows > 1""")
def pk_duplicate_rows(spark, sf_dir):
    return keys.duplicate_key_rows(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "key_rows")


@query(f"""SELECT count(*) AS total_rows, count(c_custkey) AS matched_rows, CAST(count(c_custkey) AS DOUBLE) / count(*) AS match_rate
    FROM {_ORDERS} o LEFT JOIN customer ON {_key('customer_id')} = CAST(c_custkey AS STRING)""")
def fk_match_rate(spark, sf_dir):
    return keys.match_rate(_orders(spark, sf_dir), "customer_id", _table(spark, sf_dir, "customer"), "c_custkey")


@query(f"SELECT order_id, customer_id FROM {_ORDERS} o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE CAST(c_custkey AS STRING) = customer_id)")
def fk_orphans(spark, sf_dir):
    parents = _table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS customer_id")
    return guards.orphans(_orders(spark, sf_dir), "customer_id", parents, "customer_id").select("order_id", "customer_id")


def _star(spark, sf_dir):
    """Whole tables whose keys share names, and their keys."""
    tables = {
        "orders": _table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "customer_id"}),
        "customers": _table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "customer_id", "c_nationkey": "nation_id"}),
        "nations": _table(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "nation_id", "n_regionkey": "region_id"}),
    }
    return tables, {"orders": ["order_id"], "customers": ["customer_id"], "nations": ["nation_id"]}


@query("""SELECT * FROM (
    SELECT 'customers' AS child_table, 'nation_id' AS child_column, 'nations' AS parent_table, 'nation_id' AS parent_column, CAST(count(n_nationkey) AS DOUBLE) / count(*) AS match_rate FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'orders', 'customer_id', 'customers', 'customer_id', CAST(count(c_custkey) AS DOUBLE) / count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey) WHERE match_rate >= 0.8""")
def fk_proposal(spark, sf_dir):
    found = keys.propose_foreign_keys(*_star(spark, sf_dir))
    return spark.createDataFrame(found, "child_table string, child_column string, parent_table string, parent_column string, match_rate double")


# ------------------------------------------------------------------ exchange rates


@query(f"SELECT order_id, CASE WHEN t.currency = '{BASE}' THEN CAST(1 AS DECIMAL(38,10)) ELSE rate END AS fx_rate FROM {_TX} t LEFT JOIN {_RATES} r ON t.currency = r.currency AND t.day = r.date")
def fx_exact(spark, sf_dir):
    return fx.exact_rate(_tx(spark, sf_dir), _rates(spark, sf_dir), "currency", "day", base=BASE).select("order_id", "fx_rate")


_ASOF = f"(SELECT t.*, CASE WHEN t.currency = '{BASE}' THEN CAST(1 AS DECIMAL(38,10)) ELSE rate END AS fx_rate FROM {_TX} t ASOF LEFT JOIN {_RATES} r ON t.currency = r.currency AND t.day >= r.date)"


@query(f"SELECT order_id, fx_rate FROM {_ASOF} a")
def fx_asof(spark, sf_dir):
    return fx.asof_rate(_tx(spark, sf_dir), _rates(spark, sf_dir), "currency", "day", base=BASE).select("order_id", "fx_rate")


@query(f"SELECT order_id, fx_rate, CAST(CAST(amount AS DECIMAL(18,0)) * CAST(fx_rate AS DECIMAL(18,0)) AS DECIMAL(38,10)) AS converted FROM {_ASOF} a")
def fx_convert(spark, sf_dir):
    rated = fx.asof_rate(_tx(spark, sf_dir), _rates(spark, sf_dir), "currency", "day", base=BASE)
    return rated.select("order_id", "fx_rate", fx.converted("amount", "fx_rate").alias("converted"))


@query(f"""SELECT count(*) FILTER (WHERE fx_rate IS NOT NULL) AS converted_row_count, count(*) FILTER (WHERE currency <> '{BASE}' AND fx_rate IS NULL) AS missing_fx_count,
    count(*) FILTER (WHERE currency <> '{BASE}' AND currency NOT IN (SELECT currency FROM {_RATES} r)) AS invalid_currency_count FROM {_ASOF} a""")
def fx_quality(spark, sf_dir):
    rates = _rates(spark, sf_dir)
    rated = fx.asof_rate(_tx(spark, sf_dir), rates, "currency", "day", base=BASE)
    return fx.conversion_report(rated, rates, "amount", "currency", "fx_rate", BASE)


# ------------------------------------------------------------------ contract, guards, reviews

_FIX = lambda column, issue, action: Decision(issue, "FIX", column, action)
ORDER_TABLE = TableSpec(
    "orders_raw", "orders",
    (
        ColumnSpec("order_id", "order_id", "integer", False), ColumnSpec("customer_id", "customer_id", "string", False),
        ColumnSpec("status", "status", "string"), ColumnSpec("price", "price", "decimal"), ColumnSpec("order_date", "order_date", "date", False),
        ColumnSpec("priority", "priority", "string"), ColumnSpec("is_open", "is_open", "boolean"), ColumnSpec("units", "units", "integer"),
        ColumnSpec("currency", "currency", "string"),
    ),
    ("order_id",), (ForeignKey("customer_id", "customers_raw", "customer_id"),),
    decisions=(
        _FIX("price", "MISSING_VALUE", "STANDARDIZE_NULL_MARKERS"), _FIX("status", "WHITESPACE", "STANDARDIZE_TEXT"),
        _FIX("priority", "WHITESPACE", "STANDARDIZE_TEXT"), _FIX("status", "TEXT_VARIANT", "APPLY_VALUE_MAPPING"),
        _FIX("", "EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES"),
    ),
    mappings={"status": {"o": "Open", "f": "Final", "p": "Pending"}},
)
CONTRACT = Contract((ORDER_TABLE,))
_SILVER = f"""SELECT DISTINCT {_integer('order_id')} AS order_id, customer_id, CASE lower(trim(status)) WHEN 'o' THEN 'Open' WHEN 'f' THEN 'Final' WHEN 'p' THEN 'Pending' ELSE trim(status) END AS status,
    {_number('price')} AS price, CAST({_time('order_date')} AS DATE) AS order_date, trim(priority) AS priority, {_boolean('is_open')} AS is_open, {_integer('units')} AS units, {_code('currency')} AS currency FROM {_ORDERS} o"""


@query(_SILVER)
def silver_orders(spark, sf_dir):
    return transform.transform(_orders(spark, sf_dir), ORDER_TABLE, CONTRACT)


@query(f"""SELECT '51001' AS code, 'order_id' AS column_name, count(*) FILTER (WHERE {_integer('order_id')} IS NULL) AS bad_rows FROM {_ORDERS} o
    UNION ALL SELECT '51003', 'order_id', count(*) FILTER (WHERE {_integer('order_id')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51004', 'order_id', count(*) FILTER (WHERE {_integer('order_id')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51006', 'customer_id', count(*) FILTER (WHERE length(customer_id) > 100) FROM {_ORDERS} o
    UNION ALL SELECT '51003', 'customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51001', 'price', count(*) FILTER (WHERE lower(trim(price)) NOT IN {_MARKERS} AND {_number('price')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51001', 'order_date', count(*) FILTER (WHERE {_time('order_date')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51003', 'order_date', count(*) FILTER (WHERE {_time('order_date')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51001', 'is_open', count(*) FILTER (WHERE is_open IS NOT NULL AND {_boolean('is_open')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51001', 'units', count(*) FILTER (WHERE {_integer('units')} IS NULL) FROM {_ORDERS} o
    UNION ALL SELECT '51005', 'order_id', count(*) FROM (SELECT order_id FROM {_ORDERS} o GROUP BY order_id HAVING count(*) > 1)""")
def guard_report(spark, sf_dir):
    return guards.guard_counts(transform.typed_with_cleaned(_orders(spark, sf_dir), ORDER_TABLE, CONTRACT), ORDER_TABLE)


@query("SELECT count(*) FILTER (WHERE length(url) > 100) AS long_urls, count(*) FILTER (WHERE length(html) > 100) AS long_pages FROM pages")
def key_length_guard(spark, sf_dir):
    return _table(spark, sf_dir, "pages").agg(F.count_if(guards.too_long("url")).alias("long_urls"), F.count_if(guards.too_long("html")).alias("long_pages"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM ({_SILVER}) s" for c in ("price", "order_date", "is_open", "units")))
def nullability_check(spark, sf_dir):
    return guards.nullability(silver_orders(spark, sf_dir), ["price", "order_date", "is_open", "units"])


def _policy_tables():
    base = TableSpec("orders", "orders", ())
    kept = TableSpec("orders", "kept", (), decisions=(Decision("EXACT_DUPLICATE", "KEEP", reason="history"),))
    fixed = TableSpec("orders", "fixed", (), decisions=(_FIX("", "EXACT_DUPLICATE", "REMOVE_EXACT_DUPLICATES"),))
    return base, kept, fixed


_POLICY = (("orders", "EXACT_DUPLICATE_UNDECIDED", "FAIL"), ("kept", "EXACT_DUPLICATE_ACCEPTED", "WARNING"), ("fixed", "EXACT_DUPLICATE", "FAIL"))
_POLICY_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '' AS column_name, '{k}' AS issue_type, CAST(sum(c) AS BIGINT) AS issue_count, '' AS example, '{s}' AS severity FROM {_GROUPS} g WHERE c > 1" for t, k, s in _POLICY)


@query(_POLICY_SQL)
def duplicate_policy(spark, sf_dir):
    df, out = _doubled(spark, sf_dir), None
    for table in _policy_tables():
        issues = guards.duplicate_policy(df, table)
        out = issues if out is None else out.unionByName(issues)
    return out


@query(f"SELECT t.table_name, coalesce(max(CASE severity WHEN 'FAIL' THEN 'FAIL' WHEN 'WARNING' THEN 'WARNING' END), 'PASS') AS status FROM (VALUES ('orders'), ('kept'), ('fixed'), ('clean')) t(table_name) LEFT JOIN ({_POLICY_SQL}) i ON i.table_name = t.table_name GROUP BY t.table_name")
def status_rollup(spark, sf_dir):
    tables = spark.createDataFrame([("orders",), ("kept",), ("fixed",), ("clean",)], "table_name string")
    return guards.status(duplicate_policy(spark, sf_dir), tables)


_CHANGED = f"price <> coalesce(CASE WHEN lower(trim(price)) NOT IN {_MARKERS} THEN price END, '') OR status IS DISTINCT FROM CASE lower(trim(status)) WHEN 'o' THEN 'Open' WHEN 'f' THEN 'Final' WHEN 'p' THEN 'Pending' ELSE trim(status) END OR priority <> trim(priority) OR currency IS DISTINCT FROM {_code('currency')}"


@query(f"""SELECT left(sha1(concat_ws(chr(31), 'orders_raw', column_name, 'TEXT_VARIANT', concat('Normalized value: ', variant_key))), 12) AS issue_id, column_name, variant_key
    FROM (SELECT column_name, {_key('value')} AS variant_key, count(*) AS c FROM {_ORDER_COUNTS} x WHERE NOT {_missing('value')} GROUP BY 1, 2) k WHERE c > 1""")
def issue_ids(spark, sf_dir):
    found = text_variants(spark, sf_dir).select(
        F.lit("orders_raw").alias("table_name"), "column_name", F.lit("TEXT_VARIANT").alias("issue_type"),
        F.concat(F.lit("Normalized value: "), "variant_key").alias("detail"), "variant_key",
    )
    return reviews.with_issue_ids(found).select("issue_id", "column_name", "variant_key")


@query("""SELECT 'nation' AS table_name, n_name AS source_column, CASE WHEN n_nationkey % 3 = 0 THEN 'integer' ELSE 'string' END AS datatype,
    CASE WHEN n_nationkey % 2 = 0 THEN concat('edited_', n_name) ELSE n_name END AS column_name FROM nation""")
def schema_review_merge(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    proposal = nation.selectExpr("'nation' AS table_name", "n_name AS source_column", "'string' AS datatype", "n_name AS column_name")
    old = nation.selectExpr("'nation' AS table_name", "n_name AS source_column", "CASE WHEN n_nationkey % 3 = 0 THEN 'integer' WHEN n_nationkey % 3 = 1 THEN '' END AS datatype", "CASE WHEN n_nationkey % 2 = 0 THEN concat('edited_', n_name) ELSE '' END AS column_name")
    return reviews.merge_schema(proposal, old)


@query("""SELECT n_name AS issue_id, CASE n_nationkey % 3 WHEN 0 THEN 'FIX' WHEN 1 THEN '' ELSE 'new' END AS decision, 'act' AS action, 'why' AS reason FROM nation""")
def decision_merge(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    review = nation.selectExpr("n_name AS issue_id", "'new' AS decision", "'act' AS action", "'why' AS reason")
    old = nation.selectExpr("n_name AS issue_id", "CASE n_nationkey % 3 WHEN 0 THEN 'FIX' WHEN 1 THEN '' END AS decision", "CAST(NULL AS STRING) AS action", "CAST(NULL AS STRING) AS reason")
    return reviews.merge_decisions(review, old)
