"""More queries of the operators: contracts, proposals, validation, publishing and control files."""

from __future__ import annotations

import tempfile
import uuid
from itertools import combinations
from pathlib import Path

from pyspark.sql import functions as F

from assay.functions import names
from assay.operators import fx, guards, inclusion, keys, profile, transform
from assay.plans import contract as contracts
from assay.plans import proposal
from assay.plans.contract import ColumnSpec, Contract, Conversion, ForeignKey, TableSpec
from assay.queries import (
    _ASOF, _CHANGED, _DOUBLED, _ORDERS, _SILVER, BASE, CONTRACT, ORACLE_SQL, ORDER_TABLE, TX, _boolean, _code, _doubled, _integer, _key,
    _MARKERS, _number, _orders, _rates, _star, _table, _time, query, silver_orders,
)
from assay.sources import files, publish


def _rows(columns: str, *rows: tuple) -> str:
    """SQL of literal rows."""

    def text(x) -> str:
        return "CAST(%d AS BIGINT)" % x if isinstance(x, int) and not isinstance(x, bool) else str(x).lower() if isinstance(x, bool) else "'" + x.replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) t({columns})"


def _texts(spark, column: str, texts: list[str]):
    return spark.createDataFrame([(t,) for t in texts], f"{column} string")


# ------------------------------------------------------------------ types, keys and proposals


@query(f"""SELECT column_name, CASE WHEN effective = 0 OR contains(column_name, '_id') THEN 'string' WHEN column_name = 'is_open' AND flags = effective THEN 'boolean'
    WHEN column_name = 'order_date' AND dates >= 0.8 * effective THEN CASE WHEN times > 0 THEN 'datetime' ELSE 'date' END
    WHEN numbers >= 0.98 * effective THEN CASE WHEN integers >= 0.98 * effective THEN 'integer' ELSE 'decimal' END
    WHEN dates >= 0.95 * effective THEN CASE WHEN times > 0 THEN 'datetime' ELSE 'date' END ELSE 'string' END AS datatype,
    CAST(numbers AS DOUBLE) / effective AS numeric_ratio, CAST(dates AS DOUBLE) / effective AS date_ratio FROM ({ORACLE_SQL["datatype_inference"]}) e""")
def types_suggested(spark, sf_dir):
    return profile.type_proposal(_orders(spark, sf_dir))


_PARTS = {"order_id": "l_orderkey", "part_id": "l_partkey", "supplier_id": "l_suppkey", "line_number": "l_linenumber"}
_COMBOS = [c for n in (1, 2, 3) for c in combinations(_PARTS, n)]
_FIRST_KEY = " ".join(
    f"WHEN (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_PARTS[c] for c in combo)} FROM lineitem)) = (SELECT count(*) FROM lineitem) THEN '{'+'.join(combo)}'" for combo in _COMBOS
)
#: All columns of each table; those that aren't renamed have no name of a part of a key.
_WHOLE = {"lineitem": {c: n for n, c in _PARTS.items()}, "orders": {"o_orderkey": "order_id", "o_custkey": "customer_id"}, "nations": {"n_nationkey": "nation_id", "n_regionkey": "region_id"}}


def _whole(spark, sf_dir, name: str):
    df = _table(spark, sf_dir, name.removesuffix("s") if name == "nations" else name)
    return df.withColumnsRenamed(_WHOLE[name])


@query(f"""SELECT 'lineitem' AS table_name, CASE {_FIRST_KEY} ELSE '' END AS primary_key UNION ALL SELECT 'orders', CASE WHEN count(DISTINCT o_orderkey) = count(*) THEN 'order_id' ELSE '' END FROM orders
    UNION ALL SELECT 'nations', CASE WHEN count(DISTINCT n_nationkey) = count(*) THEN 'nation_id' ELSE '' END FROM nation""")
def primary_keys_suggested(spark, sf_dir):
    return spark.createDataFrame([(n, "+".join(keys.suggest_primary_key(_whole(spark, sf_dir, n)))) for n in _WHOLE], "table_name string, primary_key string")


_ITEM_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


def _is_key(combo: tuple[str, ...]) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(combo)} FROM lineitem)) = (SELECT count(*) FROM lineitem)"


_ITEM_COMBOS = [c for n in (1, 2, 3) for c in combinations(_ITEM_COLUMNS, n)]


@query(f"""WITH tried AS ({" UNION ALL ".join(f"SELECT '{'+'.join(c)}' AS combo, {len(c)} AS parts, {_is_key(c)} AS is_key" for c in _ITEM_COMBOS)})
    SELECT combo FROM tried t WHERE is_key AND NOT EXISTS (SELECT 1 FROM tried s WHERE s.is_key AND s.parts < t.parts
    AND list_has_all(string_split(t.combo, '+'), string_split(s.combo, '+')))""")
def minimal_keys(spark, sf_dir):
    """All minimal keys of up to three columns of the whole of lineitem."""
    found = keys.minimal_keys(_table(spark, sf_dir, "lineitem"))
    return spark.createDataFrame([("+".join(c),) for c in found], "combo string")


_STAR_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "lineitem": " ".join(_ITEM_COLUMNS),
}


def _inclusions(tables: dict[str, str]) -> str:
    cells = " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, {_key(f'CAST({c} AS VARCHAR)')} AS k FROM {t}" for t, columns in tables.items() for c in columns.split())
    return f"""WITH cell AS (SELECT t, c, k, count(*) AS n FROM ({cells}) WHERE k <> '' GROUP BY t, c, k),
    own AS (SELECT t, c, sum(n) AS total, max(n) = 1 AS is_unique FROM cell GROUP BY t, c)
    SELECT a.t AS child_table, a.c AS child_column, b.t AS parent_table, b.c AS parent_column, CAST(any_value(x.total) AS BIGINT) AS total_rows, CAST(sum(a.n) AS BIGINT) AS matched_rows,
    CAST(sum(a.n) AS DOUBLE) / CAST(any_value(x.total) AS DOUBLE) AS match_rate, any_value(y.is_unique) AS parent_unique
    FROM cell a JOIN cell b ON a.k = b.k AND a.t <> b.t JOIN own x ON x.t = a.t AND x.c = a.c JOIN own y ON y.t = b.t AND y.c = b.c GROUP BY a.t, a.c, b.t, b.c"""


@query(_inclusions(_STAR_COLUMNS))
def inclusion_dependencies(spark, sf_dir):
    return inclusion.dependencies({t: _table(spark, sf_dir, t) for t in _STAR_COLUMNS})


@query(f"""SELECT child_table, child_column, min_by(parent_table, rank) AS parent_table, min_by(parent_column, rank) AS parent_column, max(match_rate) AS match_rate
    FROM (SELECT *, row_number() OVER (ORDER BY match_rate DESC, parent_table, parent_column) AS rank FROM ({_inclusions(_STAR_COLUMNS)}) WHERE parent_unique AND match_rate >= 0.8) GROUP BY child_table, child_column""")
def references_found(spark, sf_dir):
    """References between tables whose columns share no names."""
    return inclusion.proposed(inclusion_dependencies(spark, sf_dir))


_PROPOSED = (
    ("orders", "order_id", "string", "True", "", "orders"), ("orders", "customer_id", "string", "False", "customers.customer_id", "orders"), ("orders", "o_orderstatus", "string", "False", "", "orders"),
    ("orders", "o_totalprice", "decimal", "False", "", "orders"), ("orders", "o_orderdate", "datetime", "False", "", "orders"), ("orders", "o_orderpriority", "string", "False", "", "orders"),
    ("customers", "customer_id", "string", "True", "", "customer"), ("customers", "c_name", "string", "False", "", "customer"), ("customers", "nation_id", "string", "False", "nations.nation_id", "customer"),
    ("customers", "c_acctbal", "decimal", "False", "", "customer"), ("customers", "c_mktsegment", "string", "False", "", "customer"),
    ("nations", "nation_id", "string", "True", "", "nation"), ("nations", "n_name", "string", "False", "", "nation"), ("nations", "region_id", "string", "False", "", "nation"),
)


@query(" UNION ALL ".join(f"""SELECT '{t}' AS table_name, '{t}' AS silver_table_name, 'False' AS allow_no_primary_key, '{c}' AS source_column, '{c}' AS column_name, '{kind}' AS datatype,
    CASE WHEN count({column}) < count(*) THEN 'True' ELSE 'False' END AS nullable, '{pk}' AS is_pk, '{'1' if pk == 'True' else ''}' AS pk_order, '{bool(fk)}' AS is_fk, '{fk}' AS fk_reference, CAST(count(*) AS VARCHAR) AS row_count,
    CAST((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM {source} GROUP BY ALL HAVING count(*) > 1)) AS VARCHAR) AS duplicate_row_count FROM {source}""".replace("SELECT count(*) AS c FROM", "SELECT *, count(*) AS c FROM") for t, c, kind, pk, fk, source in _PROPOSED for column in [{"order_id": "o_orderkey", "customer_id": "o_custkey" if t == "orders" else "c_custkey", "nation_id": "c_nationkey" if t == "customers" else "n_nationkey", "region_id": "n_regionkey"}.get(c, c)]))
def schema_proposal(spark, sf_dir):
    return proposal.as_frame(spark, proposal.propose(_star(spark, sf_dir)[0]))


@query(" UNION ALL ".join(f"""SELECT '{t}' AS table_name, '{k}' AS primary_key, CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS duplicate_groups, CAST(0 AS BIGINT) AS duplicate_rows,
    CAST(0 AS BIGINT) AS normalized_duplicate_groups, 'OK' AS status""" for t, k in (("orders", "order_id"), ("customers", "customer_id"), ("nations", "nation_id"))))
def key_proposal(spark, sf_dir):
    return proposal.key_rows(*_star(spark, sf_dir))


# ------------------------------------------------------------------ rates, guards, validation


@query(f"""SELECT currency, date, rate FROM (SELECT *, row_number() OVER (PARTITION BY currency, date ORDER BY place DESC, rate DESC) AS i FROM
    (SELECT {_code('currency')} AS currency, CAST({_time('order_date')} AS DATE) AS date, {_number('price')} AS rate, CAST(order_id AS BIGINT) AS place FROM {_ORDERS} o)
    WHERE currency IS NOT NULL AND date IS NOT NULL AND rate IS NOT NULL) WHERE i = 1""")
def fx_rates_prepared(spark, sf_dir):
    rows = _orders(spark, sf_dir).withColumn("place", F.col("order_id").cast("bigint"))
    return fx.prepare_rates(rows, "order_date", "currency", "price", order_col="place")


_SPENT = TableSpec(
    "tx_raw", "tx", tuple(ColumnSpec(n, n, kind) for n, kind in (("order_id", "integer"), ("currency", "string"), ("day", "date"), ("amount", "decimal"))),
    ("order_id",), conversions=(Conversion("amount", "currency", "day", "amount_base", "fx_rate"),),
)


@query(f"""SELECT '51002' AS code, 'fx_rate' AS column_name, count(*) FILTER (WHERE amount IS NOT NULL AND currency IS NOT NULL AND fx_rate IS NULL) AS bad_rows FROM {_ASOF} a
    UNION ALL SELECT '51001', c, 0 FROM (VALUES ('order_id'), ('day'), ('amount')) t(c) UNION ALL SELECT '51004', 'order_id', 0
    UNION ALL SELECT '51005', 'order_id', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def missing_rate_guard(spark, sf_dir):
    raw = _table(spark, sf_dir, "orders").selectExpr(*TX).select(*[F.col(c).cast("string") for c in ("order_id", "currency", "day", "amount")])
    contract = Contract((_SPENT,), base_currency=BASE)
    return guards.guard_counts(transform.typed_with_cleaned(raw, _SPENT, contract, _rates(spark, sf_dir)), _SPENT)


_CHILD = TableSpec(
    "child_raw", "child",
    (ColumnSpec("order_id", "order_id", "integer", False), ColumnSpec("customer_id", "customer_id", "integer"), ColumnSpec("price", "price", "decimal"), ColumnSpec("units", "units", "integer")),
    ("order_id",), (ForeignKey("customer_id", "parent_raw", "customer_id"), ForeignKey("price", "gone_raw", "x")),
)
_PARENT = TableSpec("parent_raw", "parent", (ColumnSpec("customer_id", "customer_id", "integer", False),), ())
_CHILD_SQL = f"(SELECT CASE WHEN o_orderkey % 100 <> 0 THEN CAST(o_orderkey AS BIGINT) END AS order_id, CAST(o_custkey AS BIGINT) AS customer_id, CAST(1 AS DOUBLE) AS price FROM {_DOUBLED} d)"
_PARENT_SQL = "(SELECT CAST(c_custkey AS BIGINT) AS customer_id FROM customer WHERE c_custkey % 7 <> 0)"
_TWICE_SQL = f"(SELECT order_id, count(*) AS c FROM {_CHILD_SQL} x WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


def _issue_sql(table: str, column: str, kind: str, count: str, source: str, example: str = "''", severity: str = "FAIL") -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS issue_type, CAST({count} AS BIGINT) AS issue_count, {example} AS example, '{severity}' AS severity {source}"


def _first_five(x: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct(list(CAST({x} AS VARCHAR))))[1:5], ' | '), '')"


@query("SELECT * FROM (" + " UNION ALL ".join((
    _issue_sql("child", "units", "MISSING_REQUIRED_COLUMN", "1", ""), _issue_sql("child", "price", "DATATYPE_VALIDATION", "1", "", "'double'"),
    _issue_sql("child", "order_id", "NON_NULLABLE_HAS_NULL", "count(*)", f"FROM {_CHILD_SQL} x WHERE order_id IS NULL"), _issue_sql("child", "order_id", "PK_NULL", "count(*)", f"FROM {_CHILD_SQL} x WHERE order_id IS NULL"),
    _issue_sql("child", "order_id", "PK_DUPLICATE", "sum(c)", f"FROM {_TWICE_SQL} x", _first_five("order_id")),
    _issue_sql("child", "customer_id", "FK_ORPHAN", "count(*)", f"FROM {_CHILD_SQL} x WHERE customer_id NOT IN (SELECT customer_id FROM {_PARENT_SQL} p)", _first_five("customer_id")),
    _issue_sql("child", "price", "FK_PARENT_MISSING", "1", "", "'gone_raw'"),
    _issue_sql("child", "", "EXACT_DUPLICATE_UNDECIDED", "sum(c)", f"FROM (SELECT count(*) AS c FROM {_CHILD_SQL} x GROUP BY order_id, customer_id, price HAVING count(*) > 1)"),
    _issue_sql("parent", "", "NO_REVIEWED_PRIMARY_KEY", "1", ""),
)) + ") WHERE issue_count > 0")
def validation_issues(spark, sf_dir):
    child = _doubled(spark, sf_dir).selectExpr("CASE WHEN o_orderkey % 100 <> 0 THEN CAST(o_orderkey AS BIGINT) END AS order_id", "CAST(o_custkey AS BIGINT) AS customer_id", "CAST(1 AS DOUBLE) AS price")
    parent = _table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").selectExpr("CAST(c_custkey AS BIGINT) AS customer_id")
    return guards.validate_all({"child": child, "parent": parent}, Contract((_CHILD, _PARENT)))


@query(f"""SELECT 'child' AS table_name, "check", subject, CAST(n AS BIGINT) AS n FROM (SELECT 'ROWS' AS "check", '' AS subject, count(*) AS n FROM {_CHILD_SQL} x
    UNION ALL SELECT 'REPEATED_KEYS', 'order_id', count(*) FROM (SELECT order_id FROM {_CHILD_SQL} x GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'ORPHANS', 'customer_id -> parent', count(*) FROM {_CHILD_SQL} x WHERE customer_id NOT IN (SELECT customer_id FROM {_PARENT_SQL} p)) s
    UNION ALL SELECT 'parent', 'ROWS', '', count(*) FROM {_PARENT_SQL} p""")
def post_build_report(spark, sf_dir):
    child = _doubled(spark, sf_dir).selectExpr("CASE WHEN o_orderkey % 100 <> 0 THEN CAST(o_orderkey AS BIGINT) END AS order_id", "CAST(o_custkey AS BIGINT) AS customer_id", "CAST(1 AS DOUBLE) AS price")
    parent = _table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").selectExpr("CAST(c_custkey AS BIGINT) AS customer_id")
    return guards.post_build({"child": child, "parent": parent}, Contract((_CHILD, _PARENT)))


_SILVER_COLUMNS = [c.name for c in ORDER_TABLE.columns]


def _nulls(columns: list[str]) -> str:
    return " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in columns)


_BAD = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in (
    f"{_integer('order_id')} IS NULL", f"lower(trim(price)) NOT IN {_MARKERS} AND {_number('price')} IS NULL", f"{_time('order_date')} IS NULL",
    f"is_open IS NOT NULL AND {_boolean('is_open')} IS NULL", f"{_integer('units')} IS NULL",
))
_REVIEW = f"""SELECT 'orders' AS table_name, count(*) AS input_rows, (SELECT count(*) FROM ({_SILVER}) s) AS output_rows, count(*) FILTER (WHERE {_CHANGED}) AS changed_rows,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_ORDERS} o)) AS duplicate_before, CAST(0 AS BIGINT) AS duplicate_after,
    CAST(sum({_nulls(_SILVER_COLUMNS)}) AS BIGINT) AS null_before, (SELECT CAST(sum({_nulls(_SILVER_COLUMNS)}) AS BIGINT) FROM ({_SILVER}) s) AS null_after, CAST(sum({_BAD}) AS BIGINT) AS invalid_before,
    (SELECT 1 + count(*) FILTER (WHERE order_date IS NULL) + count(*) FILTER (WHERE currency IS NOT NULL AND NOT regexp_full_match(currency, '[A-Z]{{3}}')) FROM ({_SILVER}) s) AS invalid_after,
    'FAIL' AS status FROM {_ORDERS} o"""


@query(_REVIEW)
def before_after(spark, sf_dir):
    return guards.review({"orders_raw": _orders(spark, sf_dir)}, CONTRACT, {"orders": silver_orders(spark, sf_dir)})


@query(f"SELECT table_name, input_rows, output_rows, changed_rows, input_rows - output_rows AS removed_duplicates, status FROM ({_REVIEW}) r")
def standardization_summary(spark, sf_dir):
    return guards.summary(before_after(spark, sf_dir))


@query(f"""SELECT 'copies' AS table_name, (SELECT count(*) FROM {_DOUBLED} d) AS input_rows, (SELECT count(*) FROM {_DOUBLED} d) - count(*) AS removed_rows, count(*) AS remaining_rows,
    CAST(coalesce(sum(c) FILTER (WHERE i = 1 AND c > 1), 0) AS BIGINT) AS duplicate_key_rows
    FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS c, row_number() OVER (PARTITION BY o_custkey) AS i FROM (SELECT DISTINCT o_orderkey, o_custkey FROM {_DOUBLED} d))""")
def duplicate_report(spark, sf_dir):
    raw = _doubled(spark, sf_dir).selectExpr("CAST(o_orderkey AS STRING) AS order_id", "CAST(o_custkey AS STRING) AS customer_id")
    table = TableSpec("copies_raw", "copies", (ColumnSpec("order_id", "order_id", "integer"), ColumnSpec("customer_id", "customer_id", "integer")), ("customer_id",), decisions=ORDER_TABLE.decisions[-1:])
    return guards.duplicate_report(raw, table, Contract((table,)))


# ------------------------------------------------------------------ publishing

_NATIONS = TableSpec("nation_raw", "nations", (ColumnSpec("n_nationkey", "nation_id", "integer", False), ColumnSpec("n_name", "name", "string"), ColumnSpec("n_regionkey", "region_id", "integer")), ("nation_id",), (ForeignKey("region_id", "region_raw", "region_id"),))
_REGIONS = TableSpec("region_raw", "regions", (ColumnSpec("r_regionkey", "region_id", "integer", False), ColumnSpec("r_name", "name", "string")), ("region_id",))


@query("""SELECT 'nations' AS table_name, 'ROWS' AS "check", '' AS subject, count(*) AS n FROM nation UNION ALL SELECT 'regions', 'ROWS', '', count(*) FROM region
    UNION ALL SELECT t, 'REPEATED_KEYS', s, 0 FROM (VALUES ('nations', 'nation_id'), ('regions', 'region_id')) v(t, s) UNION ALL SELECT 'nations', 'ORPHANS', 'region_id -> regions', 0
    UNION ALL SELECT '', 'REFUSED', '51000 nations, regions', 1 UNION ALL SELECT '', 'NOTHING_LEFT', '', 0""")
def published(spark, sf_dir):
    """Published, refused, published over, and looked at; the database of this run goes again."""
    contract, database = Contract((_REGIONS, _NATIONS)), f"assay_{uuid.uuid4().hex}"
    raw = {f"{t}_raw": files.as_text(_table(spark, sf_dir, t)) for t in ("nation", "region")}
    try:
        publish.publish(spark, raw, contract, database)
        try:
            publish.publish(spark, raw, contract, database)
            refused = ""
        except guards.GuardError as error:
            code, *existing = str(error).replace(",", "").split()
            refused = f"{code} {', '.join(sorted(existing))}"
        publish.publish(spark, raw, contract, database, overwrite=True)
        typed = {n: spark.table(f"{database}.{n}") for n in ("nations", "regions")}
        rows = [tuple(r) for r in guards.post_build(typed, contract).collect()]
        # Temporary views of the session are shown in every database.
        extra = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").count() - len(typed)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return spark.createDataFrame([*rows, ("", "REFUSED", refused, 1), ("", "NOTHING_LEFT", "", extra)], "table_name string, check string, subject string, n bigint")
