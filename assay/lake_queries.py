"""Queries of names, control files and reviews, as rows of a lake's catalog: derived from the given
tables, a review row from each customer, a decision from each order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assay.functions import names
from assay.operators import profile, reviews
from assay.plans import review_frames as frames
from assay.plans.contract import SCHEMA_FIELDS
from assay.publish_queries import _database
from assay.queries import _CUSTOMER, _ORDER_COUNTS, _SILVER, CONTRACT, ORDER_TABLE, _customer, _key, _missing, _orders, _sum, _table, query
from assay.sources import files, publish

# ------------------------------------------------------------------ names

_GIVEN = """CASE p_partkey % 6 WHEN 0 THEN concat(p_name, ' Raw') WHEN 1 THEN concat(lower(replace(p_brand, '#', '_')), '_currency') WHEN 2 THEN concat('a`', p_type, '  c')
    WHEN 3 THEN concat(lower(replace(p_type, ' ', '_')), '_raw') WHEN 4 THEN concat(' fee--', CAST(p_size AS STRING), '_per_currency') ELSE concat('it''s ', chr(92), p_name) END"""
_PARTS = f"(SELECT p_partkey, {_GIVEN} AS given FROM part)"
_NAMED = r"regexp_replace(regexp_replace(lower(given), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(rf"""SELECT p_partkey, given, regexp_replace(regexp_replace({_NAMED}, '_raw$', ''), '_+$', '') AS column_name, regexp_replace(given, '_raw$', '') AS table_name,
    given IN ('currency', 'currency_code') OR suffix(given, '_currency_code') OR (suffix(given, '_currency') AND NOT suffix(given, '_per_currency')) AS currency,
    concat('`', replace(given, '`', '``'), '`') AS quoted, concat('-- ', trim(regexp_replace(given, '\s+', ' ', 'g'))) AS commented FROM {_PARTS} p""")
def names_report(spark, sf_dir):
    given = F.col("given")
    return _table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_GIVEN} AS given").select(
        "p_partkey", "given", names.column_names(given).alias("column_name"), names.table_names(given).alias("table_name"), names.are_currency_columns(given).alias("currency"),
        names.quoted_names(given).alias("quoted"), names.comments(given).alias("commented"),
    )


@query(f"""SELECT p_partkey, concat('fk_', regexp_replace(given, '[^0-9A-Za-z]', '_', 'g'), '_x') AS short,
    concat(repeat('y', 111), '_', left(sha1(repeat('y', 150) || '_' || regexp_replace(given, '[^0-9A-Za-z]', '_', 'g')), 8)) AS long FROM {_PARTS} p""")
def constraint_names(spark, sf_dir):
    given = F.col("given")
    short, long = names.constraint_names(F.lit("fk"), given, F.lit("x")), names.constraint_names(F.lit("y" * 150), given)
    return _table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_GIVEN} AS given").select("p_partkey", short.alias("short"), long.alias("long"))


@query(f"SELECT p_partkey, concat('''', replace(replace(given, chr(92), chr(92) || chr(92)), '''', chr(92) || ''''), '''') AS literal FROM {_PARTS} p")
def literals(spark, sf_dir):
    return _table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_GIVEN} AS given").select("p_partkey", names.literals(F.col("given")).alias("literal"))


# ------------------------------------------------------------------ control files and sources


@query(" UNION ALL ".join(f"SELECT '{kind}' AS kind, customer_id, name, segment, nation_code, remark FROM {_CUSTOMER} c" for kind in ("csv", "json")))
def control_files(spark, sf_dir):
    """The dirty customers as CSV and as JSON lines, written to the warehouse and read again: tabs, blanks
    and nulls stay what they are."""
    rows = _customer(spark, sf_dir).select("customer_id", "name", "segment", "nation_code", "remark")
    parts = []
    for kind in ("csv", "json"):
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/assay_{uuid.uuid4().hex}"
        files.write_table(rows, folder, kind)
        parts.append(files.read_table(spark, folder, kind).select(F.lit(kind).alias("kind"), *rows.columns))
    return parts[0].unionByName(parts[1])


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, 'FOUND' AS status, count(*) AS row_count, CAST({n} AS INTEGER) AS column_count FROM {t}" for t, n in (("orders", 6), ("lineitem", 11), ("customer", 5), ("part", 6))) + " UNION ALL SELECT 'nowhere', 'MISSING', 0, 0")
def source_checks(spark, sf_dir):
    return files.inventory(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "part", "nowhere")})


_TYPES = {"order_id": "bigint", "customer_id": "varchar(100)", "status": "string", "price": "decimal(38,10)", "order_date": "date", "priority": "string", "is_open": "boolean", "units": "bigint", "currency": "string"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{kind}' AS datatype, {str(c not in ('order_id', 'customer_id', 'order_date')).lower()} AS nullable, count(*) AS n_rows, count({c}) AS n_values FROM ({_SILVER}) s" for c, kind in _TYPES.items()))
def target_schema(spark, sf_dir):
    """The typed orders' columns as the catalog has them, and how many values each holds."""
    with _database(spark) as database:
        root = publish.root_of(spark, database)
        written = publish.write_guarded(_orders(spark, sf_dir), ORDER_TABLE, CONTRACT, f"{root}/orders")
        described = publish.entry(ORDER_TABLE, CONTRACT, written)
        publish.point(spark, database, "orders", described, 1)
        kinds = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE {database}.orders").collect()}
        required = {c for c, _, nullable in described["columns"] if not nullable}
        row = spark.table(f"{database}.orders").agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in kinds]).first()
    return spark.createDataFrame([(c, kind, c not in required, row["n"], row[c]) for c, kind in kinds.items()], "column_name string, datatype string, nullable boolean, n_rows bigint, n_values bigint")


# ------------------------------------------------------------------ reviews

_REVIEW = [
    "concat('t', CAST(c_nationkey AS STRING)) AS table_name",
    "CASE WHEN c_nationkey % 5 = 0 AND c_custkey % 40 = 1 THEN '' ELSE concat('s', CAST(c_nationkey AS STRING)) END AS silver_table_name",
    "CASE c_nationkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN ' No ' ELSE CASE c_custkey % 20 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'perhaps' END END AS allow_no_primary_key",
    "CASE c_custkey % 60 WHEN 0 THEN 'same' ELSE lower(c_name) END AS source_column",
    "CASE c_custkey % 45 WHEN 0 THEN 'again' WHEN 1 THEN '' ELSE concat('c', CAST(c_custkey AS STRING)) END AS column_name",
    "CASE c_custkey % 6 WHEN 0 THEN 'int' WHEN 1 THEN ' Money ' WHEN 2 THEN 'blob' WHEN 3 THEN 'date' WHEN 4 THEN 'BOOL' ELSE 'text' END AS datatype",
    "CASE c_custkey % 7 WHEN 0 THEN 'maybe' WHEN 1 THEN 'Y' END AS nullable",
    "CASE WHEN c_nationkey % 4 = 1 THEN '' WHEN c_custkey % 9 = 0 THEN 'true' WHEN c_custkey % 9 = 1 THEN 'x' ELSE 'n' END AS is_pk",
    "CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '3.0' WHEN 2 THEN 'last' END AS pk_order",
    "CASE c_custkey % 8 WHEN 0 THEN '1' WHEN 1 THEN 'true' WHEN 3 THEN 'hm' ELSE 'false' END AS is_fk",
    "CASE c_custkey % 8 WHEN 0 THEN concat('S', CAST((c_nationkey + c_custkey % 16) % 25 AS STRING), '.C', CAST(c_custkey AS STRING)) WHEN 1 THEN 'nowhere' WHEN 2 THEN 'u.v' END AS fk_reference",
]
_DECIDED = [
    "CAST(o_orderkey AS STRING) AS issue_id", "concat(CASE o_orderkey % 2 WHEN 0 THEN 'T' ELSE 's' END, CAST(o_custkey % 27 AS STRING)) AS table_name",
    "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'same' ELSE concat('C', CAST(o_custkey AS STRING)) END AS column_name", "CASE o_orderkey % 3 WHEN 0 THEN 'whitespace' ELSE 'MISSING_VALUE' END AS issue_type",
    "CASE o_orderkey % 7 WHEN 0 THEN 'odd' ELSE 'standardize_text' END AS suggested_action", "CASE o_orderkey % 5 WHEN 0 THEN 'fix' WHEN 1 THEN 'KEEP' WHEN 2 THEN ' Block' WHEN 3 THEN 'later' END AS decision",
    "CASE o_orderkey % 11 WHEN 0 THEN 'run' WHEN 1 THEN 'review_only' END AS action", "CASE o_orderkey % 13 WHEN 0 THEN 'why' END AS reason",
]


def _texts(expressions: list[str], source: str) -> str:
    columns = [e.rsplit(" AS ", 1)[1] for e in expressions]
    return f"(SELECT {', '.join(f'''coalesce(trim({c}), '') AS {c}''' for c in columns)} FROM (SELECT {', '.join(expressions)} FROM {source}))"


def _review(spark, sf_dir):
    return _table(spark, sf_dir, "customer").selectExpr(*_REVIEW)


def _decisions(spark, sf_dir):
    return _table(spark, sf_dir, "orders").selectExpr(*_DECIDED)


_R, _D = _texts(_REVIEW, "customer"), _texts(_DECIDED, "orders")


def _flag(c: str) -> str:
    return f"CASE WHEN lower({c}) IN ('true', '1', 'yes', 'y') THEN true WHEN lower({c}) IN ('false', '0', 'no', 'n', '') THEN false END"


_IS_FK, _IS_PK, _KEYLESS = (f"coalesce({_flag(c)}, false)" for c in ("is_fk", "is_pk", "allow_no_primary_key"))
_WHERE = "table_name || '.' || source_column || ': '"
_REFERENCE = r"regexp_extract(fk_reference, '^(.+)\.([^.]+)$', {})"
_KINDS = "'string', 'integer', 'decimal', 'date', 'datetime', 'boolean', 'str', 'text', 'int', 'bigint', 'float', 'numeric', 'money', 'timestamp', 'bool'"


def _wrong(message: str, condition: str, source: str = "r") -> str:
    return f"SELECT table_name, {message} AS error FROM {source} WHERE {condition}"


def _no_flag(c: str, where: str = _WHERE) -> str:
    return _wrong(f"{where} || '{c}: ''' || {c} || ''' is neither true nor false'", f"({_flag(c)}) IS NULL")


def _again(what: str, c: str) -> str:
    twice = f"(SELECT table_name, {c} FROM r WHERE {c} <> '' GROUP BY table_name, {c} HAVING count(*) > 1)"
    return f"SELECT table_name, table_name || ': {what} columns twice: ' || string_agg({c}, ', ' ORDER BY {c}) AS error FROM {twice} GROUP BY table_name"


_NUMBERED = r"regexp_full_match(pk_order, '[+-]?(\d+(\.\d*)?|\.\d+)')"


@query(f"""WITH r AS {_R}, t AS (SELECT table_name, count(*) FILTER ({_IS_PK}) AS keys, bool_or({_KEYLESS}) AS one, bool_and({_KEYLESS}) AS every FROM r GROUP BY table_name),
    target AS (SELECT DISTINCT p, unnest([lower(source_column), lower(column_name)]) AS pc FROM (SELECT *, unnest([lower(table_name), lower(silver_table_name)]) AS p FROM r)),
    named AS (SELECT *, {_REFERENCE.format(1)} AS parent, {_REFERENCE.format(2)} AS parent_column FROM r WHERE {_IS_FK} AND fk_reference <> ''),
    silver AS (SELECT table_name, list_sort(list(DISTINCT silver_table_name)) AS x FROM r GROUP BY table_name)
    """ + " UNION ALL ".join((
    _wrong(f"{_WHERE} || 'blank column name'", "source_column = '' OR column_name = ''"), _wrong(f"{_WHERE} || 'unknown data type ''' || datatype || ''''", f"lower(datatype) NOT IN ({_KINDS})"),
    _no_flag("nullable"), _no_flag("is_pk"), _no_flag("is_fk"), _no_flag("allow_no_primary_key", "table_name || ': '"),
    _wrong(f"{_WHERE} || 'pk_order: ''' || pk_order || ''' is no position'", f"{_IS_PK} AND pk_order <> '' AND NOT ({_NUMBERED} AND coalesce(floor(TRY_CAST(pk_order AS DOUBLE)) >= 1, false))"),
    _wrong(f"{_WHERE} || 'is_fk and fk_reference disagree'", f"{_IS_FK} <> (fk_reference <> '')"), _wrong(f"{_WHERE} || 'fk_reference ''' || fk_reference || ''' isn''t table.column'", "parent = ''", "named"),
    _wrong(f"{_WHERE} || 'no ' || parent || '.' || parent_column", "parent <> '' AND NOT EXISTS (SELECT 1 FROM target WHERE p = lower(parent) AND pc = lower(parent_column))", "named"),
    _again("source", "source_column"), _again("target", "column_name"),
    _wrong("table_name || ': needs one target name, has [' || array_to_string(list_transform(x, lambda y: '''' || y || ''''), ', ') || ']'", "len(x) <> 1 OR x[1] = ''", "silver"),
    _wrong("table_name || ': allow_no_primary_key differs between rows'", "one <> every", "t"), _wrong("table_name || ': no primary key, and none isn''t allowed'", "keys = 0 AND NOT every", "t"),
)))
def schema_errors(spark, sf_dir):
    return frames.schema_errors(_review(spark, sf_dir))


_COLUMN_OF = "(SELECT DISTINCT t, unnest([lower(source_column), lower(column_name)]) AS c FROM (SELECT *, unnest([lower(table_name), lower(silver_table_name)]) AS t FROM r))"
_AT = "'decision ' || issue_id || ' (' || table_name || '.' || column_name || ' ' || issue_type || '): '"
_DID = "CASE WHEN action <> '' THEN upper(action) ELSE upper(suggested_action) END"


@query(f"""WITH r AS {_R}, place AS (SELECT DISTINCT unnest([lower(table_name), lower(silver_table_name)]) AS t FROM r), col AS {_COLUMN_OF},
    d AS (SELECT *, upper(decision) AS verdict, {_DID} AS did, lower(table_name) IN (SELECT t FROM place) AS known FROM {_D} x)
    """ + " UNION ALL ".join((
    _wrong(f"{_AT} || 'unknown table'", "NOT known", "d"), _wrong(f"{_AT} || 'unknown column'", "known AND column_name <> '' AND NOT EXISTS (SELECT 1 FROM col WHERE t = lower(table_name) AND c = lower(column_name))", "d"),
    _wrong(f"{_AT} || 'decision ''' || decision || ''' is none of FIX, KEEP, BLOCK'", "known AND verdict NOT IN ('FIX', 'KEEP', 'BLOCK')", "d"),
    _wrong(f"{_AT} || 'unknown action ''' || did || ''''", "known AND verdict = 'FIX' AND did NOT IN ('STANDARDIZE_NULL_MARKERS', 'REMOVE_EXACT_DUPLICATES', 'APPLY_VALUE_MAPPING', 'STANDARDIZE_TEXT', 'REVIEW_SCHEMA', 'REVIEW_SCHEMA_DATATYPE', 'REVIEW_ONLY')", "d"),
    _wrong(f"{_AT} || verdict || ' needs a reason'", "known AND verdict <> 'FIX' AND reason = ''", "d"),
)))
def decision_errors(spark, sf_dir):
    return frames.decision_errors(_decisions(spark, sf_dir), _review(spark, sf_dir))


@query(f"""WITH r AS {_R}, src AS (SELECT DISTINCT concat('t', CAST(s_nationkey AS VARCHAR)) AS table_name, lower(replace(s_name, 'Supplier', 'Customer')) AS source_column FROM supplier)
    SELECT table_name, table_name || '.' || column_name || ' ' || upper(issue_type) || ': ' || reason AS error FROM {_D} d WHERE upper(decision) = 'BLOCK'
    UNION ALL SELECT DISTINCT table_name, table_name || ': no such table' FROM r WHERE table_name NOT IN (SELECT table_name FROM src)
    UNION ALL SELECT DISTINCT table_name, table_name || '.' || source_column || ': no such column' FROM r WHERE table_name IN (SELECT table_name FROM src) AND NOT EXISTS (SELECT 1 FROM src s WHERE s.table_name = r.table_name AND s.source_column = r.source_column)""")
def contract_checks(spark, sf_dir):
    """What blocks a publish, and reviewed tables and columns that the sources don't have."""
    sources = _table(spark, sf_dir, "supplier").selectExpr("concat('t', CAST(s_nationkey AS STRING)) AS table_name", "lower(replace(s_name, 'Supplier', 'Customer')) AS source_column")
    return frames.blocking(_decisions(spark, sf_dir)).unionByName(frames.missing_columns(_review(spark, sf_dir), sources))


@query(f"""WITH r AS {_R}, col AS (SELECT DISTINCT silver_table_name, column_name, p, unnest([lower(source_column), lower(column_name)]) AS pc FROM (SELECT *, unnest([lower(table_name), lower(silver_table_name)]) AS p FROM r))
    SELECT DISTINCT r.silver_table_name AS table_name, r.column_name, col.silver_table_name AS parent_table, col.column_name AS parent_column
    FROM r JOIN col ON col.p = lower({_REFERENCE.format(1)}) AND col.pc = lower({_REFERENCE.format(2)}) WHERE {_IS_FK}""")
def relationships(spark, sf_dir):
    return frames.relationships(_review(spark, sf_dir))


_KIND = "CASE lower(datatype) WHEN 'int' THEN 'integer' WHEN 'money' THEN 'decimal' WHEN 'bool' THEN 'boolean' WHEN 'date' THEN 'date' ELSE 'string' END"
_PLACE = f"CASE WHEN {_NUMBERED} AND TRY_CAST(pk_order AS DOUBLE) >= 1 THEN CAST(floor(CAST(pk_order AS DOUBLE)) AS BIGINT) ELSE 0 END"


@query(f"""WITH r AS {_R} SELECT table_name, CAST(0 AS INTEGER) AS place, table_name || ' -> ' || silver_table_name || ' (key: ' || coalesce(string_agg(column_name, ', ' ORDER BY {_PLACE}, column_name) FILTER ({_IS_PK}), 'none') || ')' AS line
    FROM r GROUP BY table_name, silver_table_name UNION ALL SELECT table_name, CAST(row_number() OVER (PARTITION BY table_name ORDER BY source_column, column_name) AS INTEGER),
    '  ' || source_column || ' -> ' || column_name || ': ' || {_KIND} || CASE WHEN coalesce({_flag("nullable")}, false) THEN '' ELSE ' not null' END FROM r""")
def contract_described(spark, sf_dir):
    return frames.described(_review(spark, sf_dir))


@query(f"""WITH r AS {_R} SELECT table_name, source_column, column_name, CASE WHEN lower(datatype) IN ({_KINDS}) THEN {_KIND} END AS logical, {_flag("nullable")} AS nullable,
    CASE WHEN {_NUMBERED} AND floor(TRY_CAST(pk_order AS DOUBLE)) >= 1 THEN CAST(floor(CAST(pk_order AS DOUBLE)) AS BIGINT) END AS place FROM r""")
def review_values(spark, sf_dir):
    """Types, flags and positions of a review as what they mean; null where they mean nothing."""
    r = frames._clean(_review(spark, sf_dir), SCHEMA_FIELDS)
    return r.select("table_name", "source_column", "column_name", frames.logical_type(F.col("datatype")).alias("logical"), frames.flag(F.col("nullable")).alias("nullable"), frames.position(F.col("pk_order")).alias("place"))


_ACTIONS = {"TEXT_VARIANT": "APPLY_VALUE_MAPPING", "WHITESPACE": "STANDARDIZE_TEXT", "MISSING_VALUE": "STANDARDIZE_NULL_MARKERS"}


@query(f"""SELECT left(sha1(concat_ws(chr(31), 'orders_raw', column_name, kind, CASE kind WHEN 'TEXT_VARIANT' THEN detail ELSE '' END)), 12) AS issue_id, column_name, kind AS issue_type, n AS issue_count,
    CASE kind {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _ACTIONS.items())} END AS suggested_action, '' AS decision FROM (
    SELECT column_name, 'TEXT_VARIANT' AS kind, 'Normalized value: ' || k AS detail, CAST(sum(n) AS BIGINT) AS n FROM (SELECT *, {_key('value')} AS k FROM {_ORDER_COUNTS} c WHERE NOT {_missing('value')}) GROUP BY column_name, k HAVING count(*) > 1
    UNION ALL SELECT column_name, 'MISSING_VALUE', '', {_sum(_missing('value'))} FROM {_ORDER_COUNTS} c GROUP BY column_name HAVING {_sum(_missing('value'))} > 0)""")
def decisions_to_make(spark, sf_dir):
    """The review of the orders' issues: their ids and what is suggested, still to be decided."""
    issues = profile.all_issues("orders_raw", _orders(spark, sf_dir), {}).where("issue_type IN ('TEXT_VARIANT', 'MISSING_VALUE')")
    return reviews.decision_review(issues).select("issue_id", "column_name", "issue_type", "issue_count", "suggested_action", "decision")
