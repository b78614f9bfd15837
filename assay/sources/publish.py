"""Publishing typed tables: all or none, as one version."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assay.config import KEY_LENGTH
from assay.functions.names import constraint_name, literal, quoted
from assay.operators import guards
from assay.operators.transform import CHANGED, target_columns, typed_with_cleaned, without_exact_duplicates
from assay.plans import order
from assay.plans.contract import Contract, TableSpec, refuse_blocked
from assay.sources import snapshots
from assay.types import LOGICAL

#: Prefix of what the catalog says of a published table.
PROPERTY = "assay."


@dataclass(frozen=True)
class Written:
    """What one write of a table counted: (code, column, bad rows) of its guards, rows in, changed and out."""

    folder: str
    guards: list[tuple[str, str, int]]
    input_rows: int
    changed_rows: int
    rows: int


def root_of(spark: SparkSession, database: str) -> str:
    """The folder that holds a database's versions."""
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def write_guarded(raw: DataFrame, table: TableSpec, contract: Contract, folder: str, rates: DataFrame | None = None, strict: bool = False) -> Written:
    """Write the typed table and count what its guards find, both in the one pass over the raw rows.

    strict: the first row that breaks a guard fails the write; else all are counted. Counts are
    metrics of the write: where exact duplicates go, a lost executor can have its rows counted
    again, which never hides a bad row. Repeated keys are counted over what was written.
    """
    counters = guards.row_guards(table)
    seen, written = Observation(), Observation()
    frame = typed_with_cleaned(raw, table, contract, rates)
    frame = frame.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(CHANGED)).alias("changed"), *[F.count_if(bad).alias(f"g{i}") for i, (_, _, bad) in enumerate(counters)]
    )
    frame = guards.enforced(frame, table) if strict else frame
    rows = without_exact_duplicates(frame.select(*target_columns(table)), table)
    rows.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    first = seen.get
    found = [(code, name, first[f"g{i}"]) for i, (code, name, _) in enumerate(counters)]
    if table.primary_key:
        found += [tuple(r) for r in guards.repeated_keys(raw.sparkSession.read.parquet(folder), table).collect()]
    return Written(folder, found, first["rows"], first["changed"], written.get["rows"])


def column_type(table: TableSpec, name: str) -> str:
    """A column's type in the catalog: keys and references are texts of limited length."""
    spec = next((c for c in table.columns if c.name == name), None)
    keyed = set(table.primary_key) | {fk.column for fk in table.foreign_keys}
    if spec and spec.datatype == "string" and name in keyed:
        return f"VARCHAR({KEY_LENGTH})"
    return LOGICAL[spec.datatype if spec else "decimal"].simpleString()


def entry(table: TableSpec, contract: Contract, written: Written) -> dict:
    """What a manifest says of a table."""
    required = {c.name for c in table.columns if not c.nullable} | set(table.primary_key)
    columns = [(c, column_type(table, c), c not in required) for c in target_columns(table)]
    references = [(c, p, pc) for t, c, p, pc in contract.relationships() if t == table.name]
    return {"folder": written.folder, "rows": written.rows, "columns": columns, "primary_key": list(table.primary_key), "foreign_keys": references}


def _step(name: str) -> None:
    """Called between the steps of a publish; tests stop here."""


def point(spark: SparkSession, database: str, name: str, described: dict, version: int) -> None:
    """Let the catalog's table be that of a version: same columns, another folder; else made anew.

    Spark enforces the length of key texts when rows are inserted. It keeps no NOT NULL, keys or
    references for Parquet tables; these are properties, for constraints() to read.
    """
    full = quoted(database, name)
    properties = {"version": str(version), "not_null": json.dumps([c for c, _, nullable in described["columns"] if not nullable])}
    properties |= {k: json.dumps(described[k]) for k in ("primary_key", "foreign_keys")}
    listed = ", ".join(f"{literal(PROPERTY + k)} = {literal(v)}" for k, v in properties.items())
    have = _properties(spark, database, name)
    columns = ", ".join(f"{quoted(c)} {kind}" for c, kind, _ in described["columns"])
    if have.get("columns") == columns:
        if have.get("folder") != described["folder"]:
            spark.sql(f"ALTER TABLE {full} SET LOCATION {literal(described['folder'])}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet LOCATION {literal(described['folder'])}")
    listed += f", {literal(PROPERTY + 'columns')} = {literal(columns)}, {literal(PROPERTY + 'folder')} = {literal(described['folder'])}"
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({listed})")
    spark.catalog.refreshTable(full)


def _properties(spark: SparkSession, database: str, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(quoted(database, name)):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(database, name)}").collect()
    return {r["key"].removeprefix(PROPERTY): r["value"] for r in rows if r["key"].startswith(PROPERTY)}


def recover(spark: SparkSession, database: str) -> int:
    """Point the catalog's tables at the last version, where a publish stopped half-way; returns that version."""
    found = snapshots.manifest(spark, root_of(spark, database))
    for name, described in found["tables"].items():
        have = _properties(spark, database, name)
        if have.get("folder") != described["folder"] or have.get("version") is None:
            point(spark, database, name, described, found["version"])
    return found["version"]


def build_tables(
    spark: SparkSession, raw: dict[str, DataFrame], contract: Contract, folder: str, rates: DataFrame | None = None, strict: bool = False,
) -> dict[str, order.Outcome]:
    """Write every table below folder, parents first and several at once; what became of each.

    A table fails by its guards or by references that its parents, already written, don't have.
    """
    typed: dict[str, DataFrame] = {}

    def build(name: str) -> Written:
        table = contract.table(name)
        written = write_guarded(raw[table.source], table, contract, f"{folder}/{name}", rates, strict)
        bad = [f"{code} {name}.{column}: {n} rows" for code, column, n in written.guards if n]
        typed[name] = spark.read.parquet(written.folder)
        if not bad and (lost := guards.reference_issues(typed[name], table, typed, contract)):
            bad = [f"{r.issue_type} {name}.{r.column_name}: {r.issue_count} rows" for r in reduce(DataFrame.unionByName, lost).collect()]
        if bad:
            raise guards.GuardError("\n".join(bad))
        _step(f"built {name}")
        return written

    return order.build_all(contract, build)


def publish(
    spark: SparkSession, raw: dict[str, DataFrame], contract: Contract, database: str = "silver",
    overwrite: bool = False, rates: DataFrame | None = None, strict: bool = False,
) -> DataFrame:
    """Build every table of a contract and publish them together; returns the issues found.

    Tables are built parents first, several at once, each in one pass over its raw rows that
    also counts its guards, in folders of this run. Then references and the rest are validated.
    If anything fails, GuardError says what, and which tables weren't built for it; nothing is
    visible then. Else one manifest makes all of them the next version (snapshots), and the
    catalog's tables are pointed at it. A driver that dies at any step leaves the old version or
    the new one, whole, to snapshots.read(); the next publish or recover() points the catalog at
    it. Existing targets are refused unless overwrite is set. Rows are counted while they are
    written and once more under their final names.
    """
    refuse_blocked(contract)
    order.refuse_cycles(contract)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    root, parent = root_of(spark, database), recover(spark, database)
    existing = [t.name for t in contract.tables if spark.catalog.tableExists(quoted(database, t.name))]
    if existing and not overwrite:
        raise guards.GuardError(f"{guards.TARGET_EXISTS} {', '.join(existing)}")
    run = uuid.uuid4().hex
    try:
        outcomes = build_tables(spark, raw, contract, f"{root}/{snapshots.RUNS}/{run}", rates, strict)
        if bad := [o for o in outcomes.values() if o.status != order.BUILT]:
            for outcome in bad:
                if outcome.error and not isinstance(outcome.error, guards.GuardError) and not strict:
                    raise outcome.error
            raise guards.GuardError("\n".join(o.why if o.status == order.FAILED else f"{o.table} {o.why}" for o in bad))
        typed = {n: spark.read.parquet(o.result.folder) for n, o in outcomes.items()}
        found = [tuple(r) for r in guards.validate_all(typed, contract, references=False).collect()]  # one row an issue
        if failing := [x for x in found if x[-1] == "FAIL"]:
            raise guards.GuardError("\n".join(f"{kind} {table}.{column}: {n}" for table, column, kind, n, *_ in failing))
        _step("checked")
        described = {t.name: entry(t, contract, outcomes[t.name].result) for t in contract.tables}
        version = snapshots.commit(spark, root, parent, run, described)
    except BaseException:
        snapshots.delete(spark, f"{root}/{snapshots.RUNS}/{run}")
        raise
    _step("committed")
    for name, what in described.items():
        point(spark, database, name, what, version)
        _step(f"pointed {name}")
    verify(spark, {n: o.result.rows for n, o in outcomes.items()}, database)
    return spark.createDataFrame(found, guards.ISSUE)


def verify(spark: SparkSession, expected: dict[str, int], database: str = "silver") -> None:
    """Count published tables again; GuardError where a count differs."""
    bad = [f"{n}: {c} rows, {k} expected" for n, k in expected.items() if (c := spark.table(f"{database}.{n}").count()) != k]
    if bad:
        raise guards.GuardError("\n".join(bad))


def constraints(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, constraint_name, kind, columns, reference) of all published tables, from the catalog."""
    rows = []
    for name in sorted(t.name for t in spark.catalog.listTables(quoted(database))):
        have = _properties(spark, database, name)
        if "primary_key" not in have:
            continue
        if key := json.loads(have["primary_key"]):
            rows.append((name, constraint_name("pk", name), "PRIMARY KEY", ", ".join(key), ""))
        rows += [(name, constraint_name("nn", name, c), "NOT NULL", c, "") for c in json.loads(have["not_null"])]
        rows += [(name, constraint_name("fk", name, c), "FOREIGN KEY", c, f"{p}.{pc}") for c, p, pc in json.loads(have["foreign_keys"])]
        for c in spark.sql(f"DESCRIBE TABLE {quoted(database, name)}").collect():
            if c["data_type"].startswith("varchar"):
                rows.append((name, constraint_name("len", name, c["col_name"]), "LENGTH", c["col_name"], c["data_type"]))
    return spark.createDataFrame(rows, "table_name string, constraint_name string, kind string, columns string, reference string")


def constraint_report(spark: SparkSession, database: str) -> DataFrame:
    """constraints() with how many rows the table has and how many (of keys: how many repeated keys)
    break each, counted in the tables themselves."""
    parts = []
    for r in constraints(spark, database).collect():  # one row a constraint
        df, names = spark.table(quoted(database, r["table_name"])), r["columns"].split(", ")
        if r["kind"] == "PRIMARY KEY":
            counted = df.groupBy(*names).agg(F.count("*").alias("c")).where("c > 1").agg(F.count("*").alias("n"))
        elif r["kind"] == "FOREIGN KEY":
            parent, column = r["reference"].rsplit(".", 1)
            counted = guards.orphans(df, names[0], spark.table(quoted(database, parent)), column).agg(F.count("*").alias("n"))
        elif r["kind"] == "NOT NULL":
            counted = df.agg(F.count_if(F.col(names[0]).isNull()).alias("n"))
        else:
            counted = df.agg(F.count_if(F.length(names[0]) > int(r["reference"][8:-1])).alias("n"))
        named = [F.lit(r[c]).alias(c) for c in ("table_name", "constraint_name", "kind", "columns", "reference")]
        rows = df.agg(F.count("*").alias("checked_rows"), F.lit(r["table_name"]).alias("table_name"))
        parts.append(counted.select(*named, F.col("n").alias("bad_rows")).join(rows, "table_name"))
    return reduce(DataFrame.unionByName, parts)
