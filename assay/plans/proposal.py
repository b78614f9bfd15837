"""A schema proposal for raw tables: types, keys and relationships, for reviewers to edit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.names import column_name, table_name
from assay.operators import keys, profile


def propose(tables: dict[str, DataFrame]) -> list[dict]:
    """Rows of the schema review, one a column. A job or two for each table, small results."""
    primary = {name: keys.suggest_primary_key(df) for name, df in tables.items()}
    foreign = {(t, c): f"{p}.{pc}" for t, c, p, pc, _ in keys.propose_foreign_keys(tables, primary)}
    rows = []
    for name, df in tables.items():
        types = profile.suggest_types(df)
        missing = {r["column_name"] for r in profile.missing_values(df).collect()}
        totals = _totals(name, df, primary[name])
        for c in df.columns:
            rows.append({
                "table_name": name, "silver_table_name": table_name(name), "allow_no_primary_key": str(not primary[name]),
                "source_column": c, "column_name": column_name(c), "datatype": types.get(c, "string"), "nullable": str(c in missing),
                "is_pk": str(c in primary[name]), "pk_order": str(primary[name].index(c) + 1) if c in primary[name] else "",
                "is_fk": str((name, c) in foreign), "fk_reference": foreign.get((name, c), ""),
                "row_count": str(totals["row_count"]), "duplicate_row_count": str(totals["duplicate_row_count"]),
            })
    return rows


def _totals(name: str, df: DataFrame, key: list[str]) -> dict:
    """Rows and exact duplicates; of a table with a key, which was counted exactly, no two rows are alike."""
    if key:
        return {"row_count": df.count(), "duplicate_row_count": 0}
    return profile.profile_table(name, df).first().asDict()


def key_rows(tables: dict[str, DataFrame], primary: dict[str, list[str]]) -> DataFrame:
    """The quality of every table's proposed key."""
    return reduce(DataFrame.unionByName, [keys.key_quality(tables[t], k).select(F.lit(t).alias("table_name"), "*") for t, k in primary.items() if k])


def as_document(rows: list[dict]) -> dict:
    """The proposal by table, to be written as JSON."""
    found: dict = {}
    for r in rows:
        table = found.setdefault(r["table_name"], {
            "silver_table_name": r["silver_table_name"], "row_count": int(r["row_count"]), "duplicate_row_count": int(r["duplicate_row_count"]),
            "primary_key": [], "columns": {}, "foreign_keys": {},
        })
        table["columns"][r["source_column"]] = {"name": r["column_name"], "datatype": r["datatype"], "nullable": r["nullable"] == "True"}
        if r["is_pk"] == "True":
            table["primary_key"].append(r["column_name"])
        if r["is_fk"] == "True":
            table["foreign_keys"][r["column_name"]] = r["fk_reference"]
    return found


def describe(rows: list[dict]) -> str:
    """The proposal as readable text: keys, then columns, table by table."""
    lines = []
    for name, t in as_document(rows).items():
        lines.append(f"{name} -> {t['silver_table_name']}: {t['row_count']} rows, {t['duplicate_row_count']} in exact duplicates, key: {' + '.join(t['primary_key']) or 'none found'}")
        lines += [f"  {c}: {x['datatype']}{'' if x['nullable'] else ' not null'}" + (f", references {fk}" if (fk := t["foreign_keys"].get(x["name"])) else "") for c, x in t["columns"].items()]
    return "\n".join(lines) + "\n"


def as_frame(spark, rows: list[dict]) -> DataFrame:
    frame = spark.createDataFrame(rows) if rows else None
    return frame.select(*[F.col(c) for c in rows[0]]) if rows else spark.range(0).select()
