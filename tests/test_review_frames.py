"""Reviews as DataFrames have the errors that the driver's compilation has."""

import random

import pytest

from assay.plans import contract as c
from assay.plans import review_frames as frames

TEXTS = {
    "table_name": ["a_raw", "b_raw", "c_raw", "a_raw"], "silver_table_name": ["a", "b", "a", "a", ""], "allow_no_primary_key": ["yes", "no", "", "TRUE", "perhaps"],
    "source_column": ["X", "y", "z", "w"], "column_name": ["x", "y2", "z", ""], "datatype": ["int", " Money ", "blob", "string", "TIMESTAMP"], "nullable": ["", "1", "n", "maybe"],
    "is_pk": ["", "True", "y", "no", "?"], "pk_order": ["", "1", "2.0", "0", "x", "-3"], "is_fk": ["", "1", "false", "hm"], "fk_reference": ["", "", "B.Y2", "a_raw.x", "nope", ".x", "b.", "c_raw.gone", "no.x"],
}


def review(r, n):
    own = {t: r.choice(["a", "b", ""]) for t in ("a_raw", "b_raw", "c_raw")}
    rows = [{f: r.choice(v) for f, v in TEXTS.items()} for _ in range(n)]
    return [row | {"silver_table_name": own[row["table_name"]]} if r.random() < 0.8 else row for row in rows]


def frame(spark, rows, fields):
    return spark.createDataFrame([tuple(row[f] for f in fields) + (1,) for row in rows], ", ".join(f"{f} string" for f in fields) + ", error int")


@pytest.mark.parametrize("seed", range(6))
def test_schema_errors(spark, seed):
    r = random.Random(seed)
    rows = review(r, r.randrange(1, 14))
    found = frames.schema_errors(frame(spark, rows, c.SCHEMA_FIELDS))
    tables, errors = c.compile_schema(rows)
    assert sorted(x.error for x in found.collect()) == sorted(errors)
    decisions = [
        dict(zip(c.DECISION_FIELDS, (str(i), r.choice(["A_RAW", "b", "gone"]), r.choice(["", "x", "Z", "none"]), "WHITESPACE", r.choice(["STANDARDIZE_TEXT", "", "odd"]), r.choice(["FIX", "keep", "Block", "later", ""]), r.choice(["", "review_only", "run"]), r.choice(["", "why"]))))
        for i in range(1, 25)
    ]
    own = frame(spark, decisions, c.DECISION_FIELDS)
    assert sorted(x.error for x in frames.decision_errors(own, frame(spark, rows, c.SCHEMA_FIELDS)).collect()) == sorted(c.compile_decisions(decisions, tables)[1])


def test_good_reviews(spark):
    rows = [dict.fromkeys(c.SCHEMA_FIELDS, "") | row for row in (
        {"table_name": "people_raw", "silver_table_name": "people", "source_column": "id", "column_name": "person_id", "datatype": "int", "is_pk": "1"},
        {"table_name": "sales_raw", "silver_table_name": "sales", "source_column": "b", "column_name": "b", "datatype": "text", "is_pk": "y", "pk_order": "2", "is_fk": "1", "fk_reference": "People.ID"},
        {"table_name": "sales_raw", "silver_table_name": "sales", "source_column": "a", "column_name": "a", "datatype": "money", "is_pk": "y", "pk_order": "1.0", "nullable": "yes"},
    )]
    df = frame(spark, rows, c.SCHEMA_FIELDS)
    contract = c.compile_contract(rows, [], {})
    assert frames.schema_errors(df).count() == 0
    assert [tuple(r) for r in frames.relationships(df).collect()] == [tuple(r) for r in contract.relationships()]
    told = [r.line for r in frames.described(df).orderBy("table_name", "place").collect()]
    assert told == ["people_raw -> people (key: person_id)", "  id -> person_id: integer not null", "sales_raw -> sales (key: a, b)", "  a -> a: decimal", "  b -> b: string not null"]
    present = spark.createDataFrame([("sales_raw", "a")], "table_name string, source_column string")
    assert sorted(r.error for r in frames.missing_columns(df, present).collect()) == sorted(c.missing_columns(contract, {"sales_raw": ["a"]}))
    decided = frame(spark, [dict(zip(c.DECISION_FIELDS, ("1", "sales_raw", "a", "whitespace", "", "block", "", "wait")))], c.DECISION_FIELDS)
    assert [r.error for r in frames.blocking(decided).collect()] == ["sales_raw.a WHITESPACE: wait"]
    for empty in (frames.schema_errors(df.limit(0)), frames.decision_errors(decided.limit(0), df), frames.described(df.limit(0))):
        assert empty.count() == 0
    with pytest.raises(ValueError, match="no column fk_reference"):
        frames.schema_errors(df.drop("fk_reference"))
