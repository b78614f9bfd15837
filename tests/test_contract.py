import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.operators import fx, guards, keys, profile, reviews, transform
from assay.plans import contract as c
from assay.plans.proposal import as_document, describe, propose
from assay.sources import files, publish
from assay.streaming import cleaning


def schema_row(table, source, datatype="string", **more):
    row = {f: "" for f in c.SCHEMA_FIELDS} | {"table_name": table, "silver_table_name": table.removesuffix("_raw"), "source_column": source, "column_name": source, "datatype": datatype}
    return row | more


SCHEMA = [
    schema_row("people_raw", "person_id", is_pk="True"),
    schema_row("people_raw", "name", nullable="yes"),
    schema_row("sales_raw", "sale_id", "integer", is_pk="1", pk_order="1"),
    schema_row("sales_raw", "person_id", is_fk="True", fk_reference="people_raw.person_id"),
    schema_row("sales_raw", "amount", "money", nullable="True"),
    schema_row("sales_raw", "currency", nullable="True"),
    schema_row("sales_raw", "day", "date", nullable="True"),
]
DECISIONS = [
    {"issue_id": "1", "table_name": "people_raw", "column_name": "name", "issue_type": "MISSING_VALUE", "suggested_action": "STANDARDIZE_NULL_MARKERS", "decision": "fix", "action": "", "reason": ""},
    {"issue_id": "2", "table_name": "sales_raw", "column_name": "", "issue_type": "EXACT_DUPLICATE", "suggested_action": "REMOVE_EXACT_DUPLICATES", "decision": "FIX", "action": "", "reason": ""},
]
RULES = {"_global": {"base_currency": "VND"}, "tables": {"sales_raw": {"currency": {"conversions": [
    {"amount_column": "amount", "currency_column": "currency", "date_column": "day", "output_column": "amount_vnd", "rate_output_column": "fx_rate"}]}}}}


def sources(spark):
    people = spark.createDataFrame([("a", "Ann"), ("b", " N/A ")], "person_id string, name string")
    sales = spark.createDataFrame(
        [("1", "a", "10.50", "us$", "2025-01-03"), ("1", "a", "10.50", "us$", "2025-01-03"), ("2", "b", "7", "vnd", None)],
        "sale_id string, person_id string, amount string, currency string, day string",
    )
    rates = spark.createDataFrame([("2025-01-01", "USD", "24000"), ("02/01/2025", "usd", "25000"), ("x", "USD", "1")], "date string, currency string, vnd_per_currency string")
    return {"people_raw": people, "sales_raw": sales}, fx.prepare_rates(rates)


def test_build_and_publish(spark):
    contract = c.compile_contract(SCHEMA, DECISIONS, RULES)
    raw, rates = sources(spark)
    assert not c.missing_columns(contract, {k: v.columns for k, v in raw.items()}) and "people_raw -> people" in c.describe(contract)
    issues = publish.publish(spark, raw, contract, "one", rates=rates)
    assert issues.count() == 0
    rows = {r.sale_id: r for r in spark.table("one.sales").collect()}
    assert len(rows) == 2 and rows[1].amount_vnd == Decimal(262500) and rows[1].day == dt.date(2025, 1, 3)
    assert rows[2].fx_rate == 1 and rows[2].amount_vnd == 7
    assert {r.name for r in spark.table("one.people").collect()} == {"Ann", None}
    publish.verify(spark, {"sales": 2, "people": 2}, "one")
    with pytest.raises(guards.GuardError, match="51000"):
        publish.publish(spark, raw, contract, "one", rates=rates)
    publish.publish(spark, raw, contract, "one", overwrite=True, rates=rates)


def test_contract_comes_back_from_json(tmp_path):
    contract = c.compile_contract(SCHEMA, DECISIONS, RULES)
    files.write_json(tmp_path / "c.json", contract.to_dict())
    assert c.Contract.from_dict(files.read_json(tmp_path / "c.json")) == contract
    assert contract.relationships() == [("sales", "person_id", "people", "person_id")] and contract.warnings() == []


def test_one_pass_profiles_shuffle_no_values(spark):
    df = spark.createDataFrame([("1", " a"), (None, "b")], "x string, y string")
    for report in (profile.structure_issues, profile.whitespace_issues, profile.type_evidence):
        plan = report(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == plan.count("Exchange SinglePartition") == 1


def test_nothing_is_published_when_a_guard_fails(spark):
    contract = c.compile_contract(SCHEMA, DECISIONS, RULES)
    raw, rates = sources(spark)
    bad = raw | {"sales_raw": raw["sales_raw"].union(spark.createDataFrame([("x", "a", "oops", "usd", "2024-01-01"), ("9", "a", "5", "usd", "2024-01-01")], raw["sales_raw"].schema))}
    with pytest.raises(guards.GuardError) as error:
        publish.publish(spark, bad, contract, "two", rates=rates)
    assert {"51001", "51002", "51003", "51004"} <= {line.split()[0] for line in str(error.value).split("\n")}
    lost = raw | {"people_raw": raw["people_raw"].where("person_id = 'a'")}
    with pytest.raises(guards.GuardError, match="FK_ORPHAN"):
        publish.publish(spark, lost, contract, "two", rates=rates)
    assert spark.sql("SHOW TABLES IN two").count() == 0


def test_all_errors_come_at_once():
    bad = [schema_row("t", "a", "blob", is_fk="True"), schema_row("t", "a", is_pk="maybe", fk_reference="nope")]
    _, errors = c.compile_schema(bad)
    text = "\n".join(errors)
    for part in ("blob", "maybe", "twice: a", "no primary key", "disagree"):
        assert part in text
    _, errors = c.compile_decisions([DECISIONS[0] | {"decision": "KEEP"}, DECISIONS[0] | {"decision": "FIX", "action": "RUN"}], c.compile_schema(SCHEMA)[0])
    assert len(errors) == 2
    blocked = [DECISIONS[0] | {"decision": "BLOCK", "reason": "wait"}]
    with pytest.raises(c.ContractError, match="wait"):
        c.refuse_blocked(c.compile_contract(SCHEMA, blocked, RULES))
    no_map = [DECISIONS[0] | {"action": "APPLY_VALUE_MAPPING"}]
    with pytest.raises(c.ContractError, match="no mapping"):
        c.compile_contract(SCHEMA, no_map, RULES)


@pytest.mark.parametrize("most", [500_000, 0])
def test_asof_rates(spark, monkeypatch, most):
    monkeypatch.setattr(fx, "BROADCAST_RATES", most)
    rates = spark.createDataFrame([("USD", dt.date(2025, 1, 1), Decimal(1)), ("USD", dt.date(2025, 3, 2), Decimal(2)), ("EUR", dt.date(2025, 1, 5), Decimal(3))], "currency string, date date, rate decimal(38,10)")
    rows = [(1, "USD", dt.date(2024, 12, 31)), (2, "USD", dt.date(2025, 1, 1)), (3, "USD", dt.date(2025, 2, 28)), (4, "USD", dt.date(2025, 9, 9)), (5, "EUR", dt.date(2025, 1, 4)), (6, "XXX", None), (7, "VND", None), (8, None, dt.date(2025, 1, 1))]
    tx = spark.createDataFrame(rows, "id int, cur string, day date")
    got = {r.id: r.fx_rate for r in fx.asof_rate(tx, rates, "cur", "day", base="VND").collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: 2, 5: None, 6: None, 7: 1, 8: None}
    exact = {r.id: r.fx_rate for r in fx.exact_rate(tx, rates, "cur", "day", base="VND").collect()}
    assert exact == {1: None, 2: 1, 3: None, 4: None, 5: None, 6: None, 7: 1, 8: None}
    with pytest.raises(ValueError):
        fx.with_rate(tx, rates, "cur", "day", "r", None, "guess")


def test_profile_and_keys(spark):
    rows = [("1", "Direct", "2025-01-02", "x"), ("2", " direct  ", "03/04/2025", "x"), ("3", "n/a", "oops", "x"), ("3", "n/a", "oops", "x")]
    df = spark.createDataFrame(rows, "line_id string, channel string, order_date string, same string")
    issues = {(r.column_name, r.issue_type): r for r in profile.all_issues("t", df, {"order_date": "date"}).collect()}
    assert issues["channel", "MISSING_VALUE"].issue_count == 2 and issues["channel", "TEXT_VARIANT"].issue_count == 2
    assert issues["", "EXACT_DUPLICATE"].issue_count == 2 and ("same", "CONSTANT_COLUMN") in issues
    assert issues["channel", "WHITESPACE"].issue_count == 1 and issues["order_date", "DATATYPE_PARSE"].example == "oops"
    assert keys.suggest_primary_key(df) == [] and keys.suggest_primary_key(df.distinct()) == ["line_id"]
    pair = spark.createDataFrame([("1", "1", "a"), ("1", "2", "a"), ("2", "1", "a")], "order_id string, line_no string, z string")
    assert keys.suggest_primary_key(pair) == ["order_id", "line_no"]
    assert keys.key_quality(df, ["line_id"]).first().status == "REVIEW_PK"
    types = profile.suggest_types(df.select("line_id", "order_date").limit(2))
    assert types == {"line_id": "string", "order_date": "date"}
    evidence = {"effective": 4, "numbers": 4, "integers": 4, "dates": 0, "times": 0, "flags": 4}
    assert [profile.infer_type(n, evidence) for n in ("is_new", "qty", "zip")] == ["boolean", "integer", "string"]


def test_proposal_and_reviews(spark, tmp_path):
    raw, _ = sources(spark)
    rows = propose(raw)
    found = {(r["table_name"], r["source_column"]): r for r in rows}
    assert found["people_raw", "person_id"]["is_pk"] == "True"
    assert found["sales_raw", "person_id"]["fk_reference"] == "people_raw.person_id"
    assert as_document(rows)["sales_raw"]["foreign_keys"] == {"person_id": "people_raw.person_id"} and "key: person_id" in describe(rows)
    files.write_review(tmp_path / "s.csv", rows, list(rows[0]))
    assert files.read_review(tmp_path / "s.csv") == rows and (tmp_path / "s.csv").read_bytes()[:3] == b"\xef\xbb\xbf"
    files.write_json(tmp_path / "c.json", c.compile_contract(SCHEMA, DECISIONS, RULES).to_dict())
    assert files.read_json(tmp_path / "c.json")["base_currency"] == "VND" and files.read_json(tmp_path / "no.json", False) == {}
    issue = spark.createDataFrame([("customers_raw", "tax_id", "MISSING_VALUE", 5, "", "real_null=5")], "table_name string, column_name string, issue_type string, issue_count bigint, example string, detail string")
    review = reviews.decision_review(issue).first()
    assert (review.issue_id, review.suggested_action) == ("ae5eed14207a", "STANDARDIZE_NULL_MARKERS")


def test_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNA,1\n,2\n")
    rows = files.read_table(spark, str(tmp_path / "t.csv"), "csv").orderBy("b").collect()
    assert [tuple(r) for r in rows] == [("NA", "1"), (None, "2")] and files.ready(spark)
    with pytest.raises(ValueError):
        files.read_tables(spark, {"t": "x"}, expected=2)


def test_validation(spark):
    contract = c.compile_contract(SCHEMA, [], {})
    people = spark.createDataFrame([("a", None), ("a", None)], "person_id string, name string")
    sales = spark.createDataFrame([(1, "z", "us$")], "sale_id bigint, person_id string, currency string")
    issues = {(r.table_name, r.issue_type): r for r in guards.validate_all({"people": people, "sales": sales}, contract).collect()}
    assert {("people", "PK_DUPLICATE"), ("people", "EXACT_DUPLICATE_UNDECIDED"), ("sales", "FK_ORPHAN"), ("sales", "INVALID_CURRENCY_CODE"), ("sales", "MISSING_REQUIRED_COLUMN")} == set(issues)


def test_streams(spark, tmp_path):
    contract = c.compile_contract(SCHEMA, DECISIONS, {})
    table = contract.table("people")
    sources(spark)[0]["people_raw"].write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("person_id string, name string").parquet(f"{tmp_path}/in")
    cleaning.write_stream(stream, table, contract, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination(60)
    assert {tuple(r)[:2] for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {("a", "Ann"), ("b", None)}
    # The same batch once more, as after a crash before its commit, writes over itself.
    cleaning.write_stream(stream, table, contract, f"{tmp_path}/out", f"{tmp_path}/other_state").awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    assert cleaning.clean_stream(stream, table, contract).isStreaming
    timed = stream.select(F.current_timestamp().alias("at"))
    assert cleaning.late_counts(timed, "at", "1 hour", "10 minutes").isStreaming


def test_transform_schema_and_changes(spark):
    contract = c.compile_contract(SCHEMA, DECISIONS, RULES)
    raw, rates = sources(spark)
    built = transform.transform(raw["sales_raw"], contract.table("sales"), contract, rates)
    wanted = transform.target_schema(contract.table("sales"))
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in wanted]
    row = transform.before_after(raw["sales_raw"], contract.table("sales"), contract, rates).first()
    assert (row.input_rows, row.output_rows, row.changed_rows, row.duplicate_before, row.duplicate_after) == (3, 2, 3, 1, 0)
    typed = {t.name: transform.transform(raw[t.source], t, contract, rates) for t in contract.tables}
    typed["sales"] = typed["sales"].withColumn("person_id", F.lit("nobody"))
    found = {r.table_name: r for r in guards.review(raw, contract, typed, rates).collect()}
    assert (found["sales"].status, found["sales"].invalid_after, found["people"].status, found["people"].invalid_after) == ("FAIL", 2, "PASS", 0)
    assert {r.table_name: r.removed_duplicates for r in guards.summary(guards.review(raw, contract, typed, rates)).collect()} == {"sales": 1, "people": 0}
    left = guards.duplicate_report(raw["sales_raw"], contract.table("sales"), contract, rates).first()
    assert (left.input_rows, left.removed_rows, left.remaining_rows, left.duplicate_key_rows) == (3, 1, 2, 0)
