"""The script does what the DataFrames do."""

import itertools
from decimal import Decimal

import pytest

from assay.functions import clean
from assay.operators import guards, transform
from assay.plans import contract as c
from assay.plans import script
from assay.plans.contract import ColumnSpec, Contract, TableSpec
from tests.test_contract import DECISIONS, RULES, SCHEMA, sources

SHAPES = [
    None, "", " ", "0", "-7", "+8.", ".5", "1,234.50", "(12)", "(1,000.25)", "()", "1e5", "inf", "nan", "12.0", "12.5", "99999999999999999999999999999", "x",
    "2025-01-02", "2025-01-02T03:04", "2025-01-02 03:04:05", "2025-01-02 03:04:05.123", "2025/1/2", "2025/01/02 7:30", "3/4/2025", "31/12/2024 23:59", "12-31-2024", "1-2-2025 1:02", "20250102", "20251302",
    "2025-02-30", "yes", " NO ", "T", "maybe", "n/a", " N/A", "null", "-", "us$", " eur ", "VNĐ", "xyz9", "a\tb  c", "l'été \\ 'x'",
]


@pytest.mark.parametrize("fixed", [False, True])
def test_every_shape_of_value(spark, fixed):
    kinds = ("string", "integer", "decimal", "date", "datetime", "boolean")
    names = [*kinds, "currency"]
    decisions = [c.Decision(issue, "FIX", n, action) for n in names for issue, action in (("MISSING_VALUE", "STANDARDIZE_NULL_MARKERS"), ("WHITESPACE", "STANDARDIZE_TEXT"), ("TEXT_VARIANT", "APPLY_VALUE_MAPPING"))]
    table = TableSpec(
        "t raw", "t", tuple(ColumnSpec(f"in {n}", n, n if n in kinds else "string", n != "date") for n in names), ("integer", "string"), decisions=tuple(decisions) if fixed else (),
        mappings={n: {"X": "it's", "maybe": "yes"} for n in names},
    )
    contract = Contract((table,), aliases={"xyz9": "XYZ"})
    raw = spark.createDataFrame([(t,) * len(names) for t in SHAPES] + [("x" * 101,) * len(names)], ", ".join(f"`in {n}` string" for n in names))
    raw.createOrReplaceTempView("shapes")
    script.run(spark, contract, {"t raw": "shapes"}, "no database", stop=False)
    columns = [f"`{x}`" for x in transform.target_columns(table)]
    key = lambda r: repr(tuple(r))
    wanted = transform.typed_with_cleaned(raw, table, contract)
    assert sorted(spark.table("t__rows").select(*columns).collect(), key=key) == sorted(wanted.select(*columns).collect(), key=key)
    report = lambda df: sorted(tuple(r) for r in df.collect())
    assert report(spark.table("t__guards")) == report(guards.guard_counts(wanted, table))


@pytest.mark.parametrize("rule", ["previous_available_rate", "exact"])
def test_script_with_rates_and_references(spark, rule):
    raw, rates = sources(spark)
    rules = {**RULES, "_global": {"base_currency": "VND", "missing_fx_rate_rule": rule}}
    contract = c.compile_contract(SCHEMA, DECISIONS, rules)
    views = {n: f"s_{n}" for n in raw}
    sales = raw["sales_raw"] if rule != "exact" else raw["sales_raw"].replace({"2025-01-03": "2025-01-02"}, subset=["day"])
    for name, df in (raw | {"sales_raw": sales}).items():
        df.createOrReplaceTempView(views[name])
    rates.createOrReplaceTempView("s_rates")
    database = f"script_{rule}"
    script.run(spark, contract, views, database, "s_rates")
    wanted = transform.transform(sales, contract.table("sales"), contract, rates)
    assert sorted(map(tuple, spark.table(f"{database}.sales").collect())) == sorted(map(tuple, wanted.collect()))
    assert {r.amount_vnd for r in wanted.collect()} == {Decimal(262500), Decimal(7)}
    with pytest.raises(Exception, match="already exists"):
        script.run(spark, contract, views, database, "s_rates")
    raw["people_raw"].where("person_id = 'a'").createOrReplaceTempView(views["people_raw"])
    with pytest.raises(Exception, match="FK_ORPHAN sales.person_id: 1 rows"):
        script.run(spark, contract, views, f"{database}_lost", "s_rates")


def test_script_is_one_text(tmp_path):
    contract = c.compile_contract(SCHEMA, DECISIONS, RULES)
    for tables in itertools.permutations(contract.tables):
        again = Contract(tables, contract.base_currency, contract.aliases)
        text = script.script(again, {"people_raw": "b.people_raw", "sales_raw": "b.sales_raw"}, "silver")
        assert text.index("CREATE TABLE `silver`.`people`") < text.index("CREATE TABLE `silver`.`sales`")
    script.write_script(tmp_path / "build.sql", again, {"people_raw": "b.people_raw", "sales_raw": "b.sales_raw"}, "silver")
    assert (tmp_path / "build.sql").read_text() == text
    for part in ("-- sales.person_id references people.person_id", "-- FIX MISSING_VALUE name STANDARDIZE_NULL_MARKERS", "\n    `person_id` VARCHAR(100)", "raise_error", clean.DATE_SHAPES[0][1]):
        assert part in text
    blocked = [DECISIONS[0] | {"decision": "BLOCK", "reason": "wait"}]
    with pytest.raises(c.ContractError, match="wait"):
        script.script(c.compile_contract(SCHEMA, blocked, RULES), {}, "silver")
    circle = Contract(tuple(TableSpec(f"{a}_raw", a, (ColumnSpec("id", "id", "integer"),), ("id",), (c.ForeignKey("id", f"{b}_raw", "id"),)) for a, b in ("ab", "ba")))
    with pytest.raises(c.ContractError, match="circle"):
        script.script(circle, {"a_raw": "x", "b_raw": "y"}, "silver")
