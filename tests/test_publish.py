"""Versions, guarded writes, enforced rows and the order of builds."""

import itertools

import pytest
from pyspark.sql import functions as F

from assay.operators import guards, transform
from assay.plans import contract as c
from assay.plans import order
from assay.plans.contract import ColumnSpec, Contract, ForeignKey, TableSpec
from assay.sources import publish, snapshots
from tests.test_contract import DECISIONS, RULES, SCHEMA, sources


@pytest.fixture
def contract():
    return c.compile_contract(SCHEMA, DECISIONS, RULES)


def content(tables):
    return {n: sorted(map(str, df.collect())) for n, df in tables.items()}


def star(spark, suffix=""):
    """Two tables, one referring to the other."""
    number, text = ColumnSpec("id", "id", "integer", False), ColumnSpec("name", "name", "string")
    child = TableSpec("kids_raw", "kids", (number, text, ColumnSpec("of", "of", "integer")), ("id",), (ForeignKey("of", "folk_raw", "id"),))
    made = Contract((child, TableSpec("folk_raw", "folk", (number, text), ("id",))))
    folk = spark.createDataFrame([("1", f"x{suffix}"), ("2", "y")], "id string, name string")
    return made, {"folk_raw": folk, "kids_raw": folk.withColumn("of", F.lit("2"))}


def test_stopped_at_any_step_one_whole_version_is_readable(spark, monkeypatch):
    (made, old), (_, new), steps = star(spark), star(spark, " new"), []
    publish.publish(spark, old, made, "stops")
    root = publish.root_of(spark, "stops")
    now = content(snapshots.read(spark, root))
    monkeypatch.setattr(publish, "_step", steps.append)
    publish.publish(spark, new, made, "stops", overwrite=True)
    then, now = now, content(snapshots.read(spark, root))
    assert then != now and steps == ["built folk", "built kids", "checked", "committed", "pointed kids", "pointed folk"]
    for place, stop in enumerate(steps):

        def dies(name):
            if name == stop:
                raise KeyboardInterrupt(name)

        monkeypatch.setattr(publish, "_step", dies)
        monkeypatch.setattr(snapshots, "delete", lambda *_: None)  # a dead driver tidies nothing up
        with pytest.raises(KeyboardInterrupt):
            publish.publish(spark, old, made, "stops", overwrite=True)
        monkeypatch.undo()
        if place >= 3:
            then, now, old, new = now, then, new, old
        assert content(snapshots.read(spark, root)) == now
        assert publish.recover(spark, "stops") == snapshots.latest(spark, root)
        assert content({n: spark.table(f"stops.{n}") for n in now}) == now
    left = set(snapshots._names(spark, f"{root}/{snapshots.RUNS}"))
    assert snapshots.vacuum(spark, root, keep=1) == [] and content(snapshots.read(spark, root)) == now
    gone = snapshots.vacuum(spark, root, keep=1, older_than=-1e6)
    assert set(gone) == left - {snapshots.manifest(spark, root)["run"]} and len(gone) >= 3
    assert content({n: spark.table(f"stops.{n}") for n in now}) == now == content(snapshots.read(spark, root))


def test_only_one_of_two_publishers_gets_a_version(spark, tmp_path):
    root = f"file://{tmp_path}"
    table = {"folder": f"{root}/_runs/a/t", "rows": 1, "columns": [], "primary_key": [], "foreign_keys": []}
    assert snapshots.latest(spark, root) == 0 and snapshots.read(spark, root) == {}
    assert snapshots.commit(spark, root, 0, "a", {"t": table}) == 1
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, root, 0, "b", {"u": table})
    assert snapshots.commit(spark, root, 1, "b", {"u": table}) == 2
    assert sorted(snapshots.manifest(spark, root)["tables"]) == ["t", "u"] and sorted(snapshots.manifest(spark, root, 1)["tables"]) == ["t"]


def test_one_pass_over_raw_rows(spark, contract, tmp_path):
    raw, rates = sources(spark)
    reads = tmp_path / "reads"

    def counting(batches):
        for batch in batches:
            with open(reads, "a") as file:
                file.write("x" * len(batch))
            yield batch

    def counted(df):
        return df.mapInPandas(counting, df.schema)

    publish.publish(spark, {n: counted(df) for n, df in raw.items()}, contract, "once", rates=rates)
    assert len(reads.read_text()) == sum(df.count() for df in raw.values())


def test_counts_of_the_write_are_those_of_the_report(spark, contract, tmp_path):
    raw, rates = sources(spark)
    bad = raw["sales_raw"].union(spark.createDataFrame([("x", "a", "oops", "usd", "2024-01-01"), ("9", None, "5", "usd", "2024-01-01"), ("2", "a" * 500, "5", "eur", "1/1/2025")], raw["sales_raw"].schema))
    table = contract.table("sales")
    written = publish.write_guarded(bad, table, contract, f"{tmp_path}/sales", rates)
    report = {tuple(r) for r in guards.guard_counts(transform.typed_with_cleaned(bad, table, contract, rates), table).collect()}
    assert set(written.guards) == report and sum(n for *_, n in written.guards) >= 5
    assert (written.input_rows, written.rows) == (6, 5) and written.changed_rows == transform.before_after(bad, table, contract, rates).first().changed_rows
    with pytest.raises(Exception, match="51001 sales.sale_id"):
        publish.write_guarded(bad.where("amount = 'oops'"), table, contract, f"{tmp_path}/strict", rates, strict=True)
    with pytest.raises(Exception, match="51006 sales.person_id"):
        publish.write_guarded(bad.where("length(person_id) > 100"), table, contract, f"{tmp_path}/strict2", rates, strict=True)
    with pytest.raises(guards.GuardError, match="5100"):
        publish.publish(spark, raw | {"sales_raw": bad}, contract, "bad", rates=rates, strict=True)
    assert spark.sql("SHOW TABLES IN bad").count() == 0 and snapshots.latest(spark, publish.root_of(spark, "bad")) == 0


def test_constraints_come_back_from_the_catalog(spark, contract):
    raw, rates = sources(spark)
    publish.publish(spark, raw, contract, "kept", rates=rates)
    found = {(r.table_name, r.kind, r.columns, r.reference) for r in publish.constraints(spark, "kept").collect()}
    assert {("sales", "PRIMARY KEY", "sale_id", ""), ("sales", "FOREIGN KEY", "person_id", "people.person_id"), ("people", "NOT NULL", "person_id", ""), ("people", "LENGTH", "person_id", "varchar(100)")} <= found
    assert {r.bad_rows for r in publish.constraint_report(spark, "kept").collect()} == {0}
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql("INSERT INTO kept.people VALUES (repeat('x', 101), 'y')")
    spark.createDataFrame([("z", None), ("z", None), (None, "n")], "person_id string, name string").write.insertInto("kept.people")
    bad = {(r.kind, r.columns): r.bad_rows for r in publish.constraint_report(spark, "kept").where("table_name = 'people'").collect()}
    assert bad == {("PRIMARY KEY", "person_id"): 1, ("NOT NULL", "person_id"): 1, ("LENGTH", "person_id"): 0}


def chain(*edges, names="abcde"):
    return Contract(tuple(
        TableSpec(f"{n}_raw", n, (ColumnSpec("id", "id", "integer"),), ("id",), tuple(ForeignKey("id", f"{p}_raw", "id") for x, p in edges if x == n)) for n in names
    ))


def test_order_of_builds():
    edges = (("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("a", "a"))
    for names in itertools.permutations("abcde"):
        assert order.levels(chain(*edges, names=names)) == [["a", "e"], ["b", "c"], ["d"]]
    with pytest.raises(c.ContractError, match="a -> .* -> a|b -> .* -> b|c -> .* -> c"):
        order.levels(chain(("b", "a"), ("c", "b"), ("a", "c")))
    done = []

    def build(name):
        if name == "b":
            raise ValueError("no b")
        done.append(name)
        return name.upper()

    found = order.build_all(chain(*edges), build)
    assert {n: o.status for n, o in found.items()} == {"a": "BUILT", "b": "FAILED", "c": "BUILT", "d": "SKIPPED", "e": "BUILT"}
    assert found["b"].why == "no b" and found["d"].why == "not built: b" and found["e"].result == "E" and "d" not in done


def test_publish_in_any_order(spark, contract):
    raw, rates = sources(spark)
    for tables in itertools.permutations(contract.tables):
        publish.publish(spark, raw, c.Contract(tables, contract.base_currency, contract.aliases), "any", overwrite=True, rates=rates)
        assert spark.table("any.sales").where(F.col("amount_vnd").isNotNull()).count() == 2
    lost = raw | {"people_raw": raw["people_raw"].withColumn("person_id", F.lit(None).cast("string"))}
    with pytest.raises(guards.GuardError) as error:
        publish.publish(spark, lost, contract, "any", overwrite=True, rates=rates)
    assert "51003 people.person_id: 2 rows" in str(error.value) and "sales not built: people" in str(error.value)
    assert spark.table("any.people").count() == 2
