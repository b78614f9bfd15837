"""A proposal groups whole rows only of tables without a key."""

from assay.operators import profile
from assay.plans import proposal


def test_rows_of_a_keyed_table_are_not_grouped_whole(spark, monkeypatch):
    keyed = spark.createDataFrame([(1, "x"), (2, "x"), (3, "n/a")], "a_id bigint, v string")
    loose = spark.createDataFrame([("x", 1.5), ("x", 1.5), ("y", None)], "v string, w double")
    grouped, whole = [], profile.profile_table
    monkeypatch.setattr(profile, "profile_table", lambda name, df: grouped.append(name) or whole(name, df))
    rows = proposal.propose({"keyed": keyed, "loose": loose})
    assert grouped == ["loose"]
    assert {(r["table_name"], r["row_count"], r["duplicate_row_count"]) for r in rows} == {("keyed", "3", "0"), ("loose", "3", "2")}
    assert [r["nullable"] for r in rows] == ["False", "True", "False", "True"]
