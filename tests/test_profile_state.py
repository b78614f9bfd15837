"""Merged states are those of a profile from scratch, however the rows are split."""

import random

import pytest
from pyspark.sql import functions as F

from assay.operators import profile, profile_state

VALUES = [None, "", " ", "n/a", " N/A ", "null", "-", "1", "2.5", "1,000", "2025-01-02", "3/4/2025 10:00", "yes", "No", " x ", "a  b", "t\tb", "x" * 200, "é"]
EXACT = [*profile_state.COUNTS, *profile_state.TYPES, "issue_type", "example"]


def table(spark, n=200, seed=0):
    r = random.Random(seed)
    rows = [(r.choice(VALUES), str(i), "same", None if i % 2 else "n/a", r.choice(VALUES[:7])) for i in range(n)]
    return spark.createDataFrame(rows, "`a b` string, number string, same string, missing string, marks string")


def told(state, columns=EXACT):
    return {r.column_name: tuple(r[c] for c in columns) for r in profile_state.report(state).collect()}


@pytest.mark.parametrize("split", ["id % 2 = 0", "id < 3", "id % 7 < 6", "id < 0"])
def test_any_split_merges_to_the_whole(spark, split):
    df = table(spark).withColumn("id", F.col("number").cast("int"))
    whole = profile_state.profile_state(df.drop("id"))
    parts = [profile_state.profile_state(df.where(c).drop("id")) for c in (split, f"NOT ({split})")]
    both = profile_state.merged(parts[0].unionByName(parts[1]))
    assert told(both) == told(whole)
    estimates = [{r.column_name: r.distinct_estimate for r in profile_state.report(s).collect()} for s in (both, whole)]
    exact = {c: df.where(f"`{c}` IS NOT NULL").select(c).distinct().count() for c in ("number", "same")}
    for found in estimates:
        assert all(abs(found[c] - n) <= max(1, 0.08 * n) for c, n in exact.items())


def test_the_state_tells_what_profiles_tell(spark):
    df = table(spark)
    state = told(profile_state.profile_state(df))
    place = EXACT.index
    for r in profile.type_evidence(df).collect():
        assert [state[r.column_name][place(n)] for n in profile_state.TYPES] == [r[n] for n in profile_state.TYPES]
    for r in profile.missing_values(df).collect():
        assert [state[r.column_name][place(n)] for n in ("real_null", "marker_null", "example")] == [r.real_null, r.marker_null, r.example]
    for r in profile.whitespace_issues(df).collect():
        assert [state[r.column_name][place(n)] for n in ("edge", "repeated", "control", "stray")] == [r.edge, r.repeated, r.control, r.total]
    assert {c: x[place("issue_type")] for c, x in state.items() if x[place("issue_type")]} == {r.column_name: r.issue_type for r in profile.structure_issues(df).collect()}


def test_only_new_files_are_read(spark, tmp_path):
    raw, kept = f"{tmp_path}/raw", f"{tmp_path}/states"
    table(spark, 50).repartition(2).write.parquet(raw)
    first = told(profile_state.files_state(spark, spark.read.parquet(raw), kept))
    assert first == told(profile_state.profile_state(table(spark, 50)))
    table(spark, 90, seed=1).repartition(3).write.mode("append").parquet(raw)
    again = told(profile_state.files_state(spark, spark.read.parquet(raw), kept))
    assert again == told(profile_state.profile_state(spark.read.parquet(raw)))
    states = spark.read.parquet(kept)
    per_file = states.groupBy("file").count().collect()
    assert len(per_file) == 5 and {r["count"] for r in per_file} == {5}
    # A third run reads no file: the states alone tell, even with the rows gone.
    source = spark.read.parquet(raw)
    for f in source.inputFiles():
        path = f.removeprefix("file://")
        with open(path, "wb"):
            pass
    assert told(profile_state.files_state(spark, source, kept)) == again


def test_states_of_files_are_compiled(spark, tmp_path):
    """Java compiles the code of the one pass over cells; where it doesn't, Spark evaluates it much more slowly."""
    rows = [(" n/a ", "1"), (" x ", "2024-01-05"), ("N/A", ""), (None, "yes"), ("a  b", "x\x85")]
    spark.createDataFrame(rows, "a string, b string").write.parquet(f"{tmp_path}/raw")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        state = profile_state.files_state(spark, spark.read.parquet(f"{tmp_path}/raw"), f"{tmp_path}/states")
        found = {r.column_name: r for r in profile_state.report(state).collect()}
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    a, b = found["a"], found["b"]
    assert (a.row_count, a.real_null, a.marker_null, a.edge, a.repeated, a.example) == (5, 1, 2, 2, 1, " n/a  | N/A")
    assert (b.marker_null, b.edge, b.effective, b.numbers, b.dates, b.flags) == (1, 1, 4, 1, 1, 2)
