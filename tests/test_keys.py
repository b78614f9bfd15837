"""Keys found exactly, and references by the values that columns hold."""

import itertools
import random

import pytest

from assay.functions import clean
from assay.operators import inclusion, keys
from pyspark.sql import functions as F


def plain_unique(rows, columns, combo):
    if len(combo) == 1:
        held = [str(r[columns.index(combo[0])]).strip().lower() for r in rows]
    else:
        held = [tuple(r[columns.index(c)] for c in combo) for r in rows]
    return len(set(held)) == len(held)


@pytest.mark.parametrize("witnesses", [1, 4_000_000])
@pytest.mark.parametrize("seed", range(2))
def test_the_key_is_that_of_exact_counting(spark, monkeypatch, witnesses, seed):
    monkeypatch.setattr(keys, "WITNESSES", witnesses)
    r = random.Random(seed)
    columns = ["a_id", "line", "b_id", "order date", "sequence"]
    sizes = [r.choice([2, 3, 5, 12]) for _ in columns]
    every = list(itertools.product(*[range(n) for n in sizes[: 2 + seed % 2]]))
    rows = [(*map(str, x), *[str(r.randrange(n)) for n in sizes[len(x) :]]) for x in every]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).repartition(3)
    minimal = []
    for size in (1, 2, 3):
        minimal += [c for c in itertools.combinations(columns, size) if plain_unique(rows, columns, c) and not any(set(k) <= set(c) for k in minimal)]
    assert keys.minimal_keys(df) == minimal
    if not any(len(k) == 1 for k in minimal):
        first = next(c for size in (2, 3) for c in itertools.combinations(columns, size) if plain_unique(rows, columns, c))
        assert keys.suggest_primary_key(df) == list(first)


@pytest.mark.parametrize("witnesses", [1, 4_000_000])
def test_one_pair_of_equal_rows_is_enough(spark, monkeypatch, witnesses):
    """An almost-key with a single repeat is no key, and a true key right behind it is found."""
    monkeypatch.setattr(keys, "WITNESSES", witnesses)
    df = spark.range(5000).selectExpr(
        "CAST(greatest(id, 1) AS STRING) AS near_id", "CAST(id AS STRING) AS true_id", "CASE WHEN id % 2 = 0 THEN concat(' K', id) ELSE concat('k', id - 1, ' ') END AS k_id", "if(id = 7, 'n/a', CAST(id AS STRING)) AS gap_id"
    )
    assert keys.suggest_primary_key(df) == ["true_id"] and keys.minimal_keys(df, most_parts=1) == [("true_id",)]
    assert not keys.is_unique(df, ("near_id",)) and not keys.is_unique(df, ("k_id",)) and keys.is_unique(df, ("near_id", "k_id"))
    assert keys.suggest_primary_key(df.drop("true_id")) == ["near_id", "k_id"] and keys.complete_columns(df) == (5000, ["near_id", "true_id", "k_id"])
    assert keys.suggest_primary_key(df.limit(0).select("near_id")) == ["near_id"] and keys.disproved(df, [], 1) == []


def test_candidates_shuffle_no_long_value(spark):
    df = spark.createDataFrame([("x" * 500, " A"), ("X" * 500 + " ", "a"), (None, "b")], "long string, short string")
    assert {tuple(r) for r in keys.key_candidates(df).collect()} == {("long", 3, 1, 1), ("short", 3, 0, 2)}
    grouped = df.select(keys._digest(clean.join_key(F.col("long"))).alias("k")).collect()
    assert max(len(r.k or "") for r in grouped) == 64


def test_inclusions_are_match_rates(spark):
    one = spark.createDataFrame([("1", "a", "x"), ("2", " B ", None), ("3", "b", "q"), ("3", None, "")], "p string, name string, other string")
    two = spark.createDataFrame([(1, "A"), (2, "b"), (5, "c")], "number int, letter string")
    none = spark.createDataFrame([], "p string")
    tables = {"one": one, "two": two, "none": none}
    found = {tuple(r)[:4]: tuple(r)[4:] for r in inclusion.dependencies(tables).collect()}
    for (a, x), (b, y) in itertools.permutations(tables.items(), 2):
        for c, p in itertools.product(x.columns, y.columns):
            rate = keys.match_rate(x, c, y, p).first()
            if rate.matched_rows:
                assert found.pop((a, c, b, p))[:3] == tuple(rate)
    assert not found
    best = {tuple(r)[:2]: tuple(r)[2:] for r in inclusion.proposed(inclusion.dependencies(tables)).collect()}
    assert best == {("one", "name"): ("two", "letter", 1.0)}
    assert inclusion.dependencies({"none": none, "more": none}).count() == 0


def test_a_value_of_most_rows_is_counted_before_it_meets(spark):
    df = spark.range(20_000).selectExpr("'same' AS a", "CAST(id % 7 AS STRING) AS b")
    held = inclusion.held_values({"x": df, "y": df})
    assert sorted(len(r.held) for r in held.collect()) == [2] * 8
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan
