"""Keys of tables too large to be counted once for every combination."""

import itertools

from assay.operators import keys


def test_few_counts_of_the_whole_table(spark, monkeypatch):
    """Combinations around one whose values few rows share are asked of these rows alone."""
    monkeypatch.setattr(keys, "GLANCE", 200)
    monkeypatch.setattr(keys, "WITNESSES", 3000)
    df = spark.range(4000).selectExpr("CAST(id div 2 AS INT) AS a", "CAST(if(id < 4, 0, id % 2) AS INT) AS b", *[f"CAST(if(id < 4, id * {n}, 0) AS INT) AS c{n}" for n in range(1, 7)]).persist()
    whole = []
    plain = keys._twice
    monkeypatch.setattr(keys, "_twice", lambda df, combo: whole.append(combo) or plain(df, combo))
    rows, minimal = df.collect(), []
    for size in (1, 2, 3):
        for combo in itertools.combinations(df.columns, size):
            if not any(set(k) <= set(combo) for k in minimal) and len({tuple(r[c] for c in combo) for r in rows}) == len(rows):
                minimal.append(combo)
    assert keys.minimal_keys(df) == minimal and len(minimal) == 6
    assert whole == [("a", "b")]


def test_equal_hashes_are_no_equal_values(spark):
    """Nulls leave a hash as it is, so (null, 1) and (1, null) have one hash."""
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1)], "a int, b int")
    assert keys._twice(df, ("a", "b")).count() == 1 and keys.is_unique(df, ("a", "b"))
    assert not keys.is_unique(df.unionByName(df.limit(1)), ("a", "b"))
