"""Key quality shuffles plain keys once."""

import datetime

from assay.operators import keys


def test_key_quality_groups_plain_keys_once(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(1, day, "a"), (1, day, " A "), (None, day, "b"), (2, day, "c"), (2, None, "C"), (2, day, "n/a")]
    df = spark.createDataFrame(rows, "k bigint, d date, t string")
    plain = keys.key_quality(df, ["k", "d"])
    # One exchange by the key, one that unites the counts.
    assert plain._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert plain.first()[:] == ("k + d", 2, 2, 4, 2, "REVIEW_PK")
    assert keys.key_quality(df, ["k", "t"]).first()[:] == ("k + t", 2, 0, 0, 2, "REVIEW_PK")
    assert keys.key_quality(df.limit(0), ["k"]).first()[:] == ("k", 0, 0, 0, 0, "OK")
