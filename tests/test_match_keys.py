"""Match keys of numbers, dates and flags need no pattern, and are those that patterns give."""

from pyspark.sql import functions as F

from assay.functions import clean
from assay.operators import inclusion, keys


def test_match_keys(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, -2L, 1.5D, 1e20D, 12.30BD, DATE'2020-01-02', TIMESTAMP'2020-01-02 03:04:05', true, '  A  b '),
        (null, 0L, double('nan'), double('-inf'), -0.01BD, null, TIMESTAMP'1900-01-01 00:00:00', false, null) t(i, l, d, e, n, day, at, flag, text)""")
    for c in df.columns:
        assert df.select(keys.match_keys(df, c).alias("k")).collect() == df.select(clean.match_key(F.col(c).cast("string")).alias("k")).collect()
    plan = inclusion.held_values({"t": df.drop("text")})._jdf.queryExecution().analyzed().toString()
    assert "regexp_replace" not in plan
    assert "regexp_replace" in inclusion.held_values({"t": df.select("text")})._jdf.queryExecution().analyzed().toString()
