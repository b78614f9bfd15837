import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.functions import clean, names
from assay.operators import keys, profile
from assay.types import logical_type


def one(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in frame.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


CASES = [
    (clean.without_markers, [" N/A ", "NULL", "--", "", "unknown", None], [None, None, None, None, "unknown", None]),
    (clean.tidy, [" Clean  Health\tVietnam  ", None], ["Clean Health Vietnam", None]),
    (lambda c: clean.map_values(c, {"fb ads": "Facebook Ads", "facebook": "Facebook Ads"}), ["FB Ads", " facebook ", "TikTok", None], ["Facebook Ads", "Facebook Ads", "TikTok", None]),
    (clean.currency_code, ["us$", "VNĐ", "rmb", " eur ", "xyz", None], ["USD", "VND", "CNY", "EUR", "XYZ", None]),
    (clean.to_decimal, ["1,250.50", "(123)", "abc", "", "1e3", "inf"], [Decimal("1250.5"), Decimal(-123), None, None, None, None]),
    (clean.to_integer, ["457000.0", "12.5", "1,000", "x"], [457000, None, 1000, None]),
    (clean.to_boolean, ["Yes", "t", "0", "F", "maybe", None], [True, True, False, False, None, None]),
    (
        clean.to_timestamp,
        ["2026-05-02 10:00:00", "2026/05/02 10:00", "02/05/2026", "02-05-2026", "20260502", "May 2", "31/02/2025", "2026-05-02T10:00:00"],
        [dt.datetime(2026, 5, 2, 10), dt.datetime(2026, 5, 2, 10), dt.datetime(2026, 5, 2), dt.datetime(2026, 2, 5), dt.datetime(2026, 5, 2), None, None, dt.datetime(2026, 5, 2, 10)],
    ),
    (clean.match_key, [" direct  ", "Direct", "a  b"], ["direct", "direct", "a b"]),
]


@pytest.mark.parametrize("expression, values, expected", CASES)
def test_expressions(spark, expression, values, expected):
    assert one(spark, expression, values) == expected


@pytest.mark.parametrize("expression", [clean.without_markers, clean.tidy, clean.currency_code])
def test_cleaning_twice_changes_nothing(spark, expression):
    values = [" a  b ", "n/a", "\t", "US$", "x\n\ny", None, "--"]
    assert one(spark, expression, one(spark, expression, values)) == one(spark, expression, values)


def test_names():
    assert [names.column_name(n) for n in ("Order Date Raw", "customer-id", "province_raw")] == ["order_date", "customer_id", "province"]
    assert [names.is_currency_column(n) for n in ("currency", "fee_currency", "vnd_per_currency", "tax_currency_code", "cur")] == [True, True, False, True, False]
    assert len(names.constraint_name("fk", "x" * 200)) == 120 and names.quoted("a`b", "c") == "`a``b`.`c`"
    assert names.table_name("orders_raw") == "orders" and logical_type(" Money ") == "decimal"
    with pytest.raises(ValueError):
        logical_type("blob")


def test_examples_are_the_first_values(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "x"), ("a", None), ("a", "w"), ("b", None)]
    frame = spark.createDataFrame(rows, "k string, v string")
    found = profile.with_examples(frame, ["k"], F.col("v"), F.lit(1), 2)
    assert {tuple(r) for r in found.collect()} == {("a", 5, "w | x"), ("b", 1, "")}
    whole = profile.with_examples(frame, [], F.col("v"), F.lit(1), 2)
    assert [tuple(r) for r in whole.collect()] == [(6, "w | x")]
    assert [tuple(r) for r in profile.with_examples(frame.limit(0), [], F.col("v"), F.lit(1), 2).collect()] == [(0, "")]


def test_duplicate_key_rows(spark):
    frame = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "a", 3), (None, "a", 4), (2, "a", 5)], "k int, l string, v int")
    assert sorted((r.v, r.key_rows) for r in keys.duplicate_key_rows(frame, ["k", "l"]).collect()) == [(1, 2), (2, 2), (3, 2), (4, 2)]
