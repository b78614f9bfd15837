"""Exchange rates: preparation, exact and as-of joins, and what couldn't be converted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.functions import clean

#: Rates up to this number go to every task; more are joined by currency and month.
BROADCAST_RATES = 500_000


def prepare_rates(rates: DataFrame, date_col: str = "date", currency_col: str = "currency", rate_col: str = "vnd_per_currency", aliases: dict | None = None, order_col: str | None = None) -> DataFrame:
    """(currency, date, rate): typed, complete, one row for each currency and day.

    Of several rates of a day the last by order_col counts (the highest of those that tie);
    Spark's rows have no order of their own, so without order_col it is the highest.
    """
    typed = rates.select(
        clean.currency_code(F.col(currency_col).cast("string"), aliases).alias("currency"),
        clean.to_timestamp(F.col(date_col).cast("string")).cast("date").alias("date"),
        clean.to_decimal(F.col(rate_col).cast("string")).alias("rate"),
        (F.col(order_col) if order_col else F.lit(0)).alias("place"),
    ).dropna(subset=["currency", "date", "rate"])
    last = F.max(F.struct("place", "rate"))
    return typed.groupBy("currency", "date").agg(last.alias("last")).select("currency", "date", F.col("last.rate").alias("rate"))


def _small(rates: DataFrame) -> bool:
    return rates.limit(BROADCAST_RATES + 1).count() <= BROADCAST_RATES


def exact_rate(tx: DataFrame, rates: DataFrame, currency_col: str, date_col: str, output: str = "fx_rate", base: str | None = None) -> DataFrame:
    """tx with the rate of its currency on its very day; 1 for the base currency."""
    side = rates.select(F.col("currency").alias("__c"), F.col("date").alias("__d"), F.col("rate").alias("__rate"))
    side = F.broadcast(side) if _small(rates) else side
    joined = tx.join(side, (F.col(currency_col) == F.col("__c")) & (F.col(date_col).cast("date") == F.col("__d")), "left")
    return joined.withColumn(output, _or_base(currency_col, base)).drop("__c", "__d", "__rate")


def asof_rate(tx: DataFrame, rates: DataFrame, currency_col: str, date_col: str, output: str = "fx_rate", base: str | None = None) -> DataFrame:
    """tx with the latest rate of its currency up to its day; 1 for the base currency.

    Each rate holds until the next; a transaction meets the one that holds on its day. Few
    rates are broadcast, so transactions aren't shuffled. Many are cut by month, so that a
    currency of most transactions is spread over its months.
    """
    nxt = F.lead("date").over(Window.partitionBy("currency").orderBy("date"))
    held = rates.select(F.col("currency").alias("__c"), F.col("date").alias("__from"), nxt.alias("__to"), F.col("rate").alias("__rate"))
    day = F.col(date_col).cast("date")
    inside = (F.col(currency_col) == F.col("__c")) & (day >= F.col("__from")) & (F.col("__to").isNull() | (day < F.col("__to")))
    if _small(rates):
        joined = tx.join(F.broadcast(held), inside, "left")
    else:
        last = tx.agg(F.max(day)).first()[0]
        until = F.greatest(F.coalesce("__to", F.lit(last).cast("date"), "__from"), "__from")
        months = F.explode(F.sequence(F.trunc("__from", "month"), F.trunc(until, "month"), F.expr("interval 1 month")))
        joined = tx.withColumn("__m", F.trunc(day, "month")).join(held.withColumn("__month", months), inside & (F.col("__m") == F.col("__month")), "left").drop("__m", "__month")
    return joined.withColumn(output, _or_base(currency_col, base)).drop("__c", "__from", "__to", "__rate")


def _or_base(currency_col: str, base: str | None):
    return F.when(F.col(currency_col) == base, F.lit(1).cast("decimal(38,10)")).otherwise(F.col("__rate")) if base else F.col("__rate")


def with_rate(tx: DataFrame, rates: DataFrame, currency_col: str, date_col: str, output: str, base: str | None, rule: str) -> DataFrame:
    """By the rule for missing rates."""
    if rule == "previous_available_rate":
        return asof_rate(tx, rates, currency_col, date_col, output, base)
    if rule == "exact":
        return exact_rate(tx, rates, currency_col, date_col, output, base)
    raise ValueError(f"unknown missing-rate rule {rule!r}")


def converted(amount: str, rate: str):
    """The amount in the base currency, DECIMAL(38,10)."""
    return (F.col(amount).cast("decimal(38,10)") * F.col(rate)).cast("decimal(38,10)")


def conversion_report(tx: DataFrame, rates: DataFrame, amount: str, currency: str, rate: str, base: str) -> DataFrame:
    """One row: converted, without a rate, and with a code that no rate has."""
    codes = rates.select(F.col("currency").alias("__code")).distinct()
    foreign = (F.col(currency) != base) & F.col(amount).isNotNull()
    joined = tx.join(codes, F.col(currency) == F.col("__code"), "left")
    return joined.agg(
        F.count_if(F.col(amount).isNotNull() & F.col(rate).isNotNull()).alias("converted_row_count"),
        F.count_if(foreign & F.col(rate).isNull()).alias("missing_fx_count"),
        F.count_if(foreign & F.col("__code").isNull()).alias("invalid_currency_count"),
    )
