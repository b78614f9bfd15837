"""Names of columns, tables and constraints."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_name(name: str) -> str:
    """Lower-case name of letters, digits and single underscores, without a last `_raw`."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_").removesuffix("_raw").strip("_")


def table_name(name: str, configured: str | None = None) -> str:
    """Name of the typed table that a raw table becomes."""
    return configured or name.removesuffix("_raw")


def is_currency_column(name: str) -> bool:
    """Whether a column holds currency codes, by its name."""
    return name in ("currency", "currency_code") or name.endswith("_currency_code") or (
        name.endswith("_currency") and not name.endswith("_per_currency")
    )


def constraint_name(*parts: str, limit: int = 120) -> str:
    """Name of a constraint; over the limit its end is replaced by a hash."""
    name = re.sub(r"[^0-9A-Za-z]", "_", "_".join(parts))
    if len(name) <= limit:
        return name
    return f"{name[: limit - 9]}_{hashlib.sha1(name.encode()).hexdigest()[:8]}"


def quoted(*parts: str) -> str:
    """A Spark SQL identifier, quoted part by part."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def literal(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def comment(text: str) -> str:
    """One line of an SQL comment."""
    return "-- " + " ".join(text.split())


# The same of names that lie in a column, such as those of a catalog of very many tables.


def column_names(c: Column) -> Column:
    """column_name() of each."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.regexp_replace(F.regexp_replace(plain, "_raw$", ""), "_+$", "")


def table_names(c: Column) -> Column:
    """table_name() of each."""
    return F.regexp_replace(c, "_raw$", "")


def are_currency_columns(c: Column) -> Column:
    """is_currency_column() of each."""
    return c.isin("currency", "currency_code") | c.endswith("_currency_code") | (c.endswith("_currency") & ~c.endswith("_per_currency"))


def constraint_names(*parts: Column, limit: int = 120) -> Column:
    """constraint_name() of each."""
    whole = F.regexp_replace(F.concat_ws("_", *parts), "[^0-9A-Za-z]", "_")
    short = F.concat(F.substring(whole, 1, limit - 9), F.lit("_"), F.left(F.sha1(whole.cast("binary")), F.lit(8)))
    return F.when(F.length(whole) <= limit, whole).otherwise(short)


def quoted_names(c: Column) -> Column:
    """quoted() of each."""
    return F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))


def literals(c: Column) -> Column:
    """literal() of each."""
    return F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))


def comments(c: Column) -> Column:
    """comment() of each."""
    return F.concat(F.lit("-- "), F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", ""))
