"""Cleaning and typing of raw text, all as built-in expressions.

Nothing here fails on a bad value: what can't be read becomes null.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from assay.config import CURRENCY_ALIASES, NULL_MARKERS

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
_TIME = "[ HH:mm[:ss[.SSSSSS][.SSS]]]"
_SHORT_TIME = "[ H:mm[:ss]]"
#: Shape of a date text and the format that reads it; the first shape that fits decides.
DATE_SHAPES = (
    (r"^[12]\d{3}-", f"yyyy-MM-dd{_TIME}"),
    (r"^[12]\d{3}/", f"yyyy/M/d{_SHORT_TIME}"),
    (r"/", f"d/M/yyyy{_SHORT_TIME}"),
    (r"-", f"M-d-yyyy{_SHORT_TIME}"),
    (r"^[12]\d{3}[01]\d[0-3]\d$", "yyyyMMdd"),
)
TRUE_TEXTS, FALSE_TEXTS = ("true", "1", "yes", "y", "t"), ("false", "0", "no", "n", "f")


def stripped(c: Column) -> Column:
    """Without any white space at either end. Texts whose ends are visible ASCII spare the pattern."""
    plain = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(plain, c).otherwise(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def match_key(c: Column, bare: bool = False) -> Column:
    """What texts that differ in case and white space only share; bare: they are stripped already."""
    return F.lower(F.regexp_replace(c if bare else stripped(c), r"(?U)\s+", " "))


def join_key(c: Column) -> Column:
    """Stripped, in lower case; inner white space stays."""
    return F.lower(stripped(c))


def is_marker(c: Column, markers: Iterable[str] = NULL_MARKERS) -> Column:
    """Whether a text that isn't null means a missing value."""
    return c.isNotNull() & match_key(c).isin(*markers)


def is_missing(c: Column, markers: Iterable[str] = NULL_MARKERS) -> Column:
    return c.isNull() | is_marker(c, markers)


def without_markers(c: Column, markers: Iterable[str] = NULL_MARKERS) -> Column:
    """Null instead of a missing-value text; other texts stay as they are."""
    return F.when(~F.lower(F.trim(c)).isin(*markers), c)


def tidy(c: Column) -> Column:
    """Trimmed, runs of white space as one space, case kept."""
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def _lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("string")


def map_values(c: Column, mapping: Mapping[str, str]) -> Column:
    """The canonical value of a text by its trimmed lower-case form; others stay."""
    return F.coalesce(_lookup(F.lower(F.trim(c)), {k.strip().lower(): v for k, v in mapping.items()}), c)


def currency_code(c: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Upper-case code; known aliases become their code, unknown codes stay."""
    known = {k.strip().upper(): v.strip().upper() for k, v in (CURRENCY_ALIASES | dict(aliases or {})).items()}
    key = F.upper(F.trim(c))
    return F.coalesce(_lookup(key, known), key)


def number_text(c: Column) -> Column:
    """Trimmed number without thousands commas; parentheses mean a negative number."""
    plain = F.replace(F.trim(c), F.lit(","), F.lit(""))
    inner = F.regexp_extract(plain, r"^\((.*)\)$", 1)
    return F.when(plain.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), inner)).otherwise(plain)


def to_decimal(c: Column) -> Column:
    text = number_text(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("decimal(38,10)"))


def to_integer(c: Column) -> Column:
    """Null if there is a fraction."""
    number = to_decimal(c)
    return F.when(F.floor(number) == number, number.try_cast("bigint"))


def to_timestamp(c: Column) -> Column:
    """Read by shape: ISO, year first, day/month/year, month-day-year, eight digits."""
    text = F.trim(c)
    found = None
    for i, (shape, pattern) in enumerate(DATE_SHAPES):
        source = F.regexp_replace(text, "T", " ") if i == 0 else text
        value = F.try_to_timestamp(source, F.lit(pattern)).cast("timestamp_ntz")
        found = F.when(text.rlike(shape), value) if found is None else found.when(text.rlike(shape), value)
    return found


def to_boolean(c: Column) -> Column:
    key = F.lower(F.trim(c))
    return F.when(key.isin(*TRUE_TEXTS), True).when(key.isin(*FALSE_TEXTS), False)


def to_logical(c: Column, datatype: str) -> Column:
    """A text as a value of a logical type; null if it isn't one."""
    return {
        "string": lambda: c.cast("string"),
        "integer": lambda: to_integer(c),
        "decimal": lambda: to_decimal(c),
        "date": lambda: to_timestamp(c).cast("date"),
        "datetime": lambda: to_timestamp(c),
        "boolean": lambda: to_boolean(c),
    }[datatype]()


def is_currency_code(c: Column) -> Column:
    return c.rlike("^[A-Z]{3}$")


def edge_space(c: Column) -> Column:
    return c != stripped(c)


def repeated_space(c: Column) -> Column:
    return c.rlike(" {2,}")


def control_space(c: Column) -> Column:
    return c.rlike(r"[\t\r\n]")


def examples(c: Column, most: int) -> Column:
    """Aggregate: the first `most` distinct values in order, joined by ` | `."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(c)), 1, most), " | ")
