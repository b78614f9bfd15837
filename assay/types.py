"""The six logical types and their Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

LOGICAL: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "decimal": T.DecimalType(38, 10),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}
# Other names of the types.
ALIASES = {
    "str": "string", "text": "string", "int": "integer", "bigint": "integer", "float": "decimal",
    "numeric": "decimal", "money": "decimal", "timestamp": "datetime", "bool": "boolean",
}


def logical_type(name: str) -> str:
    """Canonical name of a logical type, or ValueError."""
    key = (name or "").strip().lower()
    key = ALIASES.get(key, key)
    if key not in LOGICAL:
        raise ValueError(f"unknown data type {name!r}")
    return key
