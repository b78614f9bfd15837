"""Fixed values that cleaning and review rules share."""

# Texts that mean a missing value, compared trimmed and in lower case.
NULL_MARKERS = ("", "na", "n/a", "n.a.", "null", "none", "empty", "-", "--")

# Other ways to write currency codes, compared trimmed and in upper case.
CURRENCY_ALIASES = {
    "VND": "VND", "VNĐ": "VND", "VND.": "VND", "Đ": "VND",
    "USD": "USD", "US$": "USD", "$": "USD",
    "EUR": "EUR", "€": "EUR",
    "JPY": "JPY", "CNY": "CNY", "RMB": "CNY", "GBP": "GBP", "SGD": "SGD", "MYR": "MYR", "THB": "THB",
}
BASE_CURRENCY = "VND"

# What is suggested for each kind of issue.
SUGGESTED_ACTIONS = {
    "MISSING_VALUE": "STANDARDIZE_NULL_MARKERS",
    "EXACT_DUPLICATE": "REMOVE_EXACT_DUPLICATES",
    "TEXT_VARIANT": "APPLY_VALUE_MAPPING",
    "WHITESPACE": "STANDARDIZE_TEXT",
    "ALL_MISSING_COLUMN": "REVIEW_SCHEMA",
    "CONSTANT_COLUMN": "REVIEW_SCHEMA",
    "DATATYPE_PARSE": "REVIEW_SCHEMA_DATATYPE",
}
DEFAULT_ACTION = "REVIEW_ONLY"
DECISIONS = ("FIX", "KEEP", "BLOCK")

#: Longest text of a key column, in UTF-16 code units.
KEY_LENGTH = 100
