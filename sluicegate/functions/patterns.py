"""Patterns, tokens and limits that decide results.

These must equal the documented rules for results to agree, so they are listed here
as plain text and used nowhere else in literal form.
"""

from __future__ import annotations

# -- fixed values -----------------------------------------------------------------

# A value looks like a date when it *starts* with one of these.
DATE_PREFIXES = [
    r"\d{4}-\d{2}-\d{2}",
    r"\d{2}/\d{2}/\d{4}",
    r"\d{2}-\d{2}-\d{4}",
    r"\d{2}\.\d{2}\.\d{4}",
]

# A value looks like a time of day when it starts with one of these.
TIME_PREFIXES = [
    r"\d{2}:\d{2}:\d{2}",
    r"\d{2}:\d{2}",
]

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE = r"^\+?[\d\s\(\)-]{7,20}$"

# Prefix patterns of the "is this column probably a date-time" test.
DATETIME_PREFIXES = [
    r"\d{4}-\d{2}-\d{2}",
    r"\d{2}/\d{2}/\d{4}",
    r"\d{2}-\d{2}-\d{4}",
    r"\d{4}/\d{2}/\d{2}",
    r"\d{2}/\d{2}/\d{2}",
    r"\d{2}-\d{2}-\d{2}",
    r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}",
    r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}",
]
DATETIME_SHARE = 0.7

# Longest value (characters) -> text type; longer than the last is LONGTEXT.
TEXT_BUCKETS = [
    (10, "VARCHAR(10)"),
    (50, "VARCHAR(50)"),
    (100, "VARCHAR(100)"),
    (255, "VARCHAR(255)"),
    (1000, "TEXT"),
]
LONG_TEXT = "LONGTEXT"

# Separators tried for a file, in order of preference.
CONSISTENT_DELIMITERS = [",", ";", "\t", "|", ":"]
FREQUENT_DELIMITERS = [",", ";", "\t", "|", " "]
DEFAULT_DELIMITER = ","
HEAD_LINES = 5

# Texts read as missing: the default list of pandas.read_csv.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Status values, most severe first.
STATUSES = ["Failed", "Error", "Warning", "Passed"]

# -- end of fixed values ----------------------------------------------------------

# Whole-value number forms accepted when typing text.
INTEGER = r"^[+-]?\d+$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# A time of day after a date, and as a whole value; both always convert.
CLOCK_SUFFIX = r"^[ T]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?$"
CLOCK = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"


def any_prefix(patterns: list[str]) -> str:
    """One regular expression that matches when a value starts with any of ``patterns``."""
    return "^(?:" + "|".join(patterns) + ")"
