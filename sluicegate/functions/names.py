"""Column and table names as expressions, so the headers of a whole file set go in one job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters are letters and digits of any script plus "_"; combining marks are not.
NON_WORD = r"[^\p{L}\p{N}_]"
NON_WORD_NON_SPACE = r"(?U)[^\p{L}\p{N}_\s]"
SPACES = r"(?U)\s+"
LEADING_DIGIT = r"^\p{Nd}"
LEADING_LETTER = r"^[a-zA-Z_]"

PREFIX = "col_"
UNNAMED = "unnamed_column"


def sanitize_name(name: Column) -> Column:
    """Non-word characters and runs of ``_`` become one ``_``; a leading digit gets a prefix.

    Case is kept.
    """
    word = F.regexp_replace(F.regexp_replace(name, NON_WORD, "_"), "_+", "_")
    return F.when(word.rlike(LEADING_DIGIT), F.concat(F.lit(PREFIX), word)).otherwise(word)


def normalize_name(name: Column) -> Column:
    """Lower-case name: punctuation and white space become ``_``, NULL becomes a fixed name.

    Unlike :func:`sanitize_name`, runs of ``_`` from punctuation stay, and the prefix is
    added whenever the first character is not an ASCII letter or ``_``.
    """
    marked = F.regexp_replace(name, NON_WORD_NON_SPACE, "_")
    word = F.regexp_replace(marked, SPACES, "_")
    needs_prefix = (F.length(word) > 0) & ~word.rlike(LEADING_LETTER)
    prefixed = F.when(needs_prefix, F.concat(F.lit(PREFIX), word)).otherwise(word)
    return F.coalesce(F.lower(prefixed), F.lit(UNNAMED))


def table_name_from_path(path: Column) -> Column:
    """File stem, lower case, with spaces and hyphens as ``_``."""
    stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    return F.translate(F.lower(stem), " -", "__")
