"""Human-readable sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KB = 1024
MB = 1024 * 1024
GB = 1024 * 1024 * 1024


def two_decimals(value: Column) -> Column:
    """A number as text with exactly two decimals, without engine-specific formatting."""
    return F.round(value, 2).cast("decimal(30,2)").cast("string")


def size_text(size: Column) -> Column:
    """``n B`` below 1024, then KB, MB and GB with two decimals."""

    def scaled(unit: int, label: str) -> Column:
        return F.concat(two_decimals(size.cast("double") / unit), F.lit(label))

    return (
        F.when(size < KB, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < MB, scaled(KB, " KB"))
        .when(size < GB, scaled(MB, " MB"))
        .otherwise(scaled(GB, " GB"))
    )
