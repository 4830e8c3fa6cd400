"""The whole profile of a table, one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.operators import profile as P
from sluicegate.workspace import staged


def column_profile(df: DataFrame, k: int = 5) -> DataFrame:
    """Type, missing and distinct counts of every column, numeric or text facts, top values.

    Counts, numeric and text facts share one aggregate; distinct counts and top values move
    digests of long texts, not the texts. The parts have one row per column, so joining them moves
    only report rows. The parts read the table several times, so it is staged first: what it is
    made of, such as parsed lines, is computed once.
    """
    df = staged(df, "profiled")
    numbers, texts = set(P.numeric_columns(df)), set(P.string_columns(df))
    nothing = F.max(F.lit(None).cast("double"))

    def of(kind: set[str], make):
        return lambda c: make(c) if c in kind else nothing

    facts = P.one_pass(
        df,
        df.columns,
        {
            "null_count": lambda c: F.count_if(P.is_missing(df, c)),
            "min_val": of(numbers, lambda c: F.min(P.present(df, c)).cast("double")),
            "max_val": of(numbers, lambda c: F.max(P.present(df, c)).cast("double")),
            "mean_val": of(numbers, lambda c: F.avg(P.present(df, c).cast("double"))),
            "std_val": of(numbers, lambda c: F.stddev_samp(P.present(df, c).cast("double"))),
            "avg_length": of(texts, lambda c: F.coalesce(F.avg(F.length(df[c])), F.lit(0.0))),
        },
        {"row_count": F.count(F.lit(1))},
    )
    unique = P.unique_counts(df)
    entry = F.struct("rank", "value", "frequency")
    top = P.top_values(df, sorted(texts), k).groupBy("column_name").agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),  # k entries per column
            lambda e: F.struct(e["value"].alias("value"), e["frequency"].alias("frequency")),
        ).alias("top")
    )
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    report = facts.join(unique, "column_name", "left").join(top, "column_name", "left")
    if numbers:
        report = report.join(P.exact_medians(df, sorted(numbers)), "column_name", "left")
    else:
        report = report.withColumn("median_val", F.lit(None).cast("double"))
    percentage = F.when(F.col("row_count") == 0, 0.0).otherwise(
        F.round(F.col("null_count") * 100.0 / F.col("row_count"), 2)
    )
    is_text = F.col("column_name").isin(*texts) if texts else F.lit(False)
    return report.select(
        "position",
        "column_name",
        F.element_at(kinds, F.col("column_name")).alias("dtype"),
        "row_count",
        "null_count",
        percentage.alias("null_percentage"),
        F.coalesce("unique_count", F.lit(0).cast("bigint")).alias("unique_count"),
        "min_val",
        "max_val",
        "mean_val",
        "median_val",
        "std_val",
        "avg_length",
        F.when(is_text, F.col("top")).alias("top_values"),
    ).orderBy("position")
