import statistics

import pytest
from pyspark.sql import functions as F

from sluicegate.functions.rows import grouping_keys
from sluicegate.functions.sizes import size_text
from sluicegate.operators import profile
from sluicegate.plans.profile import column_profile
from sluicegate.sources.delimited import Layout

NAN = float("nan")


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [(1, 1.5, "a", True), (2, NAN, "bb", True), (2, None, None, None), (5, -2.5, "bb", False)],
        "n int, x double, s string, b boolean",
    )


def as_dict(df, key="column_name"):
    return {r[key]: r for r in df.collect()}


def test_column_stats(small):
    stats = as_dict(profile.column_stats(small))
    assert set(stats) == {"n", "x"}
    assert tuple(stats["n"])[1:] == (1.0, 5.0, 2.5, 10.0, 4, 4)
    assert tuple(stats["x"])[1:] == (-2.5, 1.5, -0.5, -1.0, 4, 2)


def test_sums_do_not_overflow(spark):
    df = spark.range(4).select(F.lit(2**62).alias("n"))
    assert profile.column_stats(df).first().sum_val == float(2**64)


def test_nothing_to_profile(spark):
    texts = spark.createDataFrame([("a",)], "s string")
    assert profile.column_stats(texts).count() == 0
    assert profile.numeric_summary(texts).count() == 0
    numbers = spark.range(0)
    assert tuple(profile.column_stats(numbers).first())[1:] == (None, None, None, None, 0, 0)
    assert tuple(profile.numeric_summary(numbers).first())[1:] == (None,) * 8
    assert profile.null_counts(numbers).first().null_percentage == 0.0
    assert tuple(profile.table_summary(numbers).first()) == (0, 1, 0, 0)
    assert tuple(profile.data_size(numbers).first()) == (0, "0 B")


def test_null_counts_count_nan(small):
    counts = as_dict(profile.null_counts(small))
    assert {c: (r.null_count, r.null_percentage) for c, r in counts.items()} == {
        "n": (0, 0.0), "x": (2, 50.0), "s": (1, 25.0), "b": (1, 25.0)
    }


def test_unique_counts(small):
    exact = {c: r.unique_count for c, r in as_dict(profile.unique_counts(small)).items()}
    assert exact == {"n": 3, "x": 2, "s": 2, "b": 2}
    near = as_dict(profile.unique_counts(small, approximate=True))
    assert near["n"].unique_count == 3


def test_unique_counts_of_long_texts_and_empty_columns(spark):
    df = spark.range(100).select(
        F.concat(F.repeat(F.lit("x"), 500), (F.col("id") % 7).cast("string")).alias("text"),
        F.lit(None).cast("string").alias("nothing"),
    )
    counts = {c: r.unique_count for c, r in as_dict(profile.unique_counts(df)).items()}
    assert counts == {"text": 7, "nothing": 0}


def test_top_values_break_ties_by_value(spark, plan):
    df = spark.createDataFrame([(v,) for v in "ccbbaadeff"], "s string")
    top = profile.top_values(df, k=3)
    assert [(r.value, r.frequency) for r in top.orderBy("rank").collect()] == [
        ("a", 2), ("b", 2), ("c", 2)
    ]
    assert "WindowGroupLimit" in plan(top)


@pytest.mark.parametrize("limit", [10, 100, 10_000_000])
def test_exact_medians(spark, limit):
    odd = [((i * 7919) % 1009) / 4 for i in range(2001)]
    hot = [3.0] * 1500 + [float(i) for i in range(501)]
    even = [float(i % 97) for i in range(2000)] + [None]
    df = spark.createDataFrame(list(zip(odd, hot, even)), "odd double, hot double, even double")
    found = {c: r.median_val for c, r in as_dict(
        profile.exact_medians(df.repartition(5), ["odd", "hot", "even"], group_limit=limit)).items()}
    assert found == {
        "odd": statistics.median(odd),
        "hot": statistics.median(hot),
        "even": statistics.median([v for v in even if v is not None]),
    }


def test_median_between_two_far_values(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") < 10_000, 0.0).otherwise(1000.0).alias("v"), F.rand(3).alias("r")
    )
    found = as_dict(profile.exact_medians(df, ["v", "r"], group_limit=50))
    assert found["v"].median_val == 500.0
    ordered = sorted(r.r for r in df.select("r").collect())
    assert found["r"].median_val == pytest.approx((ordered[9999] + ordered[10_000]) / 2, abs=0)


def test_string_lengths(small):
    row = profile.string_lengths(small).first()
    assert row.avg_length == pytest.approx(5 / 3)
    assert row.max_length == 2


def test_table_summary(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None), ("b", None)], "s string, n int")
    assert tuple(profile.table_summary(df).first()) == (5, 2, 2, 3)


def test_row_digests_tell_rows_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc"), ("abc", None), ("-", "abc")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(*grouping_keys(df, ["x", "y"])).distinct().count() == len(rows)
    zeros = spark.createDataFrame([(0.0, "z"), (-0.0, "z")], "x double, y string")
    assert zeros.select(*grouping_keys(zeros, ["x", "y"])).distinct().count() == 1


def test_duplicates_of_wide_rows_shuffle_digests(spark, plan):
    df = spark.createDataFrame([("long text", "b")] * 3, "text string, y string")
    counted = profile.duplicate_row_count(df)
    assert tuple(counted.first()) == (1, 3, 2)
    exchange = [line for line in plan(counted).splitlines() if "Exchange hashpartitioning" in line]
    assert exchange and "text" not in exchange[0]


@pytest.mark.parametrize(
    "size, text",
    [(0, "0 B"), (1023, "1023 B"), (1024, "1.00 KB"), (1536, "1.50 KB"), (1048576, "1.00 MB"),
     (5 * 1024**3 // 2, "2.50 GB"), (3 * 1024**4, "3072.00 GB")],
)
def test_size_text(spark, size, text):
    assert spark.range(1).select(size_text(F.lit(size).cast("bigint"))).first()[0] == text


def test_column_profile(small):
    rows = as_dict(column_profile(small))
    assert list(rows) == ["n", "x", "s", "b"]
    assert rows["s"].top_values[0].value == "bb" and rows["s"].top_values[0].frequency == 2
    assert rows["n"].median_val == 2.0 and rows["s"].median_val is None
    assert rows["x"].dtype == "double"


def test_statistics_take_one_scan(small, plan):
    assert plan(profile.column_stats(small)).count("ExistingRDD") == 1
    assert plan(profile.null_counts(small)).count("ExistingRDD") == 1


def test_result_does_not_depend_on_partitions(small):
    one = sorted(map(str, profile.unique_counts(small.repartition(1)).collect()))
    many = sorted(map(str, profile.unique_counts(small.repartition(6)).collect()))
    assert one == many


def test_wide_tables_are_profiled_in_column_groups(spark, plan):
    df = spark.range(3).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(150)])
    rows = as_dict(profile.null_counts(df))
    assert len(rows) == 150 and rows["c149"].position == 150
    assert as_dict(profile.column_stats(df))["c100"].max_val == 102.0


def test_column_profile_parses_its_lines_once(spark, plan):
    from sluicegate.sources.delimited import parse_lines

    lines = spark.createDataFrame([("1;a",), ("2;b",), ("3;b",)], "line string")
    rows = parse_lines(lines, "line", ["k", "v"], Layout(sep=";", header=False)).drop("_bad_line")
    report = column_profile(rows.withColumn("k", rows["k"].cast("int")))
    assert "from_csv" not in plan(report)
    assert {r.column_name: r.unique_count for r in report.collect()} == {"k": 3, "v": 2}
