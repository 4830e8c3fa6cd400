"""Exact medians by prefixes, frequent values by a sketch, balances by digest."""

import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import profile, reconcile, validate


def medians(spark, values, kind, limit=profile.MEDIAN_GROUP_LIMIT):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    return profile.number_facts(df, ["v"], limit)["v"]


INF = float("inf")


@pytest.mark.parametrize("limit", [0, 1_000_000])
@pytest.mark.parametrize(
    "kind, values",
    [
        ("bigint", [2**62 + i for i in range(11)]),
        ("bigint", [-(2**63), 2**63 - 1, 0, 1]),
        ("bigint", [2**53, 2**53 + 1, 2**53 + 3, 2**53 + 2]),
        ("tinyint", [-128, 127, 0]),
        ("double", [-1.5, 0.0, -0.0, 2.5, 1e300, -1e-300]),
        ("double", [5e-324, 1.0, math.nextafter(1.0, 2), -5e-324]),
        ("double", [-INF, INF, 3.0]),
        ("float", [1.5, 2.25, -8.0]),
        ("decimal(18,4)", [Decimal("1.0001"), Decimal("-99999999999999.9999"), Decimal("2.5000")]),
        ("decimal(38,2)", [Decimal(10**30 + i) / 100 for i in range(9)]),
        ("decimal(38,2)", [Decimal(-(10**30) - i) / 100 for i in range(8)] + [Decimal(5), Decimal("-0.01")]),
        ("int", [7]),
        ("int", [7] * 5 + [8]),
    ],
)
def test_exact_medians(spark, kind, values, limit):
    found = medians(spark, values, kind, limit)
    want = statistics.median(values)
    exact = [Decimal(v) for v in values] if profile.is_exact(spark.createDataFrame([], f"v {kind}").schema["v"].dataType) else values
    if isinstance(exact[0], Decimal):
        ordered = sorted(exact)
        want = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
    assert found["median"] == want
    assert (found["low"], found["high"], found["n"]) == (min(exact), max(exact), len(values))


def test_medians_of_random_columns(spark):
    rng = random.Random(3)
    rows = [
        (rng.gauss(0, 1e5), rng.randrange(-50, 50), rng.choice([None, rng.random()]), rng.choice([float("nan"), 1.0, 2.0]))
        for _ in range(4001)
    ]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double")
    for limit in (50, 1_000_000):
        facts = profile.number_facts(df, df.columns, limit)
        for i, c in enumerate(df.columns):
            values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
            assert facts[c]["median"] == statistics.median(values), c
            assert math.isclose(facts[c]["mean"], statistics.fmean(values))
            assert math.isclose(facts[c]["deviation"], statistics.stdev(values))


def test_medians_take_three_scans(spark, monkeypatch):
    scans = []
    whole = profile._key_groups
    monkeypatch.setattr(profile, "_key_groups", lambda *a: scans.append(a[4]) or whole(*a))
    df = spark.range(5000).select(F.rand(1).alias("x"), (F.col("id") % 3).alias("y"), F.lit(2**60).alias("z"))
    profile.number_facts(df, df.columns, group_limit=0)
    assert scans == [profile.FIRST_BITS, profile.SECOND_BITS, 64]
    scans.clear()
    profile.number_facts(df, df.columns)
    assert len(scans) == 2


def test_numeric_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b double, c decimal(30,2), t string")
    assert {r.column_name: r.median_val for r in profile.numeric_summary(empty).collect()} == {"a": None, "b": None, "c": None}
    missing = spark.createDataFrame([(None, float("nan"))], "a int, b double")
    assert {tuple(r)[1:] for r in profile.numeric_summary(missing).collect()} == {(None,) * 8}
    assert profile.numeric_summary(empty.select("t")).collect() == []


def test_numeric_summary_keeps_whole_numbers(spark):
    df = spark.createDataFrame([(2**63 - 1, Decimal("0.10")), (2**63 - 3, Decimal("0.15"))], "a bigint, b decimal(10,2)")
    found = {r.column_name: r for r in profile.numeric_summary(df).collect()}
    assert (found["a"].min_exact, found["a"].median_exact) == (str(2**63 - 3), str(2**63 - 2))
    assert (found["b"].max_exact, found["b"].median_exact) == ("0.15", "0.125")


# -- frequent values ------------------------------------------------------------------------


def brute_top(rows, k=5):
    out = []
    for i, name in enumerate("abc"):
        counts = {}
        for r in rows:
            if r[i] is not None:
                counts[r[i]] = counts.get(r[i], 0) + 1
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]
        out += [(name, v, n, place) for place, (v, n) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("buckets", [1, 2, 16, 1 << 16])
def test_top_values(spark, monkeypatch, buckets):
    monkeypatch.setattr(profile, "VALUE_BUCKETS", buckets)
    rng = random.Random(buckets)
    long = "the same beginning of a long text "
    rows = [
        (rng.choice("abcdefgé"), f"u{i:04d}", rng.choice([None, "", long + str(rng.randrange(40)), "z" * (i % 7)]))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string").repartition(4)
    assert sorted(map(tuple, profile.top_values(df).collect())) == brute_top(rows)


def test_top_values_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert profile.top_values(df).collect() == []
    assert profile.top_values(df.select("b")).collect() == []


def test_top_values_move_less_than_a_digest_per_value(spark):
    """Texts are all different but a few: what the exact count sees is a small part of them."""
    df = spark.range(20_000).select(F.concat(F.lit("text "), F.when(F.col("id") % 40 == 0, F.col("id") % 200).otherwise(F.col("id"))).alias("t"))
    rows = profile._digested(df, ["t"])
    sketch = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    assert profile.top_values(df).where("frequency >= 100").count() == 5
    assert sketch.where("n >= 100").count() <= 5


# -- balances -------------------------------------------------------------------------------


def test_reconcile_compares_in_common_types(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", -0.0), (2, "b", -0.0)], "k int, s string, x double")
    right = spark.createDataFrame([(1, "a", 1), (2, "b", 0)], "k bigint, s string, x int")
    found = reconcile.reconcile_multiset(left, right).collect()
    assert [tuple(r) for r in found] == [(2, "b", 0.0, 1, 0)]


def test_reconcile_moves_digests_first(spark, plan):
    left = spark.createDataFrame([(1, "a" * 100, {"m": 1})], "k int, t string, m map<string,int>")
    text = plan(reconcile.reconcile_multiset(left, left.limit(0)), "formatted")
    assert "hashpartitioning(_digest" in text and "hashpartitioning(k" not in text
    assert reconcile.reconcile_multiset(left, left.limit(0)).count() == 1
    assert reconcile.reconcile_multiset(left, left).count() == 0


def test_duplicate_groups_of_wide_rows(spark):
    rows = [("x" * 50, i % 3, None) for i in range(9)] + [("y", 1, "q")] * 2 + [("z", 1, None)]
    df = spark.createDataFrame(rows, "t string, k int, u string")
    found = [tuple(r) for r in validate.duplicate_groups(df).collect()]
    assert found == [("x" * 50, 0, None, 3), ("x" * 50, 1, None, 3), ("x" * 50, 2, None, 3), ("y", 1, "q", 2)]
    assert [r.copies for r in validate.duplicate_groups(df, limit=2).collect()] == [3, 3]
    assert validate.duplicate_groups(df.limit(0)).collect() == []
    assert [tuple(r) for r in validate.duplicate_groups(df, ["k"]).collect()] == [(1, 6), (0, 3), (2, 3)]


def test_table_summary(spark, plan):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, float("nan"))], "k int, s string, x double")
    assert tuple(profile.table_summary(df).first()) == (3, 3, 1, 4)
    assert tuple(profile.table_summary(df.limit(0)).first()) == (0, 3, 0, 0)
    assert plan(profile.table_summary(df)).count("Scan") <= 2


def test_whole_numbers_have_few_counters_in_a_scan(spark, monkeypatch):
    """As many different numbers as rows: their median is found by 2**16 buckets, not by a counter each."""
    groups = []
    whole = profile._key_groups
    monkeypatch.setattr(profile, "_key_groups", lambda *a: groups.append(whole(*a)) or groups[-1])
    facts = profile.number_facts(spark.range(-100_000, 500_000), ["id"])
    assert (facts["id"]["median"], facts["id"]["n"]) == (199_999.5, 600_000)
    assert len(groups) == 3
    assert max(g.count() for g in groups[1:]) <= 2 * profile.KEY_BUCKETS
