import pytest
from pyspark.sql import functions as F

from sluicegate.operators import reconcile, validate
from sluicegate.plans.validation import validate_table, validation_report


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(i, f"v{i}", i / 2) for i in range(100)], "k int, s string, x double")


def test_row_count(source):
    assert validate.check_row_count(source, 100).first().status == "Passed"
    assert validate.check_row_count(source, 99).first().status == "Failed"
    assert validate.check_row_count(source).first().status == "Info"
    assert validate.check_row_count(source.limit(0), 0).first().status == "Passed"


def test_duplicates_leave_the_surrogate_id_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, s string")
    assert rows(validate.duplicate_groups(df)) == [("a", 2)]
    assert tuple(validate.duplicate_total(df).first()) == (1, 2, 1, "Warning")
    assert validate.duplicate_total(df, ["id"]).first().status == "Passed"


def test_duplicate_groups_are_the_largest(spark):
    df = spark.range(300).select((F.col("id") % 25).alias("v")).unionAll(
        spark.range(5).select(F.lit(7).cast("bigint").alias("v"))
    )
    found = [tuple(r) for r in validate.duplicate_groups(df, ["v"]).collect()]
    assert found[0] == (7, 17) and len(found) == 10 and found[1] == (0, 12)


def test_compare_status(source):
    assert validate.compare_status(source, source).first().status == "Passed"
    assert validate.compare_status(source, source.limit(3)).first().status == "Warning"
    less = validate.compare_status(source, source.drop("x")).first()
    assert (less.status, less.missing_columns, less.rows_match) == ("Warning", 1, True)
    more = validate.compare_status(source, source.withColumn("id", F.lit(1))).first()
    assert more.status == "Passed"
    assert validate.compare_status(None, source).first().status == "Skipped"


def test_reconcile_equal_sides(source):
    assert rows(reconcile.reconcile_multiset(source, source.repartition(3))) == []
    counts = dict(rows(reconcile.reconcile_by_key(source, source, ["k"])))
    assert counts == {"same": 100, "changed": 0, "only_source": 0, "only_target": 0}


def test_reconcile_differences(spark, source):
    target = source.where("k <> 3").withColumn(
        "x", F.when(F.col("k") == 5, None).otherwise(F.col("x"))
    ).unionAll(spark.createDataFrame([(1000, "new", 0.0)], source.schema))
    counts = dict(rows(reconcile.reconcile_by_key(source, target, ["k"])))
    assert counts == {"same": 98, "changed": 1, "only_source": 1, "only_target": 1}
    assert rows(reconcile.reconcile_multiset(source, target)) == [
        (1000, "new", 0.0, 0, 1), (3, "v3", 1.5, 1, 0), (5, "v5", 2.5, 1, 0), (5, "v5", None, 0, 1)
    ]


def test_a_hot_key_does_not_multiply(spark, plan):
    hot = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("v"))
    counts = dict(rows(reconcile.reconcile_by_key(hot, hot, ["k"])))
    assert counts["same"] == 1
    fewer = dict(rows(reconcile.reconcile_by_key(hot, hot.limit(19_999), ["k"])))
    assert fewer["changed"] == 1
    text = plan(reconcile.reconcile_by_key(hot, hot, ["k"]))
    assert "Join" not in text


def test_reconcile_null_keys_and_copies(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "k int, v string")
    right = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    counts = dict(rows(reconcile.reconcile_by_key(left, right, ["k"])))
    assert counts == {"same": 1, "changed": 1, "only_source": 0, "only_target": 0}
    assert rows(reconcile.reconcile_multiset(left, right)) == [(1, "b", 1, 0)]


def test_sample_comparison(source):
    target = source.withColumn("s", F.when(F.col("k") == 2, "other").otherwise(F.col("s")))
    found = {r.column_name: r.match for r in reconcile.sample_comparison(source, target, ["k"]).collect()}
    assert found == {"k": True, "s": False, "x": True}
    shuffled = reconcile.sample_comparison(source.orderBy(F.desc("k")), source, ["k"])
    assert all(r.match for r in shuffled.collect())
    shorter = reconcile.sample_comparison(source, source.limit(2), ["k"]).collect()
    assert not any(r.match for r in shorter)


@pytest.mark.parametrize(
    "statuses, overall",
    [
        (["Passed", "Info"], "Passed"), (["Passed", "Warning", "Error", "Failed"], "Failed"),
        (["Warning", "Error"], "Error"), (["Info", "Warning", "Skipped"], "Warning"), (["Info"], "Passed"),
    ],
)
def test_overall_status(spark, statuses, overall):
    df = spark.createDataFrame([(s,) for s in statuses], "s string")
    assert df.agg(validate.overall_status(F.col("s"))).first()[0] == overall


def test_quality_gate(spark):
    df = spark.createDataFrame([(i, i if i else None, i != 7) for i in range(100)], "k int, v int, ok boolean")
    found = {r.rule: (r.value, r.status) for r in validate.quality_gate(
        df, F.col("ok"), required=["v"], unique_key=["k"]).collect()}
    assert found == {"success_rate": (99.0, "Passed"), "not_null": (1.0, "Failed"), "unique_key": (0.0, "Passed")}
    strict = validate.quality_gate(df, F.col("ok"), min_success_rate=99.5).first()
    assert strict.status == "Failed"


def test_report(source):
    report = validation_report(source, source, expected=100)
    found = {(r.test, r.metric): (r.status, r.value) for r in report.collect()}
    assert found[("overall", "overall")] == ("Passed", None)
    assert found[("column_stats", "x.max")] == ("Info", 49.5)
    assert found[("null_values", "s")] == ("Info", 0.0)
    failed = validation_report(source, source, expected=1).where("test = 'overall'").first()
    assert failed.status == "Failed"


def test_validate_table(spark, source, tmp_path):
    source.write.saveAsTable("checked_table")
    try:
        saved = str(tmp_path / "report")
        report = validate_table(spark, "checked_table", source, 100, save_to=saved)
        assert report.where("test = 'overall'").first().status == "Passed"
        assert spark.read.json(saved).count() == report.count()
        broken = source.withColumn("k", F.raise_error(F.lit("unreadable")).cast("int"))
        report = validate_table(spark, "checked_table", broken.distinct(), 100)
        found = {r.test: r.status for r in report.collect()}
        assert found["csv_comparison"] == "Error" and found["overall"] == "Error"
        assert found["row_count"] == "Passed"
    finally:
        spark.sql("DROP TABLE checked_table")


def test_validate_missing_table(spark):
    report = validate_table(spark, "no_such_table").collect()
    assert [(r.test, r.status) for r in report] == [("table_exists", "Failed"), ("overall", "Failed")]


def test_reconcile_does_not_hide_lost_columns(source):
    with pytest.raises(ValueError, match="only one side has x"):
        reconcile.reconcile_multiset(source, source.drop("x"))
    assert rows(reconcile.reconcile_multiset(source, source.drop("x"), ["k", "s"])) == []
