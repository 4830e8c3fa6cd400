import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import cast, infer

CASES = {
    # name: (values, sql type, spark type, semantic type)
    "flag": (["true", "False", "TRUE"], "BOOLEAN", "boolean", None),
    "small": (["1", "-2147483648", "2147483647"], "INT", "int", None),
    "wide": (["1", "2147483648", None], "BIGINT", "bigint", None),
    "huge": (["1", "18446744073709551615", "0"], "BIGINT UNSIGNED", "decimal(20,0)", None),
    "ratio": (["1", "2.5", "-1e3"], "DOUBLE", "double", None),
    "iso": (["2024-01-31", "2023-12-01", "NA"], "DATE", "date", "date"),
    "day_first": (["31/01/2024", "01/02/2024", ""], "DATE", "date", "date"),
    "month_first": (["01/31/2024", "02/01/2024", ""], "DATE", "date", "date"),
    "dashed": (["31-01-2024", "01-02-2024", "02-02-2024"], "DATE", "date", "date"),
    "dotted": (["31.01.2024", "2024-02-01", "01.01.2024"], "DATE", "date", "date"),
    "moment": (["2024-01-31 10:20:30", "2024-01-31T10:20", "2024-02-01"], "DATETIME",
               "timestamp_ntz", "date"),
    "clock": (["10:20:30", "23:59:59", "00:00"], "TIME", "time", "time"),
    "email": (["a@b.co", "x.y+z@mail.example.org", None], "VARCHAR(100)", "string", "email"),
    "phone": (["+84 123-456", "(024) 555 777", "555-1234"], "VARCHAR(20)", "string", "phone"),
    "empty": ([None, "", "N/A"], "TEXT", "string", None),
    "not_date": (["2024-13-45", "2024-01-01", "2024-01-01"], "VARCHAR(20)", "string", "date"),
    "bad_clock": (["25:99", "10:20", "10:21"], "VARCHAR(10)", "string", "time"),
    "suffix": (["12d", "1", "2"], "VARCHAR(10)", "string", None),
    "v10": (["a" * 10, "b", "c"], "VARCHAR(10)", "string", None),
    "v50": (["a" * 11, "b", "c"], "VARCHAR(50)", "string", None),
    "v100": (["a" * 51, "b", "c"], "VARCHAR(100)", "string", None),
    "v255": (["a" * 101, "b", "c"], "VARCHAR(255)", "string", None),
    "text": (["a" * 256, "b", "c"], "TEXT", "string", None),
    "edge_text": (["a" * 1000, "b", "c"], "TEXT", "string", None),
    "long": (["a" * 1001, "b", "c"], "LONGTEXT", "string", None),
}


@pytest.fixture(scope="module")
def typed(spark):
    names = list(CASES)
    rows = list(zip(*[CASES[n][0] for n in names]))
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_types(typed):
    report = {r.column_name: r for r in infer.schema_report(typed).collect()}
    found = {n: (r.sql_type, r.spark_type, r.semantic_type) for n, r in report.items()}
    assert found == {n: tuple(c[1:]) for n, c in CASES.items()}
    assert [r.position for r in sorted(report.values(), key=lambda r: r.position)] == list(
        range(1, len(CASES) + 1)
    )
    assert report["month_first"].day_first is False
    assert report["day_first"].day_first is True
    assert {n for n, r in report.items() if r.nullable} == {
        "wide", "iso", "day_first", "month_first", "email", "empty"
    }


def test_an_inferred_type_takes_every_value(typed):
    report = infer.schema_report(typed).collect()
    types = {r.column_name: r.spark_type for r in report}
    order = {r.column_name: r.day_first for r in report}
    assert cast.classify(typed, types, day_first=order).where("error_type is not null").count() == 0


def test_one_odd_value_anywhere_decides(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") == 19_999, "x").otherwise(F.col("id").cast("string")).alias("c")
    )
    assert infer.infer_column_types(df).first().sql_type == "VARCHAR(10)"


def test_result_does_not_depend_on_partitions(typed):
    one = sorted(infer.infer_column_types(typed.repartition(1)).collect())
    many = sorted(infer.infer_column_types(typed.repartition(7)).collect())
    assert one == many


def test_override_and_key(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "a string, b string")
    report = infer.schema_report(df, overrides={"a": "DOUBLE"}, key="a").collect()
    assert [(r.column_name, r.sql_type, r.nullable, r.is_key) for r in report] == [
        ("a", "DOUBLE", False, True), ("b", "VARCHAR(10)", True, False),
    ]
    with_id = infer.schema_report(df, key="id").orderBy("position").collect()
    assert [(r.position, r.column_name, r.is_key) for r in with_id][0] == (0, "id", True)


@pytest.mark.parametrize(
    "values, likely",
    [
        (["2024-01-01"] * 8 + ["x", "y"], True),
        (["2024-01-01"] * 7 + ["x", "y", "z"], False),
        (["01/02/24"] * 3, True),
        (["2024/01/01 then more"] * 3, True),
        (["2024-01-01"] * 4 + ["01/01/2024"] * 4 + ["x"], False),
        (["10:20", "11:30"], True),
        ([None, ""], False),
        (["abc"], False),
    ],
)
def test_likely_datetime(spark, values, likely):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert infer.likely_datetime(df).first().likely_datetime is likely


@pytest.mark.parametrize(
    "values, likely",
    [
        (["1,234", "5 678.9", "-1"], True), (["1", "2", "x"], False), ([None], False),
        (["1e5", ".5", "3."], True), (["12d"], False),
    ],
)
def test_likely_numeric(spark, values, likely):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert infer.likely_numeric(df).first().likely_numeric is likely


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("18446744073709551615", "decimal(20,0)", Decimal("18446744073709551615")),
        ("300", "tinyint", None),
        ("9223372036854775808", "bigint", None),
        ("1.5", "int", None),
        ("12d", "double", None),
        ("2.50", "double", 2.5),
        ("29/02/2023", "date", None),
        ("29/02/2024", "date", dt.date(2024, 2, 29)),
        ("2024-02-29x", "date", None),
        ("29.02.2024 10:11", "timestamp_ntz", dt.datetime(2024, 2, 29, 10, 11)),
        ("10:20", "time", "10:20:00"),
        ("24:00:00", "time", None),
        ("yes", "boolean", None),
        ("NULL", "string", None),
    ],
)
def test_convert(spark, text, kind, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert cast.typed_cast(df, {"c": kind}).first().c == value


TYPES = {"id": "bigint", "name": "string", "amount": "double"}


@pytest.fixture
def messy(spark):
    rows = [
        ("1", "a", "1.5", None), ("1", "a", "2.5", None), ("2", None, "x", None),
        ("z", "b", "y", None), ("3", "NA", "", None), ("4", "c", "4", "4,c,4,more"), ("1", "d", "3", None),
    ]
    return spark.createDataFrame(rows, f"id string, name string, amount string, {cast.BAD_LINE} string")


def test_good_and_bad_are_all_rows(messy):
    classified = cast.classify(messy, TYPES, required=["name"])
    good = cast.good_rows(classified, list(TYPES))
    bad = cast.quarantine_rows(classified, list(TYPES))
    assert good.count() + bad.count() == messy.count()
    assert dict(good.dtypes) == {"id": "bigint", "name": "string", "amount": "double"}
    assert bad.columns[-4:] == ["error_type", "error_message", "error_timestamp", "source_file"]
    assert {tuple(r) for r in cast.error_stats(classified).collect()} == {
        ("malformed_row", 1), ("cast_error", 2), ("null_violation", 1),
    }
    messages = {r.id: r.error_message for r in bad.collect()}
    assert messages["2"] == "amount: cannot read 'x' as double"
    assert messages["z"] == "id: cannot read 'z' as bigint"
    assert messages["4"] == "too many fields: 4,c,4,more"


def test_duplicate_keys(messy):
    numbered = messy.coalesce(1).withColumn("row_no", F.monotonically_increasing_id())
    classified = cast.classify(numbered, TYPES)
    marked = cast.mark_duplicate_keys(classified, ["id"], "row_no")
    assert marked.count() == messy.count()
    later = marked.where("error_type = 'duplicate_key'").collect()
    assert sorted(r.amount for r in later) == ["2.5", "3"]


def test_unique_keys_are_compared_as_they_load(spark):
    rows = spark.createDataFrame([("1", 0), ("01", 1), ("2", 2), (None, 3), (None, 4)], "id string, row_no long")
    classified = cast.classify(rows, {"id": "bigint"})
    marked = cast.mark_duplicate_keys(classified, ["id"], "row_no")
    assert marked.columns == classified.columns
    assert [r.row_no for r in marked.where("error_type IS NOT NULL").collect()] == [1]


def test_override_types(spark):
    df = spark.createDataFrame([("1", "2", "3", "4", "x")], "a string, b string, c string, d string, e string")
    given = {"a": "decimal(12, 2)", "b": "SMALLINT", "c": "double", "d": "bigint", "e": "varchar(30)"}
    found = {r.column_name: r.spark_type for r in infer.schema_report(df, overrides=given).collect()}
    assert found == {"a": "decimal(12,2)", "b": "smallint", "c": "double", "d": "bigint", "e": "string"}
    with pytest.raises(ValueError, match="unknown type"):
        infer.schema_report(df, overrides={"a": "MONEY"})
    with pytest.raises(ValueError, match="no column"):
        infer.schema_report(df, overrides={"z": "INT"})


def test_load_stats(spark, messy):
    row = cast.load_stats(cast.classify(messy, TYPES)).first()
    assert tuple(row) == (7, 4, 3, "57.14%", "Completed with errors")
    none = cast.load_stats(cast.classify(messy.limit(0), TYPES)).first()
    assert tuple(none) == (0, 0, 0, "0.00%", "Completed")


def test_a_filter_on_errors_does_not_convert_again(messy, plan):
    bad = cast.error_stats(cast.classify(messy, TYPES))
    assert plan(bad).count("try_cast(amount") <= 1
