import re

import pytest
from pyspark.sql import functions as F

from sluicegate.functions import names as N

NAMES = [
    "plain", "two words", "a--b", "2nd", "Tên khách", "", "  pad ", "x.y/z", "__init__",
    "UPPER Case", "café\tcrème", "9", "ö1", "a  b", "名前", "ét", "-", "_",
]


def expected_sanitized(name):
    word = re.sub(r"_+", "_", re.sub(r"\W", "_", name))
    return "col_" + word if word[:1].isdigit() else word


def expected_normalized(name):
    if name is None:
        return "unnamed_column"
    word = re.sub(r"\s+", "_", re.sub(r"[^\w\s]", "_", name))
    if word and not re.match(r"[a-zA-Z_]", word):
        word = "col_" + word
    return word.lower()


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(n,) for n in [*NAMES, None]], "name string")


def test_sanitize(frame):
    rows = frame.where("name is not null").select("name", N.sanitize_name(F.col("name")).alias("out"))
    assert {r.name: r.out for r in rows.collect()} == {n: expected_sanitized(n) for n in NAMES}


def test_normalize(frame):
    rows = frame.select("name", N.normalize_name(F.col("name")).alias("out")).collect()
    assert {r.name: r.out for r in rows} == {n: expected_normalized(n) for n in [*NAMES, None]}


@pytest.mark.parametrize(
    "path, table",
    [
        ("file:/data/Sales Data-2024.csv", "sales_data_2024"),
        ("/a/b/plain", "plain"),
        ("s3://bucket/x/archive.v2.CSV", "archive.v2"),
    ],
)
def test_table_name(spark, path, table):
    row = spark.createDataFrame([(path,)], "p string").select(N.table_name_from_path(F.col("p"))).first()
    assert row[0] == table
