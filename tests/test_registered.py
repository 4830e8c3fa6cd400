"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from check_queries import _rows
from workload.oracle import ORACLE_SQL as ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, sql, name):
    got = QUERIES[name](spark, sf_dir)
    mine = _rows(got.columns, [tuple(r) for r in got.collect()])
    result = sql.execute(ORACLE[name])
    assert mine == _rows([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    found = {(r.section, r.subject): r.value for r in contract.entry(spark).collect()}
    assert found[("load", "total_rows")] == found[("load", "successful_rows")] + found[("load", "failed_rows")]

def test_every_note_of_the_mixed_files_holds_separators(spark, sf_dir):
    rows = QUERIES["load_mixed_files"](spark, sf_dir)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    held = rows.where(F.col("note").rlike("^café, [a-z]+; visit[|]call$")).count()
    assert held == customers > 0
