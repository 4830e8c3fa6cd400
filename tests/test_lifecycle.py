"""What a load leaves behind, tables that are replaced, ids in any case, incremental tables, full reports."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import tables
from sluicegate.operators.tables import add_surrogate_id, has_column, next_id, write_table
from sluicegate.plans.load import load_delimited
from sluicegate.plans.validation import validate_table, validation_report
from sluicegate.sources.delimited import Layout
from sluicegate.streaming import tables as incremental
from sluicegate.streaming.tables import load_incremental
from sluicegate.workspace import shared_folder, staged, stages_removed


@pytest.fixture
def name(spark):
    table = f"t_{uuid.uuid4().hex}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def left(spark):
    folder = os.path.join(shared_folder(spark).removeprefix("file:"), "sluicegate")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


# -- intermediate data ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "options",
    [
        {"layout": Layout(header_row=1), "columns": ["k", "v"]},
        {"id_column": "id", "id_order": ["k"], "unique_key": ["k"]},
        {"mixed": True, "id_column": "id"},
    ],
)
def test_a_load_leaves_nothing_behind(spark, write, tmp_path, name, options):
    top = "# above\n" if "layout" in options and options["layout"].header_row else ""
    write("in/a.csv", top + "k,v\n" + "".join(f"{i},x{i}\n" for i in range(50)))
    write("in/b.csv", top + "k,v\n50,yyy\n51,z,too,many\n")
    before = left(spark)
    load_delimited(spark, str(tmp_path / "in"), name, quarantine_path=str(tmp_path / "bad"), **options)
    assert left(spark) == before
    assert spark.table(name).count() == 51
    load_delimited(spark, str(tmp_path / "in"), name, if_exists="append", **options)
    assert left(spark) == before and spark.table(name).count() == 102
    if "id_column" in options:
        assert sorted(r.id for r in spark.table(name).select("id").collect()) == list(range(1, 103))


def test_a_load_that_fails_leaves_nothing_behind(spark, write, tmp_path, name):
    write("in/a.csv", "k,v\n1,a\n2,b,c\n")
    before = left(spark)
    with pytest.raises(Exception, match="bad line"):
        load_delimited(spark, str(tmp_path / "in"), name, on_bad_lines="error", id_column="id")
    assert left(spark) == before and not spark.catalog.tableExists(name)


def test_stages_of_nested_work(spark):
    before = left(spark)
    with stages_removed(spark):
        outer = staged(spark.range(3).toDF("x"), "outer")
        with stages_removed(spark):
            staged(spark.range(3).toDF("x"), "inner")
        assert outer.count() == 3
    assert left(spark) == before


# -- tables ---------------------------------------------------------------------------------


def test_ids_are_found_in_any_case(spark, write, tmp_path, name):
    write("in/a.csv", "ID,name\n7,a\n9,b\n")
    load_delimited(spark, str(tmp_path / "in"), name, id_column="id")
    assert sorted(r.ID for r in spark.table(name).collect()) == [7, 9]
    assert next_id(spark, name, "id") == 10
    df = spark.table(name)
    assert has_column(df, "Id") and add_surrogate_id(df, ["name"], "iD").columns == df.columns


def test_replace_puts_the_old_table_back(spark, name, monkeypatch):
    write_table(spark.range(3).toDF("x"), name)
    real = type(spark).sql

    def sql(self, text, *args, **more):
        if text.startswith(f"ALTER TABLE {name}_new_"):
            raise RuntimeError("the catalog is gone")
        return real(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError, match="catalog"):
        write_table(spark.range(5).toDF("x"), name, "replace")
    monkeypatch.undo()
    assert spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    write_table(spark.range(5).toDF("x"), name, "replace")
    assert spark.table(name).count() == 5
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]


def test_replace_in_place(spark, name, tmp_path, monkeypatch):
    path = str(tmp_path / "place")
    write_table(spark.range(3).toDF("x"), name, path=path)
    before = left(spark)
    write_table(spark.table(name).select((F.col("x") * 2).alias("x")), name, "replace", path)
    assert sorted(r.x for r in spark.table(name).collect()) == [0, 2, 4] and left(spark) == before
    broken = spark.table(name).select(F.raise_error(F.lit("no")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="no"):
        write_table(broken, name, "replace", path)
    assert spark.table(name).count() == 3 and left(spark) == before
    monkeypatch.setattr(tables, "_save", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(RuntimeError, match="not copied from"):
        write_table(spark.range(9).toDF("x"), name, "replace", path)
    assert len(left(spark) - before) == 1  # the rows are still there


# -- incremental tables ---------------------------------------------------------------------


@pytest.fixture
def coming(write):
    def come(first: int, last: int):
        for i in range(first, last):
            write(f"coming/f{i:02d}.csv", "k;day\n" + "".join(f"{i * 10 + j};0{j + 1}/0{j + 2}/2024\n" for j in range(3)) + "x;y;z\n")

    return come


def run(spark, tmp_path, name, **options):
    load_incremental(
        spark, str(tmp_path / "coming"), name, str(tmp_path / "state"), id_column="id", files_per_batch=2,
        quarantine_path=str(tmp_path / "bad"), **options,
    ).awaitTermination()


def test_incremental_table(spark, coming, tmp_path, name):
    coming(0, 5)
    before = left(spark)
    run(spark, tmp_path, name)
    assert spark.table(name).columns == ["id", "k", "day", "load_batch"]
    coming(5, 8)
    run(spark, tmp_path, name)
    run(spark, tmp_path, name)  # nothing new
    rows = sorted(spark.table(name).collect())
    assert [r.id for r in rows] == list(range(1, 25))
    assert sorted(r.k for r in rows) == [i * 10 + j for i in range(8) for j in range(3)]
    assert [r.k for r in rows if r.load_batch == 0][:3] in ([i * 10, i * 10 + 1, i * 10 + 2] for i in range(5))
    assert {t: n for n, t in spark.table(name).dtypes}["date"] == "day"
    assert len({r.load_batch for r in rows}) >= 4
    assert spark.read.json(str(tmp_path / "bad")).count() == 8
    assert left(spark) == before


@pytest.mark.parametrize("where", ["before the table", "after the table", "after the count"])
def test_a_killed_run_is_resumed(spark, coming, tmp_path, name, monkeypatch, where):
    coming(0, 6)
    real, seen = incremental.stages_removed, []

    class Dies:
        """The batch dies at one of three places on its second turn."""

        def __init__(self, session):
            self.inner = real(session)

        def __enter__(self):
            self.inner.__enter__()
            seen.append(1)
            if len(seen) == 2 and where == "before the table":
                raise RuntimeError("killed")

        def __exit__(self, *error):
            self.inner.__exit__(*error)
            if len(seen) == 2 and where == "after the count":
                raise RuntimeError("killed")

    monkeypatch.setattr(incremental, "stages_removed", Dies)
    if where == "after the table":
        quarantine = incremental.quarantine_rows

        def dies(*args):
            if len(seen) == 2:
                raise RuntimeError("killed")
            return quarantine(*args)

        monkeypatch.setattr(incremental, "quarantine_rows", dies)
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path, name)
    monkeypatch.undo()
    run(spark, tmp_path, name)
    rows = spark.table(name).collect()
    assert sorted(r.id for r in rows) == list(range(1, 19))
    assert sorted(r.k for r in rows) == [i * 10 + j for i in range(6) for j in range(3)]


def test_incremental_keeps_its_first_plan(spark, write, tmp_path, name):
    write("coming/a.csv", "k;v\n1;10\n")
    run(spark, tmp_path, name)
    write("coming/b.csv", "k;v\n2;no number\n3;30\n")
    run(spark, tmp_path, name)
    assert sorted((r.k, r.v) for r in spark.table(name).collect()) == [(1, 10), (3, 30)]
    bad = spark.read.json(str(tmp_path / "bad")).collect()
    assert [(r.k, r.v, r.error_type) for r in bad] == [("2", "no number", "cast_error")]


def test_incremental_refuses_another_table(spark, write, tmp_path, name):
    write("coming/a.csv", "k;v\n1;10\n")
    spark.range(1).write.saveAsTable(name)
    with pytest.raises(ValueError, match="not loaded in batches"):
        run(spark, tmp_path, name)


# -- reports --------------------------------------------------------------------------------


@pytest.fixture
def loaded(spark, name):
    rows = [(i, f"n{i}", i / 2) for i in range(20)] + [(3, "n3", 1.5)] * 2
    spark.createDataFrame(rows, "k int, s string, extra double").write.saveAsTable(name)
    source = spark.createDataFrame([(i, f"n{i}" if i else "other", None) for i in range(20)], "K int, s string, lost string")
    return source


def test_full_report(spark, loaded, name):
    report = validate_table(spark, name, loaded, duplicate_columns=["k"], order_by=["k"]).collect()
    by = {(r.test, r.metric): r for r in report}
    assert [json.loads(by["sample_data", f"row {i}"].detail)["k"] for i in range(1, 6)] == [0, 1, 2, 3, 3]
    assert by["duplicates", "extra_rows"].value == 2
    assert (by["duplicates", "group 1"].value, json.loads(by["duplicates", "group 1"].detail)) == (3, {"k": 3})
    assert by["csv_comparison", "source_rows"].status == "Warning" and by["csv_comparison", "table_rows"].value == 22
    assert by["csv_comparison", "lost"].message == "column missing in the table"
    assert by["csv_comparison", "extra"].message == "column not in the source"
    assert by["csv_comparison", "K.first"].value == 0 and by["csv_comparison", "s.first"].value == 0
    assert json.loads(by["csv_comparison", "s.first"].detail)["source"][0] == "other"
    assert by["overall", "overall"].status == "Warning"
    lazy = validation_report(spark.table(name), loaded, duplicate_columns=["k"], order_by=["k"]).collect()
    assert sorted(map(tuple, lazy), key=repr) == sorted(map(tuple, report), key=repr)


def test_checks_break_apart(spark, loaded, name):
    spark.sql(f"CREATE OR REPLACE TEMP VIEW broken_view AS SELECT k, s, CAST(raise_error('x') AS DOUBLE) AS extra FROM {name}")
    found = {(r.test, r.metric): r.status for r in validate_table(spark, "broken_view", loaded, 22, ["k"], None, ["k"]).collect()}
    assert found["row_count", "actual_count"] == "Passed" and found["duplicates", "extra_rows"] == "Warning"
    assert {t for (t, _), s in found.items() if s == "Error"} >= {"null_values", "column_stats", "sample_data", "overall"}
    assert found["csv_comparison", "s.first"] == "Info"
