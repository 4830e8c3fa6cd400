import pytest

from sluicegate.plans.analyze import analyze_files, detect_layout, layouts
from sluicegate.plans.load import load_delimited
from sluicegate.sources.dialect import dialect_report
from sluicegate.streaming.tables import load_incremental

SEMI = "Order No;Unit price;2nd;unit-price;\n" + "".join(
    f"{i};{i / 4};x{i};y;z{i}\n" for i in range(1, 40)
)


def test_layout_and_safe_names(spark, write):
    layout, names = detect_layout(spark, write("in/a.csv", SEMI, "iso-8859-1"))
    assert (layout.sep, layout.header) == (";", True)
    assert names == ["Order_No", "Unit_price", "col_2nd", "unit_price_2", "unnamed_column"]


def test_mixed_files_are_refused(spark, write, tmp_path):
    write("in/a.csv", "id,name\n1,a\n2,bb\n")
    write("in/b.csv", "id;name\n1;a\n2;bb\n")
    with pytest.raises(ValueError, match="one layout"):
        detect_layout(spark, str(tmp_path / "in"))
    found = layouts(dialect_report(spark, str(tmp_path / "in"))).collect()
    assert sorted(r.delimiter for r in found) == [",", ";"]


def test_analyze(spark, write):
    path = write("in/a.csv", "id|name|paid\n" + "".join(f"{i}|n{i}|true\n" for i in range(10, 30)))
    report = {r.column_name: r for r in analyze_files(spark, path).collect()}
    assert {n: r.sql_type for n, r in report.items()} == {
        "id": "INT", "name": "VARCHAR(10)", "paid": "BOOLEAN"
    }
    assert report["id"].delimiter == "|"


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1", "utf-16-le", "utf-16", "utf-8-sig"])
def test_load_detects_everything(spark, write, encoding):
    content = "id;prénom;when\n" + "".join(f"{i};é{i};2024-01-{i:02d}\n" for i in range(1, 29))
    path = write("in/a.csv", content, encoding)
    try:
        stats = load_delimited(spark, path, "detected", quarantine_path=str(path) + "-bad").first()
        assert (stats.total_rows, stats.failed_rows) == (28, 0)
        loaded = spark.table("detected")
        assert dict(loaded.dtypes) == {"id": "int", "prénom": "string", "when": "date"}
        assert {r["prénom"] for r in loaded.collect()} == {f"é{i}" for i in range(1, 29)}
    finally:
        spark.sql("DROP TABLE IF EXISTS detected")


def test_files_that_hold_only_the_header(spark, write, tmp_path):
    """A writer leaves such a file for an empty partition, next to the files with its rows."""
    rows = "".join(f"{i},n{i}\n" for i in range(1, 30))
    for name, content in {"a": "id,name\n", "b": "id,name\n" + rows, "c": "id,name\n", "blank": "\n\n"}.items():
        write(f"in/{name}.csv", content)
    folder = str(tmp_path / "in")
    layout, names = detect_layout(spark, folder)
    assert (layout.sep, layout.header, names) == (",", True, ["id", "name"])
    assert {r.column_name: r.sql_type for r in analyze_files(spark, folder).collect()} == {"id": "INT", "name": "VARCHAR(10)"}
    spark.sql("CREATE DATABASE header_only_db")
    try:
        load_incremental(spark, folder, "header_only_db.t", str(tmp_path / "state"), id_column="no").awaitTermination()
        assert sorted((r.id, r.name) for r in spark.table("header_only_db.t").collect()) == [(i, f"n{i}") for i in range(1, 30)]
    finally:
        spark.sql("DROP DATABASE header_only_db CASCADE")


def test_rejected_rows_as_csv(spark, write, tmp_path):
    path = write("in/a.csv", "id,v\n1,a\n2,b,c\n3,d\n")
    out = str(tmp_path / "bad")
    try:
        load_delimited(spark, path, "with_rejects", quarantine_path=out, quarantine_format="csv")
        bad = spark.read.option("header", True).csv(out)
        assert [r.error_type for r in bad.collect()] == ["malformed_row"]
    finally:
        spark.sql("DROP TABLE IF EXISTS with_rejects")


def test_files_of_several_layouts(spark, write, tmp_path):
    from sluicegate.plans.mixed import data_columns, scan_mixed

    write("in/a.csv", "k,name\n1,plain\n10,more\n")
    write("in/b.csv", "k;name;extra\n2;caf\u00e9;x\n20;b;y\n", "iso-8859-1")
    write("in/header_only.csv", "k,name\n")
    write("in/blank.csv", "\n\n")
    write("in/empty.csv", "")
    write("in/plain.csv", "3\tthree\n30\tthirty\n")
    rows = scan_mixed(spark, str(tmp_path / "in"), ["k", "name"])
    assert sorted(data_columns(rows)) == ["extra", "k", "name"]
    assert sorted((r.k, r.name, r.extra) for r in rows.collect()) == [
        ("1", "plain", None), ("10", "more", None), ("2", "caf\u00e9", "x"), ("20", "b", "y"), ("3", "three", None), ("30", "thirty", None),
    ]
    spark.sql("CREATE DATABASE mixed_db")
    try:
        load_delimited(spark, str(tmp_path / "in"), "mixed_db.t", ["k", "name"], mixed=True, id_column="id")
        assert sorted(r.k for r in spark.table("mixed_db.t").collect()) == [1, 2, 3, 10, 20, 30]
    finally:
        spark.sql("DROP DATABASE mixed_db CASCADE")
