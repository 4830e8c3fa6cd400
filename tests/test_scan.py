import pytest

from sluicegate.sources import delimited
from sluicegate.operators.cast import typed_cast
from sluicegate.sources.delimited import (
    Layout,
    header_names,
    parse_lines,
    positional_names,
    sample_rows,
    scan_delimited,
)

COLUMNS = ["id", "name", "value"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_separators(spark, write, sep):
    path = write("f.csv", f"id{sep}name{sep}value\n1{sep}a{sep}2\n")
    assert rows(scan_delimited(spark, path, COLUMNS, Layout(sep), "skip")) == [("1", "a", "2")]


def test_quotes(spark, write):
    path = write("f.csv", 'id,name,value\n1,"a, ""b""",2\n')
    assert rows(scan_delimited(spark, path, COLUMNS, on_bad_lines="skip")) == [("1", 'a, "b"', "2")]


@pytest.mark.parametrize(
    "encoding, name", [("utf-8", "UTF-8"), ("iso-8859-1", "ISO-8859-1"), ("utf-16", "UTF-16"),
                       ("utf-8-sig", "UTF-8-SIG")]
)
def test_encodings(spark, write, encoding, name):
    path = write("f.csv", "id,name,value\n1,café,2\n2,thé,3\n", encoding)
    found = rows(scan_delimited(spark, path, COLUMNS, Layout(encoding=name), "skip"))
    assert found == [("1", "café", "2"), ("2", "thé", "3")]


RAGGED = "id,name,value\n1,a,2\n3,short\n4,b,5,long\n6,c,7\n"


def test_bad_lines_skip_and_warn(spark, write):
    path = write("f.csv", RAGGED)
    kept = rows(scan_delimited(spark, path, COLUMNS, on_bad_lines="skip").na.fill("-"))
    assert kept == [("1", "a", "2"), ("3", "short", "-"), ("6", "c", "7")]
    warned = scan_delimited(spark, path, COLUMNS, on_bad_lines="warn")
    assert [r._bad_line for r in warned.collect() if r._bad_line] == ["4,b,5,long"]


def test_counts_do_not_depend_on_the_columns_read(spark, write):
    path = write("f.csv", RAGGED)
    kept = scan_delimited(spark, path, COLUMNS, on_bad_lines="skip")
    assert kept.count() == 3
    assert kept.select("id").distinct().count() == 3


def test_bad_lines_error(spark, write):
    path = write("f.csv", RAGGED)
    with pytest.raises(Exception, match="bad line: 4,b,5,long"):
        scan_delimited(spark, path, COLUMNS, on_bad_lines="error").collect()
    clean = write("g.csv", "id,name,value\n1,a,2\n3,short\n")
    assert scan_delimited(spark, clean, COLUMNS, on_bad_lines="error").count() == 2


def test_short_rows_can_be_bad(spark, write):
    path = write("f.csv", RAGGED)
    assert scan_delimited(spark, path, COLUMNS, on_bad_lines="skip", short_rows="bad").count() == 2


def test_blank_lines(spark, write):
    path = write("f.csv", "id,name,value\n\n1,a,2\n   \n3,b,4\n")
    assert scan_delimited(spark, path, COLUMNS, on_bad_lines="skip").count() == 2
    kept = scan_delimited(spark, path, COLUMNS, Layout(skip_blank_lines=False, header=False), "skip")
    assert kept.count() == 5


def test_no_header(spark, write):
    path = write("f.csv", "1,a,2\n3,b,4\n")
    names = positional_names(3)
    df = scan_delimited(spark, path, names, Layout(header=False), "skip")
    assert df.columns == ["column_1", "column_2", "column_3"]
    assert df.count() == 2


@pytest.mark.parametrize("limit", [delimited.BROADCAST_BYTES, 0])
def test_header_row_in_split_files(spark, write, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(delimited, "BROADCAST_BYTES", limit)
    top = "# comment, with commas\n\n# more\nid,name,value\n"
    write("in/a.csv", top + "".join(f"{i},a,{i}\n" for i in range(2000)))
    write("in/b.csv", top + "".join(f"{i},b,{i}\n" for i in range(2000, 2010)))
    layout = Layout(header_row=2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = scan_delimited(spark, str(tmp_path / "in"), COLUMNS, layout, "skip", with_file=True)
        found = typed_cast(df, {"id": "int"})
        assert sorted(r.id for r in found.collect()) == list(range(2010))
        names = {tuple(r.column_names) for r in header_names(spark, str(tmp_path / "in"), layout).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert names == {("id", "name", "value")}


def test_degenerate_files(spark, write):
    assert scan_delimited(spark, write("e.csv", b""), COLUMNS, on_bad_lines="skip").count() == 0
    only = write("h.csv", "id,name,value\n")
    assert scan_delimited(spark, only, COLUMNS, on_bad_lines="skip").count() == 0


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "plain", "x"), ("2", 'with "quotes", and ; more', "y"), ("3", "ünï", None)],
        "id string, name string, value string",
    )
    path = str(tmp_path / "out")
    df.write.option("header", True).option("escape", '"').csv(path)
    back = scan_delimited(spark, path, COLUMNS, on_bad_lines="skip")
    assert sorted(map(tuple, back.na.fill("~").collect())) == sorted(map(tuple, df.na.fill("~").collect()))


def test_a_filter_does_not_parse_lines_again(spark, plan):
    lines = spark.range(10).selectExpr("concat(id, ',x,', id) AS line")
    kept = parse_lines(lines, "line", COLUMNS, Layout(header=False), "skip").where("id > 3 AND value > 3")
    text = plan(kept)
    assert text.count("from_csv") == 1


def test_sample_is_a_top_k(spark, plan):
    sample = sample_rows(spark.range(1000), ["id"], 5)
    assert [r.id for r in sample.collect()] == [0, 1, 2, 3, 4]
    assert "TakeOrderedAndProject" in plan(sample)


@pytest.mark.parametrize("parallelism", ["1", "4", "64"])
def test_header_rows_do_not_depend_on_parallelism(spark, tmp_path, parallelism):
    for i in range(40):
        (tmp_path / f"{i}.csv").write_text(f"# note\nk,v\n{i},x{i}\n")
    (tmp_path / "short.csv").write_text("# note\n")
    frame = scan_delimited(spark, str(tmp_path), ["k", "v"], Layout(header_row=1))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism)
    try:
        assert sorted(int(r.k) for r in frame.collect()) == list(range(40))
        again = scan_delimited(spark, str(tmp_path), ["k", "v"], Layout(header_row=1))
        assert sorted(int(r.k) for r in again.collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_a_quote_inside_a_field_is_a_letter(spark, write):
    path = write("pipes.csv", 'a;b;c\n1;5" pipe;x\n1;5" pipe;x;3" bolt\n2;"a;b";y\n3;"a "";"" b";z\n')
    found = scan_delimited(spark, path, ["a", "b", "c"], Layout(sep=";")).collect()
    assert [r._bad_line is not None for r in found] == [False, True, False, False]


def test_what_lines_cannot_hold_is_refused(spark, write):
    path = write("refused.csv", "x\na,b\n1,2\n")
    with pytest.raises(ValueError, match="multiline"):
        scan_delimited(spark, path, ["a", "b"], Layout(header_row=1, multiline=True))
    with pytest.raises(ValueError, match="utf-32"):
        scan_delimited(spark, path, ["a", "b"], Layout(header_row=1, encoding="utf-32"))
    latin = scan_delimited(spark, path, ["a", "b"], Layout(header_row=1, encoding="latin1")).collect()
    assert [(r.a, r.b) for r in latin] == [("1", "2")]
