import gzip

import pytest
from pyspark.sql import functions as F

from sluicegate.sources import dialect
from sluicegate.sources.files import file_inventory
from sluicegate.sources.lines import file_heads, raw_lines


def by_name(df):
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    return {r["name"]: r for r in df.withColumn("name", name).collect()}


def test_encodings(spark, write, tmp_path):
    text = "id,name\n1,café\n2,thé\n"
    write("utf8.csv", text)
    write("bom.csv", text, "utf-8-sig")
    write("bom_open_end.csv", text.rstrip("\n"), "utf-8-sig")
    write("open_end.csv", text.rstrip("\n"))
    write("latin.csv", text, "iso-8859-1")
    write("le_bom.csv", b"\xff\xfe" + text.encode("utf-16-le"))
    write("be_bom.csv", b"\xfe\xff" + text.encode("utf-16-be"))
    write("le.csv", text, "utf-16-le")
    write("be.csv", text, "utf-16-be")
    write("empty.csv", b"")
    write("only_bom.csv", b"\xef\xbb\xbf")
    write("crlf.csv", text.replace("\n", "\r\n"))
    found = {n: r.encoding for n, r in by_name(dialect.encoding_report(spark, str(tmp_path), include_empty=True)).items()}
    assert found == {
        "utf8.csv": "UTF-8",
        "bom.csv": "UTF-8-SIG",
        "bom_open_end.csv": "UTF-8-SIG",
        "open_end.csv": "UTF-8",
        "latin.csv": "ISO-8859-1",
        "le_bom.csv": "UTF-16LE",
        "be_bom.csv": "UTF-16BE",
        "le.csv": "UTF-16LE",
        "be.csv": "UTF-16BE",
        "empty.csv": "UTF-8",
        "only_bom.csv": "UTF-8",
        "crlf.csv": "UTF-8",
    }


def test_compressed_files(spark, write, tmp_path):
    # short content grows when compressed, which must not look like a byte-order mark
    write("a.csv.gz", gzip.compress("id,name\n1,é\n".encode()))
    write("b.csv.gz", gzip.compress("id,name\n1,é\n".encode("iso-8859-1")))
    found = {n: r.encoding for n, r in by_name(dialect.encoding_report(spark, str(tmp_path))).items()}
    assert found == {"a.csv.gz": "UTF-8", "b.csv.gz": "ISO-8859-1"}


def test_late_bytes_decide_the_encoding(spark, write, tmp_path):
    write("late.csv", b"id,name\n" + b"1,plain\n" * 20_000 + b"2,caf\xe9\n")
    assert by_name(dialect.encoding_report(spark, str(tmp_path)))["late.csv"].encoding == "ISO-8859-1"


def test_encoding_is_the_same_when_files_are_split(spark, write, tmp_path):
    write("big.csv", "﻿id,name\n" + "1,café\n" * 5000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        row = by_name(dialect.encoding_report(spark, str(tmp_path)))["big.csv"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert row.encoding == "UTF-8-SIG"


@pytest.mark.parametrize(
    "content, delimiter",
    [
        ("id,name,value\n1,a,2\n2,b,3\n", ","),
        ("id;name;value\n1;a;2\n2;b;3\n", ";"),
        ("id\tname\n1\ta, b\n2\tb\n", "\t"),
        ("id|name\n1|a\n2|b\n", "|"),
        ("id:name\n1:a\n2:b\n", ":"),
        ('id;text\n1;"a,b,c"\n2;"d,e,f"\n', ";"),
        ("one\ntwo\nthree\n", ","),
        ("a b c\nd e\nf g h i\n", " "),
        ("a;b\n\n\nc;d\n", ";"),
        ("", ","),
        ("a,b;c\nd;e\nf;g\n", ";"),
    ],
)
def test_delimiter(spark, write, content, delimiter):
    path = write("d/file.csv", content)
    assert dialect.delimiter_report(spark, path, include_empty=True).first().delimiter == delimiter


@pytest.mark.parametrize(
    "line, sep, fields",
    [
        ("a,b,c", ",", ["a", "b", "c"]),
        (",a,", ",", ["", "a", ""]),
        ('"x,y",z', ",", ["x,y", "z"]),
        ('"say ""hi""";2', ";", ['say "hi"', "2"]),
        ("a|b", "|", ["a", "b"]),
        ('5" pipe|x', "|", ['5" pipe', "x"]),
        ('"",b', ",", ["", "b"]),
    ],
)
def test_split_line(spark, line, sep, fields):
    df = spark.createDataFrame([(line, sep)], "line string, sep string")
    assert df.select(dialect.split_line(F.col("line"), F.col("sep"))).first()[0] == fields


@pytest.mark.parametrize(
    "content, header, names",
    [
        ("id,name,value\n1,ann,2.5\n2,bob,3\n", True, ["id", "name", "value"]),
        ("1,ann,2.5\n2,bob,3\n3,cy,4\n", False, ["column_1", "column_2", "column_3"]),
        ("code,kind\nAB1,x\nAB2,y\nAB3,z\n", True, ["code", "kind"]),
        ("AB0,x\nAB2,y\nAB3,z\n", False, ["column_1", "column_2"]),
        ('"full, name";id\n"a, b";1\n"c, d";2\n', True, ["full, name", "id"]),
    ],
)
def test_header(spark, write, content, header, names):
    path = write("h/file.csv", content)
    row = dialect.header_report(spark, path).first()
    assert (row.has_header, row.num_columns, row.column_names) == (header, len(names), names)


@pytest.mark.parametrize("encoding", ["utf-8-sig", "utf-16-le", "utf-16-be", "iso-8859-1"])
def test_header_names_are_decoded(spark, write, encoding):
    path = write("e/file.csv", "id;prénom\n1;zoé\n2;chloé\n3;al\n", encoding)
    row = dialect.dialect_report(spark, path).first()
    assert row.column_names == ["id", "prénom"]
    assert row.delimiter == ";"


def test_column_set_diff(spark, write, tmp_path):
    write("a.csv", "id,name\n1,x\n2,yy\n")
    write("b.csv", "id,colour\n1,red\n2,blue\n")
    headers = dialect.header_report(spark, str(tmp_path))
    rows = dialect.column_set_diff(headers, ["id", "name"]).collect()
    found = {(r.file[-5:], r.status, r.column_name) for r in rows}
    assert found == {
        ("a.csv", "common", "id"), ("a.csv", "common", "name"), ("b.csv", "common", "id"),
        ("b.csv", "missing", "name"), ("b.csv", "extra", "colour"),
    }


def test_heads_are_in_file_order_and_bounded(spark, write, tmp_path, plan):
    write("a.csv", "".join(f"a{i}\n" for i in range(3000)))
    write("b.csv", "\n\n" + "".join(f"b{i}\n" for i in range(3)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        heads = file_heads(raw_lines(spark, str(tmp_path)), 5)
        rows = heads.orderBy("file", "line_no").collect()
        assert [r.value for r in rows] == ["a0", "a1", "a2", "a3", "a4", "b0", "b1", "b2"]
        text = plan(heads)
        # the rank filter runs before the shuffle
        assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inventory(spark, write, tmp_path):
    write("three.csv", "a\nb\nc\n")
    write("open.txt", "a\nb\nc")
    write("empty.CSV", b"")
    write("no_newline.dat", "abc")
    write("big file-1.csv", "x" * 99 + "\n" + ("y" * 99 + "\n") * 29)
    rows = by_name(file_inventory(spark, str(tmp_path)))
    facts = {n: (r.extension, r.file_size, r.size_text, r.estimated_rows) for n, r in rows.items()}
    assert facts == {
        "three.csv": ("csv", 6, "6 B", 3),
        "open.txt": ("txt", 5, "5 B", 2),
        "empty.CSV": ("csv", 0, "0 B", 0),
        "no_newline.dat": ("dat", 3, "3 B", 1),
        "big%20file-1.csv": ("csv", 3000, "2.93 KB", 30),
    }
    assert rows["three.csv"].table_name == "three"
    assert rows["big%20file-1.csv"].table_name == "big_file_1"
    listed = by_name(file_inventory(spark, str(tmp_path), estimate_rows=False))
    assert {n: r.file_size for n, r in listed.items()} == {n: f[1] for n, f in facts.items()}


def test_times_do_not_make_a_colon_the_separator(spark, write, tmp_path):
    write("times.csv", "1,10:20:30,11:30:40\n2,12:00:00,13:00:00\n")
    assert by_name(dialect.delimiter_report(spark, str(tmp_path)))["times.csv"].delimiter == ","
