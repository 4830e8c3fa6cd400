"""Listing in tasks and reading beginnings of files."""

import bz2
import gzip
import os
import time
import zlib

import pytest
from pyspark.sql import functions as F

from sluicegate.sources import dialect, heads, ranges
from sluicegate.sources.delimited import Layout, header_names
from sluicegate.sources.files import file_inventory
from sluicegate.sources.lines import file_heads, raw_lines


def names(df):
    return sorted(r["file"].rpartition("/")[2] for r in df.collect())


def scanned(spark, path):
    """The listing that Spark makes for a scan."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return sorted(tuple(r) for r in found.select("_metadata.file_path", "_metadata.file_size").collect())


@pytest.fixture
def folder(write, tmp_path):
    for name in ("a.csv", "deep/er/b c.csv", "deep/é%25 #+&'(.csv", "deep/_hidden.csv", "deep/.dot", "_no/c.csv", "k=1/_x=2/d.csv"):
        write(name, f"id\n{name}\n")
    return str(tmp_path)


def test_list_as_a_scan_would(spark, folder):
    found = ranges.list_files(spark, folder)
    assert sorted(tuple(r) for r in found.collect()) == scanned(spark, folder)


@pytest.mark.parametrize("glob", ["*.csv", "deep/*/b*", "{a,z}.csv", "*/*", "[a-d]*", "deep/*r", "k=?"])
def test_list_globs(spark, folder, glob):
    path = f"{folder}/{glob}"
    assert sorted(tuple(r) for r in ranges.list_files(spark, path).collect()) == scanned(spark, path)


def test_list_files_given_one_by_one(spark, folder):
    paths = [f"{folder}/a.csv", f"file://{folder}/deep"]
    assert sorted(tuple(r) for r in ranges.list_files(spark, paths).collect()) == scanned(spark, paths)


def test_list_empty_files_and_folders(spark, write, tmp_path):
    write("empty.csv", b"")
    os.makedirs(tmp_path / "nothing/in/here")
    assert [tuple(r)[1] for r in ranges.list_files(spark, str(tmp_path)).collect()] == [0]


def test_files_that_arrow_cannot_open_are_told(tmp_path):
    assert ranges.readable(str(tmp_path))
    assert not ranges.readable(str(tmp_path / "missing"))
    assert not ranges.readable("viewfs://store/in")
    assert not ranges.readable([str(tmp_path), "nosuch://place/x"])


CONTENTS = {
    "plain.csv": b"a\n\n  \t\r\nb\nc\nd\ne\nf\n",
    "open_end.csv": b"a\nb",
    "bom.csv": b"\xef\xbb\xbfa\nb\n",
    "crlf.csv": b"a\r\nb\r\n",
    "utf16.csv": "id;x\n1;é\n".encode("utf-16-le"),
    "empty.csv": b"",
    "blank.csv": b"\n \n\t\n",
    "long_line.csv": b"x" * (3 * ranges.FIRST_BYTES) + b"\nnext\n",
    "late.csv": b"\n" * (2 * ranges.FIRST_BYTES) + b"late\n",
    "a.csv.gz": gzip.compress(b"a\nb\n"),
    "a.csv.bz2": bz2.compress(b"a\nb\n"),
    "a.csv.deflate": zlib.compress(b"a\nb\n"),
}


def test_first_lines_are_those_of_a_scan(spark, write, tmp_path):
    for name, content in CONTENTS.items():
        write(name, content)
    path = str(tmp_path)
    want = file_heads(raw_lines(spark, path), 3).select("file", "line_no", F.col("value").cast("binary").alias("value"))
    found = heads.head_lines(spark, path, 3).withColumn("value", F.col("value").cast("binary"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_other_compressions_are_scanned(spark, write, tmp_path):
    spark.range(3).select(F.col("id").cast("string").alias("value")).coalesce(1).write.option("compression", "snappy").text(str(tmp_path / "z"))
    found = heads.head_lines(spark, str(tmp_path / "z"), 2).orderBy("line_no").collect()
    assert [(r.line_no, r.value) for r in found] == [(1, "0"), (2, "1")]
    assert dialect.delimiter_report(spark, str(tmp_path / "z")).count() == 1


def test_a_huge_file_costs_its_beginning(spark, write, tmp_path):
    """A file of 200 GB (sparse): heads, header names and the inventory read its first bytes."""
    path = write("huge.csv", "id;name\n1;a\n2;b\n")
    os.truncate(path, 200 << 30)
    begun = time.time()
    found = heads.head_lines(spark, path, 3).orderBy("line_no").collect()
    assert [r.value for r in found] == ["id;name", "1;a", "2;b"]
    assert header_names(spark, path, Layout(sep=";")).first().column_names == ["id", "name"]
    row = file_inventory(spark, path).first()
    assert (row.file_size, row.estimated_rows) == (200 << 30, (200 << 30) * 3 // 100_000)
    assert time.time() - begun < 60
    beginning = ranges.Beginning(f"file:{path}")
    beginning.lines(3)
    assert len(beginning.data) <= ranges.FIRST_BYTES


def test_header_report_scans_once(spark, write, tmp_path, plan, monkeypatch):
    write("a.csv", "id,name\n1,x\n2,y\n")
    scans = []
    monkeypatch.setattr(dialect, "raw_lines", lambda *a: scans.append(a) or raw_lines(*a))
    report = dialect.header_report(spark, str(tmp_path))
    assert len(scans) == 1
    assert "FileScan text" not in plan(report)
    assert report.first().column_names == ["id", "name"]


@pytest.mark.parametrize(
    "content, delimiter",
    [
        ("a,b|c|d\ne,f|g|h\n", ","),
        ("a;b,c,d\ne;f,g,h\n", ","),
        ("a:b;c\nd:e;f\n", ";"),
        ("10:20\n11:30\n", ":"),
        ("a|b:c:d\nd|e:f:g\n", "|"),
    ],
)
def test_constant_candidates_go_by_the_list(spark, write, content, delimiter):
    assert dialect.delimiter_report(spark, write("s/file.csv", content)).first().delimiter == delimiter


def test_inventory_estimates(spark, write, tmp_path):
    write("one.csv", "no line ends here")
    write("none.csv", b"")
    write("few.csv", "a\nb\nc\n")
    write("many.csv", "0123456789\n" * 50_000)
    found = {r.file.rpartition("/")[2]: r.estimated_rows for r in file_inventory(spark, str(tmp_path)).collect()}
    ends = 100_000 // 11
    assert found == {"one.csv": 1, "none.csv": 0, "few.csv": 3, "many.csv": 550_000 * ends // 100_000}
    assert {r.estimated_rows for r in file_inventory(spark, str(tmp_path), estimate_rows=False).collect()} == {None}


def test_inventory_makes_no_list_in_the_driver(spark, write, tmp_path, plan):
    write("a.csv", "x\n")
    assert "binaryFile" not in plan(file_inventory(spark, str(tmp_path)))


def test_folders_left_to_further_rounds(spark, write, tmp_path):
    for i in range(20):
        write(f"l{i % 4}/m{i % 2}/n{i}/f{i}.csv", "x" * (i + 1))
    path = str(tmp_path)
    assert sorted(tuple(r) for r in ranges.list_files(spark, path, at_once=1).collect()) == scanned(spark, path)
