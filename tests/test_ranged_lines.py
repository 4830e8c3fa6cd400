"""Lines read range by range, in any encoding, below header rows and in mixed folders."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from sluicegate.operators.cast import SOURCE_FILE
from sluicegate.plans import mixed
from sluicegate.plans.mixed import data_columns, scan_mixed
from sluicegate.sources import delimited, ranges
from sluicegate.sources.delimited import Layout, scan_delimited
from sluicegate.workspace import shared_folder


@pytest.mark.parametrize("name", ["utf-8", "utf-16-le", "utf-16-be", "iso8859-1", "cp1252"])
def test_ranges_give_every_line_once(name, monkeypatch):
    """Any cut into ranges gives the lines of the whole, also where steps end inside lines."""
    monkeypatch.setattr(ranges, "STEP_BYTES", 7)
    rng = random.Random(name)
    alphabet = "ab\n\n\r ĊਊéĀ😀" if name.startswith("utf") else "ab\n\r é"
    for _ in range(200):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        data, size = text.encode(name), rng.choice([2, 4, 6, 10, 16, 64])
        found = []
        for begin in range(0, max(len(data), 1), size):
            for number, lines in ranges.lines_of_range(lambda at, n: data[at : at + n], begin, begin + size, name, begin > 0):
                assert number == 0 or number == len(own)
                own = lines if number == 0 else own + lines
                found += lines
        want = text.split("\n")[: -1 if text.endswith("\n") or not text else None]
        assert found == [x.rstrip("\r") for x in want]


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("encoding", ["UTF-16", "UTF-16LE", "UTF-16BE"])
def test_one_utf16_file_is_read_by_several_tasks(spark, write, small_ranges, encoding):
    rows = [(str(i), f"Ċ{i}é, {'x' * (i % 40)}😀ਊ") for i in range(2000)]
    text = "id;name\n" + "".join(f"{a};{b}\n" for a, b in rows)
    path = write("u.csv", text.encode("utf-16" if encoding == "UTF-16" else encoding))
    found = scan_delimited(spark, path, ["id", "name"], Layout(sep=";", encoding=encoding), with_position=True, with_file=True)
    assert sorted((r.id, r.name) for r in found.collect()) == sorted(rows)
    assert found.select("_block_start").distinct().count() > 10
    placed = found.orderBy(*delimited.FILE_ORDER).collect()
    assert [r.id for r in placed] == [a for a, _ in rows]
    assert found.groupBy(F.spark_partition_id()).count().count() > 1


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-8-SIG", "UTF-16", "ISO-8859-1", "cp1250", "gb18030", "shift_jis"])
def test_header_row_in_any_encoding(spark, write, small_ranges, encoding):
    word = {"cp1250": "žluťoučký", "gb18030": "数据", "shift_jis": "データ表", "ISO-8859-1": "café"}.get(encoding, "Ċé数")
    body = [(str(i), f"{word}{i}") for i in range(600)]
    text = f"# {word}\n\n  \nid;name\n\n" + "".join(f"{a};{b}\n" for a, b in body)
    path = write("h.csv", text.encode(encoding))
    found = scan_delimited(spark, path, ["id", "name"], Layout(sep=";", encoding=encoding, header_row=1))
    assert sorted(tuple(r)[:2] for r in found.collect()) == sorted(body)


def test_header_row_beyond_the_first_range(spark, write, small_ranges):
    path = write("far.csv", "# comment\n" * 3000 + "id,name\n1,a\n2,b\n")
    found = scan_delimited(spark, path, ["id", "name"], Layout(header_row=3000))
    assert sorted((r.id, r.name) for r in found.collect()) == [("1", "a"), ("2", "b")]
    none = scan_delimited(spark, path, ["id", "name"], Layout(header_row=9000))
    assert none.collect() == []


def test_header_row_of_compressed_files(spark, write, small_ranges):
    text = "# top\nid,name\n" + "".join(f"{i},n{i}\n" for i in range(3000))
    path = write("z.csv.gz", gzip.compress(text.encode()))
    found = scan_delimited(spark, path, ["id", "name"], Layout(header_row=1))
    assert found.count() == 3000 and found.where("name = 'n2999'").count() == 1


def test_unknown_encodings_are_refused(spark, write):
    path = write("x.csv", "a\nid\n1\n")
    for encoding in ("utf-32", "nosuch", "utf-7"):
        with pytest.raises(ValueError, match="one by one"):
            scan_delimited(spark, path, ["id"], Layout(encoding=encoding, header_row=1))


def test_scans_without_ranges_agree(spark, write, tmp_path, monkeypatch):
    """A store that tasks cannot open is scanned by Spark with the same result."""
    write("in/a.csv", "# x\n\nid;name\n1;é\n2;b\n")
    write("in/b.csv", "# y\nid;name\n3;c\n")
    layout = Layout(sep=";", header_row=1)
    rows = lambda: sorted(tuple(r)[:2] for r in scan_delimited(spark, str(tmp_path / "in"), ["id", "name"], layout).collect())
    ranged = rows()
    for module in (delimited, mixed):
        monkeypatch.setattr(module, "readable", lambda path: False)
    assert rows() == ranged == [("1", "é"), ("2", "b"), ("3", "c")]


MANY = 260


@pytest.fixture
def many_layouts(write, tmp_path):
    """Every file has a column of its own, in one of five separators and two encodings."""
    for i in range(MANY):
        sep, encoding = ",;\t|:"[i % 5], "utf-16" if i % 3 == 0 else "utf-8"
        text = f"key{sep}own_{i}{sep}Name\n" + "".join(f"{i}{sep}{i}x{j}{sep}café\n" for j in range(2))
        write(f"many/f{i}.csv", text.encode(encoding))
    return str(tmp_path / "many")


def test_more_than_two_hundred_layouts(spark, many_layouts):
    rows = scan_mixed(spark, many_layouts)
    assert set(data_columns(rows)) == {"key", "Name", *(f"own_{i}" for i in range(MANY))}
    found = rows.select("key", F.coalesce(*[f"own_{i}" for i in range(MANY)]).alias("own"), "Name").collect()
    assert sorted(tuple(r) for r in found) == sorted((str(i), f"{i}x{j}", "café") for i in range(MANY) for j in range(2))


def test_plan_does_not_grow_with_layouts(spark, write, tmp_path, plan):
    def scans(count):
        folder = f"p{count}"
        for i in range(count):
            write(f"{folder}/f{i}.csv", f"a,own_{i},n\n1,x,2\n")
        return plan(scan_mixed(spark, str(tmp_path / folder))).count("Scan ")

    assert scans(2) == scans(12)


def test_mixed_rules(spark, write, tmp_path):
    write("m/a.csv", 'id,name,name\n1,"x, ""y""",z\n2,b\n3,c,d,e\n')
    write("m/b.csv", "ID;Extra\n4;q\n")
    write("m/c.csv", "7|8|9\n10|11|12\n")
    write("m/only_header.csv", "id,name,name\n")
    write("m/empty.csv", b"")
    write("m/blank.csv", "\n\n")
    rows = scan_mixed(spark, str(tmp_path / "m"), ["id", "one", "two"])
    assert data_columns(rows) == ["ID", "Extra", "name", "one", "name_2", "two"]
    found = {r.ID: r for r in rows.collect()}
    assert (found["1"].name, found["1"].name_2, found["1"].Extra) == ('x, "y"', "z", None)
    assert (found["2"].name, found["2"].name_2, found["2"]._bad_line) == ("b", None, None)
    assert found["3"]._bad_line == "3,c,d,e" and found["4"].Extra == "q"
    assert (found["7"].one, found["7"].two) == ("8", "9") and found["10"].two == "12"
    assert len(found) == 6 and found["1"][SOURCE_FILE].endswith("a.csv")
    assert "3" not in {r.ID for r in scan_mixed(spark, str(tmp_path / "m"), (), "skip").collect()}
    with pytest.raises(Exception, match="bad line: 3,c,d,e"):
        scan_mixed(spark, str(tmp_path / "m"), (), "error").collect()


def test_mixed_scan_without_ranges(spark, write, tmp_path, monkeypatch):
    write("w/a.csv", "id,name\n1,é\n")
    write("w/b.csv", "name;id\nü;2\n".encode("utf-16"))
    rows = lambda: sorted((r.id, r.name) for r in scan_mixed(spark, str(tmp_path / "w")).collect())
    assert rows() == [("1", "é"), ("2", "ü")]
    monkeypatch.setattr(mixed, "readable", lambda path: False)
    assert rows() == [("1", "é"), ("2", "ü")]


def test_no_copy_of_the_input_stays(spark, write, tmp_path):
    folder = os.path.join(shared_folder(spark).removeprefix("file:"), "sluicegate")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    path = write("copy.csv", "# x\nid,name\n1,a\n")
    assert scan_delimited(spark, path, ["id", "name"], Layout(header_row=1)).count() == 1
    new = set(os.listdir(folder)) - before
    assert not any(x.startswith("lines-") for x in new)
