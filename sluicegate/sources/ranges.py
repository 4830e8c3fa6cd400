"""Folders listed and beginnings of files read in tasks.

A file set can be large in two ways: many files, and long ones. Listing deals folders to tasks,
round by round, so that paths never gather in the driver; reading the beginning of a file asks
for its first bytes only, so it costs the same for a short file and for a very long one. Both
open files through Arrow. Stores that Arrow cannot open are left to Spark's own scans, which
:func:`readable` tells before.
"""

from __future__ import annotations

import codecs
import re
import urllib.parse
import zlib
from collections.abc import Iterable, Iterator, Sequence
from fnmatch import translate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluicegate.workspace import ship, staging_path, tasks_for_small_work

#: Bytes asked for at first; twice as many again while that is not enough.
FIRST_BYTES = 1 << 16
#: Compressed files that are read as what they hold; others by name are left to Spark.
_INFLATED = re.compile(r"(?i)\.(gz|bz2|zst)$")
_UNKNOWN = r"(?i)\.(snappy|lz4)$"
_CODECS = {"gz": "gzip", "bz2": "bz2", "zst": "zstd"}
_GLOB = re.compile(r"[*?\[{]")
_BOM = b"\xef\xbb\xbf"


def open_place(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a plain (not encoded) path or URI, and the path in it."""
    scheme = re.match(r"([a-z][a-z0-9+.-]*):", path)
    if scheme is None or scheme[1] == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if scheme[1] in ("s3a", "s3n"):
        path = "s3" + path[len(scheme[1]) :]
    base, _, inner = path.partition("://")
    bucket, _, key = inner.partition("/")
    system, root = fs.FileSystem.from_uri(f"{base}://{bucket}")
    return system, f"{root.rstrip('/')}/{key}".rstrip("/")


def uri_of(path: str) -> str:
    """A plain path as Spark names the file in ``_metadata.file_path``."""
    return re.sub(r"""[^\w\-.~!'()*,;:$&+=@/\x80-\U0010ffff]""", lambda m: f"%{ord(m[0]):02X}", path)


def path_of(uri: str) -> str:
    """The plain path of a file that Spark names."""
    return urllib.parse.unquote(uri)


def _expanded(pattern: str) -> list[str]:
    """A glob without braces, as often as its braces say."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    return [p for part in found[1].split(",") for p in _expanded(pattern[: found.start()] + part + pattern[found.end() :])]


def _roots(path: str | list[str]) -> list[tuple[str, list[str]]]:
    """Given paths as a folder or file, and the components of the glob below it."""
    roots = []
    for given in [path] if isinstance(path, str) else path:
        for one in _expanded(given.rstrip("/") or "/"):
            at = _GLOB.search(one)
            base = one if at is None else one[: at.start()].rpartition("/")[0]
            rest = [] if at is None else one[len(base) + 1 :].split("/")
            if not re.match(r"[a-z][a-z0-9+.-]*:", base):
                base = "file:" + (base or "/")
            roots.append((re.sub(r"^file:/+", "file:/", base), rest))
    return roots


def readable(path: str | list[str]) -> bool:
    """Whether Arrow opens the places of all paths."""
    try:
        for base, _ in _roots(path):
            system, inner = open_place(base)
            if system.get_file_info(inner).type == fs.FileType.NotFound:
                return False
    except (OSError, pa.ArrowException, NotImplementedError):
        return False
    return True


def _hidden(name: str) -> bool:
    """Names that Spark passes over: files of them always, folders unless a glob matches them."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _children(path: str, rest: Sequence[str]) -> Iterator[tuple[str, list[str], int | None]]:
    """What lies below a folder one level down: (path, rest of the glob, size, or None for a folder)."""
    system, inner = open_place(path)
    own = system.get_file_info(inner)
    if own.type == fs.FileType.File:
        if not rest and not _hidden(own.base_name):
            yield path, [], own.size
        return
    if own.type != fs.FileType.Directory:
        return
    matches = re.compile(translate(rest[0].replace("[^", "[!"))).match if rest else None
    for child in system.get_file_info(fs.FileSelector(inner)):
        is_file = child.type == fs.FileType.File
        if matches and not matches(child.base_name) or _hidden(child.base_name) and (is_file or not matches):
            continue
        found = f"{path.rstrip('/')}/{child.base_name}"
        if child.type == fs.FileType.Directory:
            yield found, list(rest[1:]), None
        elif is_file and len(rest) <= 1:
            yield found, [], child.size


_ENTRY = "path string, rest array<string>, file_size bigint, file string"


#: Entries that a task lists, going down, before it leaves the folders it has found to others.
ENTRIES_AT_ONCE = 10_000


def _list_step(at_once: int):
    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, rest in zip(batch["path"].to_pylist(), batch["rest"].to_pylist(), strict=True):
                found, open_folders = [], [(path, rest)]
                while open_folders and len(found) < at_once:
                    for child, more, size in _children(*open_folders.pop()):
                        if size is None:
                            open_folders.append((child, more))
                        else:
                            found.append((child, more, size))
                found += [(folder, more, None) for folder, more in open_folders]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _, _ in found], pa.string()),
                        pa.array([r for _, r, _ in found], pa.list_(pa.string())),
                        pa.array([n for _, _, n in found], pa.int64()),
                        pa.array([uri_of(p) for p, _, _ in found], pa.string()),
                    ],
                    ["path", "rest", "file_size", "file"],
                )

    return step


def list_files(spark: SparkSession, path: str | list[str], at_once: int = ENTRIES_AT_ONCE) -> DataFrame:
    """(file, file_size) of every file below the paths, empty ones too; contents are not read.

    Folders are dealt to tasks, each of which goes down as far as ``at_once`` files and leaves
    the folders below to the next round. What is found is written to the shared folder; the
    driver learns only how many folders are left.
    """
    ship(spark)
    place = staging_path(spark, "listing")
    roots = [(base, rest, None, uri_of(base)) for base, rest in _roots(path)]
    below, folders, rounds = spark.createDataFrame(roots, _ENTRY), len(roots), 0
    while folders:
        parts, left = min(folders, tasks_for_small_work(spark)), Observation()
        found = below.repartition(parts) if rounds else below.coalesce(parts)
        found = found.mapInArrow(_list_step(at_once), _ENTRY).withColumn("folder", F.col("file_size").isNull())
        counted = found.observe(left, F.count_if("folder").alias("folders"))
        counted.write.parquet(f"{place}/round={rounds}")
        below = spark.read.schema(found.schema).parquet(f"{place}/round={rounds}").where("folder").drop("folder")
        folders, rounds = left.get["folders"], rounds + 1
    whole = spark.read.schema(found.schema)
    return whole.parquet(*[f"{place}/round={k}" for k in range(rounds)]).where("not folder").select("file", "file_size")


# -- beginnings of files --------------------------------------------------------------------


class Content:
    """What a file holds, decompressed, from its start on."""

    def __init__(self, file: str):
        system, inner = open_place(path_of(file))
        kind = _INFLATED.search(file)
        self._stream = system.open_input_stream(inner, compression=_CODECS[kind[1].lower()] if kind else None)
        self._inflate = zlib.decompressobj() if file.lower().endswith(".deflate") else None
        self._left = b""

    def read(self, size: int) -> bytes:
        """The next ``size`` bytes; fewer only at the end."""
        parts, missing = [self._left[:size]], size - len(self._left)
        self._left = self._left[size:]
        while missing > 0:
            more = self._stream.read(missing)
            if not more:
                break
            data = self._inflate.decompress(more) if self._inflate else more
            parts.append(data[:missing])
            self._left, missing = data[missing:], missing - len(data)
        return b"".join(parts)

    def close(self) -> None:
        self._stream.close()


class Beginning(Content):
    """The bytes of a file from its start, as many as are asked for."""

    def __init__(self, file: str):
        super().__init__(file)
        self.data, self.ended = b"", False

    def reach(self, size: int) -> bytes:
        """At least ``size`` bytes, unless the file ends before."""
        if len(self.data) < size and not self.ended:
            more = self.read(size - len(self.data))
            self.ended = len(more) < size - len(self.data)
            self.data += more
        return self.data

    def lines(self, count: int) -> list[bytes]:
        """The first ``count`` lines that are not blank, cut at line feeds; a byte-order mark is left out."""
        size = FIRST_BYTES
        while True:
            data = self.reach(size)
            whole = data if self.ended else data[: data.rfind(b"\n") + 1]
            found = [x for x in whole.removeprefix(_BOM).split(b"\n") if x.strip(b"\x00\r\t ")]
            if len(found) >= count or self.ended:
                return found[:count]
            size *= 2

    def body(self, encoding: str, skip: int) -> int:
        """The byte after the first ``skip`` lines with text, and after a byte-order mark."""
        name = codec_of(encoding)
        at = 0
        if name.startswith("utf-16"):
            name, at = _byte_order(lambda offset, size: self.reach(size)[:size], name)
        elif name == "utf-8" and self.reach(3)[:3] == _BOM:
            at = 3
        size = FIRST_BYTES
        while skip:
            data = self.reach(size)
            for end in _line_ends(data[at:], name) + at:
                skip -= bool(data[at:end].strip(b"\x00\r\t\n "))
                at = int(end)
                if not skip:
                    return at
            if self.ended:
                return len(data)
            size *= 2
        return at


def has_unknown_codec(files: DataFrame) -> bool:
    """Whether a file is compressed in a way that only Spark's scans read."""
    return not files.where(F.col("file").rlike(_UNKNOWN)).isEmpty()


def with_beginning(files: DataFrame, name: str, kind: str, arrow_kind: pa.DataType, read) -> DataFrame:
    """``files`` (file, ...) with a column of what ``read`` makes of each file's beginning and row.

    A list of many files has few bytes and would come to one task, so it is dealt to all cores.
    """
    ship(files.sparkSession)
    files = files.repartition(tasks_for_small_work(files.sparkSession))
    schema = f"{files.schema.toDDL()}, {name} {kind}"

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                beginning = Beginning(row["file"])
                made.append(read(beginning, row))
                beginning.close()
            yield batch.append_column(name, pa.array(made, arrow_kind))

    return files.mapInArrow(step, schema)


def with_first_lines(files: DataFrame, count: int) -> DataFrame:
    """``files`` with ``heads``, the bytes of each file's first lines that are not blank."""
    return with_beginning(files, "heads", "array<binary>", pa.list_(pa.binary()), lambda beginning, _: beginning.lines(count))


def with_sample(files: DataFrame, size: int) -> DataFrame:
    """``files`` with ``sampled``: how many bytes the first ``size`` are, and the line feeds among them."""

    def counted(beginning: Beginning, _: dict) -> list[int]:
        data = beginning.reach(size)[:size]
        return [len(data), data.count(b"\n")]

    return with_beginning(files, "sampled", "array<bigint>", pa.list_(pa.int64()), counted)


# -- lines, range by range ------------------------------------------------------------------

#: Bytes read at once inside a range.
STEP_BYTES = 1 << 20
LINES = "file string, block_start bigint, pos bigint, line string"
_WIDE = {"utf-16-le": "<u2", "utf-16-be": ">u2"}


def codec_of(encoding: str) -> str:
    """Python's name of an encoding whose lines end at a line feed wherever they are cut; others raise.

    Of encodings of one byte or several per character, those are refused that use the byte of a
    line feed inside a character.
    """
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        name = ""
    name = {"utf-8-sig": "utf-8", "ascii": "utf-8"}.get(name, name)
    plain = re.fullmatch(r"utf-8|utf-16(-[lb]e)?|iso8859-\d+|cp\d+|koi8-.|mac-\w+|gb\w+|big5\w*|shift_jis\w*|euc_\w+|tis-620|ptcp154", name)
    if plain is None or name not in ("utf-16", *_WIDE) and "\n".encode(name) != b"\n":
        raise ValueError(f"lines in {encoding} cannot be read one by one")
    return name


def _byte_order(read_at, name: str) -> tuple[str, int]:
    """The codec of a UTF-16 file and the bytes of its mark; without a mark, big-endian unless named."""
    mark = read_at(0, 2)
    if mark == b"\xff\xfe" and name != "utf-16-be":
        return "utf-16-le", 2
    if mark == b"\xfe\xff" and name != "utf-16-le":
        return "utf-16-be", 2
    return ("utf-16-be" if name == "utf-16" else name), 0


def _line_ends(data: bytes, name: str) -> np.ndarray:
    """Bytes of ``data`` up to the end of each line feed; ``data`` begins at a character."""
    if name in _WIDE:
        units = np.frombuffer(data, _WIDE[name], count=len(data) // 2)
        return (np.flatnonzero(units == 10) + 1) * 2
    return np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1


def _texts(data: bytes, name: str) -> list[str]:
    """The lines of whole lines' bytes, without their ends and a byte-order mark."""
    lines = data.decode(name, "replace").split("\n")
    if lines[-1] == "":
        lines.pop()
    return [x.rstrip("\r") for x in lines]


def lines_of_range(read_at, begin: int, end: int, name: str, inside: bool) -> Iterator[tuple[int, list[str]]]:
    """Lines that begin at the bytes ``begin`` to ``end`` of a file, some at a time, with the number before them.

    ``read_at(offset, size)`` gives fewer bytes only at the end of the file. A range that is not
    the first looks from the unit before it for the end of the line that runs into it.
    """
    at = begin - (2 if name in _WIDE else 1) if inside else begin
    held, number, found_begin = b"", 0, not inside
    while True:
        more = read_at(at + len(held), STEP_BYTES)
        held += more
        ends = _line_ends(held, name)
        if not found_begin:
            if len(ends):
                held, at = held[ends[0] :], at + int(ends[0])
                ends, found_begin = ends[1:] - ends[0], True
            elif not more:
                return
            else:  # the line that runs in goes on
                keep = len(held) % 2 if name in _WIDE else 0
                at, held = at + len(held) - keep, held[len(held) - keep :]
                continue
        if at >= end:
            return
        begins = np.append(0, ends)
        ours = int(np.searchsorted(begins + at, end))  # lines known to begin in the range
        whole = min(ours, len(ends))
        if whole:
            cut = int(ends[whole - 1])
            texts = _texts(held[:cut], name)
            yield number, texts
            number += len(texts)
            at, held = at + cut, held[cut:]
            if at >= end:
                return
        if not more:
            if held:
                yield number, _texts(held, name)
            return


def _compressed(file: str) -> bool:
    return bool(_INFLATED.search(file)) or file.lower().endswith(".deflate")


def _reader(file: str):
    """``read_at`` of a file, and how to close it; a compressed file is read forwards only."""
    if _compressed(file):
        content, position = Content(file), 0

        def read_on(offset: int, size: int) -> bytes:
            nonlocal position
            while position < offset and (passed := content.read(min(STEP_BYTES, offset - position))):
                position += len(passed)
            data = content.read(size)
            position += len(data)
            return data

        return read_on, content.close
    system, inner = open_place(path_of(file))
    opened = system.open_input_file(inner)
    length = opened.size()
    return (lambda offset, size: opened.read_at(max(0, min(size, length - offset)), offset)), opened.close


def _lines_step(tag: str | None):
    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, begin = row["file"], row["block_start"]
                name = codec_of(row["encoding"])
                if name.startswith("utf-16"):
                    beginning = Beginning(file)
                    name, _ = _byte_order(lambda offset, size, b=beginning: b.reach(size)[:size], name)
                    beginning.close()
                read_at, close = _reader(file)
                for number, texts in lines_of_range(read_at, begin, row["block_end"], name, begin > row["body"]):
                    count = len(texts)
                    columns = {
                        "file": pa.array([file] * count, pa.string()),
                        "block_start": pa.array(np.full(count, begin)),
                        "pos": pa.array(np.arange(number, number + count)),
                        "line": pa.array(texts, pa.string()),
                    }
                    if tag:
                        columns[tag] = pa.array(np.full(count, row[tag]))
                    yield pa.RecordBatch.from_pydict(columns)
                close()

    return step


def partition_bytes(spark: SparkSession) -> int:
    """How much of a file one task reads, as the session says; even, so that no UTF-16 unit is cut."""
    size, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return max(2, (int(size) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]) // 2 * 2)


def range_lines(files: DataFrame, tag: str | None = None) -> DataFrame:
    """(file, block_start, pos, line) of files in any of many encodings, cut into ranges.

    ``files`` has file, file_size, encoding and ``skip``, the lines with text to leave out at the
    top. A range is read by one task, a long file by many (a compressed one by one); a line
    belongs to the range it begins in. The same files give the same places on every reading.
    ``tag`` names a number of each file that comes along with its lines.
    """
    spark = files.sparkSession
    size = partition_bytes(spark)
    placed = with_beginning(
        files.where("file_size > 0").select("file", "file_size", "encoding", "skip", *([tag] if tag else [])),
        "body",
        "bigint",
        pa.int64(),
        lambda beginning, row: beginning.body(row["encoding"], row["skip"]),
    )
    whole = F.col("file").rlike(_INFLATED.pattern) | F.lower("file").endswith(".deflate")
    last = F.when(whole, F.col("body")).otherwise(F.greatest(F.col("file_size") - 1, F.col("body")))
    begins = F.sequence(F.col("body"), last, F.lit(size).cast("bigint"))
    end = F.when(whole, F.lit((1 << 63) - 1)).otherwise(F.col("block_start") + size)
    ranges = placed.withColumn("block_start", F.explode(begins)).withColumn("block_end", end)
    count, total = files.agg(
        F.coalesce(F.sum(F.ceil(F.col("file_size") / size)), F.lit(0)), F.coalesce(F.sum("file_size"), F.lit(0))
    ).first()
    parts = max(1, min(count, max(tasks_for_small_work(spark), -(-total // size))))
    ranges = ranges.drop("file_size", "skip").repartition(parts)
    return ranges.mapInArrow(_lines_step(tag), f"{LINES}, {tag} bigint" if tag else LINES)
