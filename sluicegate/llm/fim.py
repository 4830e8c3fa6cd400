"""Fill-in-the-middle texts, put together from pieces by a secondary sort.

Every text is cut at two places drawn from its id and emitted as pieces of at most ``chunk``
code points, keyed by document and by place in the output. Repartitioned by document and sorted
within partitions by place (``repartitionAndSortWithinPartitions``, in its DataFrame form), the
pieces of a document stream into a digest or a new text. Restoring reads the output only: the
sentinels in it say which part a piece belongs to, the pieces get the place that part has in the
source, and are sorted within their partition once more, without a second shuffle.

Defined results: a null text is empty, and an empty text stays plain; a null id is hashed as
``-``; very long texts are cut into pieces like all others, and sorts spill, so that a digest
never holds more than a batch of pieces (the new text of :func:`assemble` is a row, like its
source); repeated rows and rows that share an id are documents of their own, also on a retry,
because a document is known by its content, its input partition and its count there; an empty
table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sluicegate.llm.staging import arrow_map

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: The parts in the order they have in the source, and in the output by form.
SOURCE_ORDER = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
HEAD = -1  # the part of a document's own row, before its pieces


@dataclass(frozen=True)
class Plan:
    """How often texts are transformed, and how pieces are cut."""

    percent: int = 90  # of the texts that may be
    spm_percent: int = 20  # of those, with the suffix first
    seed: str = "1"
    chunk: int = 8192  # code points of a piece


def cut(doc_id: int | None, text: str, plan: Plan) -> tuple[str, int | None, int | None]:
    """The form of a text, and where its prefix and its middle end."""
    name = "-" if doc_id is None else str(doc_id)
    drawn = hashlib.sha256(f"{plan.seed}:{name}".encode()).hexdigest()
    one, two, keep, order = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or keep % 100 >= plan.percent or any(s in text for s in SENTINELS):
        return "plain", None, None
    first, last = sorted((one % (len(text) + 1), two % (len(text) + 1)))
    return "spm" if order % 100 < plan.spm_percent else "psm", first, last


def output_pieces(text: str, form: str, first: int | None, last: int | None, chunk: int) -> Iterator[tuple[int, str]]:
    """The output in order, as (place, piece); a part's first piece begins with its sentinel."""
    if form == "plain":
        parts = [("", 0, len(text))]
    else:
        spans = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, len(text))}
        parts = [(s, *spans[s]) for s in FORMS[form]]
    place = 0
    for sentinel, begin, end in parts:
        lead = sentinel
        for at in range(begin, max(end, begin + 1), chunk):
            piece = lead + text[at : min(at + chunk, end)]
            yield place, piece
            place += len(piece)
            lead = ""


HEAD_COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"document binary, place long, piece string, {HEAD_COLUMNS}"
RETURNED = f"document binary, part int, place long, piece string, {HEAD_COLUMNS}, output_sha256 string"
NO_HEAD = (None,) * 5
ROWS_AT_ONCE = 1000


def _types(schema: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(","))])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    types, rows = _types(schema), iter(rows)
    while some := list(islice(rows, ROWS_AT_ONCE)):
        columns = [pa.array(values, kind) for values, kind in zip(zip(*some, strict=True), types.types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=types)


def pieces(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """All pieces: document, place in the output, piece; the first of a document has its head as well."""

    def emitted(rows: Iterable[tuple]) -> Iterator[tuple]:
        partition = TaskContext.get().partitionId().to_bytes(4, "big")
        seen: dict[bytes, int] = {}
        for doc_id, text in rows:
            text = text or ""
            content = hashlib.blake2b(f"{doc_id}:".encode() + text.encode(), digest_size=16).digest()
            seen[content] = count = seen.get(content, -1) + 1
            document = content + partition + count.to_bytes(6, "big")
            form, first, last = cut(doc_id, text, plan)
            head = doc_id, len(text), form, first, None if form == "plain" else last - first
            for place, piece in output_pieces(text, form, first, last, plan.chunk):
                yield document, place, piece, *(NO_HEAD if place else head)

    return arrow_map(docs.select("doc_id", "text"), lambda batches: _batches(emitted(_rows(batches)), PIECES), PIECES)


def in_order(found: DataFrame) -> DataFrame:
    """Pieces side by side with those of their document, in order of place."""
    return found.repartition("document").sortWithinPartitions("document", "place")


def documents_of(rows: Iterable[tuple]) -> Iterator[tuple[bytes, tuple, Iterator[tuple]]]:
    """(document, first row, all rows) of a sorted stream; rows must be read before the next document."""
    for document, group in groupby(rows, key=lambda row: row[0]):
        first = next(group)
        yield document, first, _again(first, group)


def _again(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield first
    yield from rest


def source_places(rows: Iterable[tuple]) -> Iterator[tuple]:
    """From the output of every document, in order: its pieces at their places in the source.

    A head row before them has the digest of the output. Which part a piece belongs to is read
    from the sentinels; a transformed text holds them nowhere else.
    """
    for document, first, output in documents_of(rows):
        digest, head = hashlib.sha256(), first[3:]
        part, transformed = 0, head[2] != "plain"
        for _, at, piece, *_ in output:
            digest.update(piece.encode())
            if transformed and piece[:3] in SOURCE_ORDER:
                part, piece = SOURCE_ORDER[piece[:3]], piece[3:]
            yield document, part, at, piece, *NO_HEAD, None
        yield document, HEAD, 0, None, *head, digest.hexdigest()


def there_and_back(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Every document's head and its pieces in source order, read from its output."""
    returned = arrow_map(
        in_order(pieces(docs, plan)), lambda batches: _batches(source_places(_rows(batches)), RETURNED), RETURNED
    )
    return returned.sortWithinPartitions("document", "part", "place")


def _per_document(stream: DataFrame, made, schema: str) -> DataFrame:
    """One row per document of a sorted stream, by ``made`` of its first row and all of its rows."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((made(first, rows) for _, first, rows in documents_of(_rows(batches))), schema)

    return arrow_map(stream, step, schema)


def assemble(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Every document's training text: doc_id, n, form, prefix_chars, middle_chars, output."""

    def joined(first: tuple, rows: Iterator[tuple]) -> tuple:
        return *first[3:], "".join(row[2] for row in rows)

    return _per_document(in_order(pieces(docs, plan)), joined, f"{HEAD_COLUMNS}, output string")


def restored(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Every document's text as it is read back from its output: doc_id, form, text."""

    def joined(first: tuple, rows: Iterator[tuple]) -> tuple:
        return first[4], first[6], "".join(row[3] for row in rows if row[1] != HEAD)

    return _per_document(there_and_back(docs, plan), joined, "doc_id long, form string, text string")


def digests(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Every document's form, its cuts, and digests of its output and of the text read back from it."""

    def hashed(first: tuple, rows: Iterator[tuple]) -> tuple:
        digest = hashlib.sha256()
        for row in rows:
            if row[1] != HEAD:
                digest.update(row[3].encode())
        return *first[4:], digest.hexdigest()

    schema = f"{HEAD_COLUMNS}, output_sha256 string, restored_sha256 string"
    return _per_document(there_and_back(docs, plan), hashed, schema)
