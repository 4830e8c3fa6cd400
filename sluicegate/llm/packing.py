"""Packing documents into sequences: first-fit decreasing with a tournament tree.

A document's tokens, closed by an end token, are cut into pieces of the sequence length and a
rest. Full pieces are sequences by themselves. The rests of a random group of documents are
packed by first-fit decreasing: longest first, each into the first sequence with room, which a
tournament tree over the room left finds in logarithmic time.

Defined results: a null or empty text is its end token alone; repeated rows are packed one by
one; a very long text is cut into full sequences and a rest; an empty table gives an empty result;
other columns are neither read nor returned.

Shape: texts are tokenised where they are read; only one narrow row per piece is shuffled, to
groups of about ``group_size`` documents, so a task never holds more than a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm import tokens
from sluicegate.llm.staging import arrow_groups, arrow_map

LENGTH = 1024
GROUP_SIZE = 2048
BATCH_BYTES = 4 << 20
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Tournament:
    """Room left in a growing list of bins; finds the first bin with enough of it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.best = [room] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size``, and the room it had; the room is then less."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        had = best[node]
        best[node] = had - size
        found = node - self.leaves
        while node > 1:
            node //= 2
            left, right = best[2 * node], best[2 * node + 1]
            best[node] = left if left >= right else right
        return found, had


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; no item is larger than ``room``. Ties keep their order."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree = Tournament(len(sizes), room)
    for i in np.argsort(-sizes, kind="stable").tolist():
        bins[i], had = tree.take(int(sizes[i]))
        offsets[i] = room - had
    return bins, offsets


def batches_by_bytes(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text; a longer text is a part by itself."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size.astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def token_pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str = tokens.VOCABULARY, keep_ids: bool = False):
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked, ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                flat, before = tokens.encode(batch.column("text"), vocabulary)
                n = np.diff(before) + 1
                pieces = -(-n // length)
                row = np.repeat(np.arange(len(n)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
                size = np.minimum(n[row] - start, length)
                # With the end tokens put in, text i begins i places later.
                closed = np.zeros(len(flat) + len(n), "<u4")
                closed[np.arange(len(flat)) + np.repeat(np.arange(len(n)), n - 1)] = flat
                closed[before[1:] + np.arange(len(n))] = tokens.END
                a = (before[:-1] + np.arange(len(n)))[row] + start
                view = memoryview(closed.tobytes())
                spans = list(zip((a * 4).tolist(), ((a + size) * 4).tolist(), strict=True))
                arrays = [
                    batch.column("doc_id").take(pa.array(row)).cast(pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array([zlib.crc32(view[x:y]) for x, y in spans], pa.int64()),
                    pa.array(n[row], pa.int64()),
                ]
                if keep_ids:
                    ends = np.append(np.cumsum(size) - size, size.sum()).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(closed.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    schema = _PIECES + (", ids array<int>" if keep_ids else "")
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), cut, schema)


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    group_size: int = GROUP_SIZE,
    seed: int = 0,
    vocabulary: str = tokens.VOCABULARY,
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids). A
    sequence id holds the number of its group above bit 32.
    """
    groups = max(1, -(-docs.select(F.lit(1)).count() // group_size))
    pieces = token_pieces(docs, length, vocabulary, keep_ids)
    # All pieces of a document share a group; its length spreads texts that share an id.
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "doc_tokens"), F.lit(groups))
    names_ = [*pieces.columns, "sequence_id", "offset"]

    def fill(table: pa.Table) -> pa.Table:
        number = table.column("group")[0].as_py()
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), length)
        table = table.drop_columns(["group"])
        table = table.append_column("sequence_id", pa.array((number << 32) + bins, pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64())).select(names_)

    kinds = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return arrow_groups(pieces.withColumn("group", group), ["group"], fill, kinds)
