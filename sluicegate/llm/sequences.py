"""Training order on disk: a keyed permutation gives every sequence a global slot.

Documents are tokenised and cut into sequences of a fixed length, the last one padded. The
sequences are numbered from 0 without gaps, and a keyed Feistel permutation of these numbers
gives each its slot in training order, without sorting by random numbers and without a table:
the slot of a sequence, and the sequence of a slot, can be computed by anyone with the key.
Slots are cut into shards of equal length; a shard is one raw file of its sequences' ids in slot
order, the same number of bytes for every sequence, so reading can stop after any slot and go on
there by seeking. An index of what stands in each slot lies beside the shards, as Parquet. A shard
appears under its name only when it is whole.

Defined results: a null or empty text is one sequence with its end token; repeated rows are
sequences of their own; an empty table gives no sequence; a null ``doc_id`` stays null; a very long
text is as many sequences as its tokens fill; other columns are neither read nor returned.

Shape: texts are tokenised once, to a staged table; numbering needs the row counts of its
partitions only. Token ids cross the network once, to one partition per shard; these are even
because slots are dense. Shards are written in a few waves (``WAVES``), and the shuffle of a wave
goes when its shards are written, so little of it stands beside the last of them; each wave reads
the staged table. Shards are written by the workers to a folder that all of them reach
(``staging.file_system``).
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.llm import tokens
from sluicegate.llm.packing import batches_by_bytes
from sluicegate.llm.staging import arrow_map, drop_staged, file_system, staged
from sluicegate.llm.words import mix

LENGTH = 512
PER_SHARD = 8192
ROUNDS = 6
#: Shares of the shards that are written after each wave: the later a wave, the fewer shards it shuffles.
WAVES = (0.5, 0.8, 1.0)
_PLACE_BITS = 33


def feistel(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..size-1, applied to ``numbers``.

    A number is split into two digits, to the bases a and b with a * b >= size, and each round
    adds a keyed hash of one digit to the other. Results beyond the size go through the
    permutation again (cycle-walking), which ends inside because it began inside.
    """
    a = max(1, int(np.ceil(np.sqrt(size))))
    b = -(-size // a) or 1
    out = numbers.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        high, low = out[todo] // np.uint64(b), out[todo] % np.uint64(b)
        for r in range(ROUNDS):
            salt = np.uint64((key * 1_000_003 + r * 0x9E3779B97F4A7C15) % 2**64)
            if r % 2:
                low = (low + mix(high ^ salt) % np.uint64(b)) % np.uint64(b)
            else:
                high = (high + mix(low ^ salt) % np.uint64(a)) % np.uint64(a)
        out[todo] = high * np.uint64(b) + low
        todo = out >= size
    return out.astype(np.int64)


def cut_sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """doc_id, part (of its document), n_tokens and ids: ``length`` numbers of ``tokens.id_type``."""
    kind = tokens.id_type(vocabulary)
    stride = np.dtype(kind).itemsize * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                flat, before = tokens.encode(batch.column("text"), vocabulary)
                n = np.diff(before) + 1
                parts = -(-n // length)
                row = np.repeat(np.arange(len(n)), parts)
                part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                wide = np.zeros(len(row) * length, kind)
                first = (np.cumsum(parts) - parts) * length
                wide[np.arange(len(flat)) + np.repeat(first - before[:-1], n - 1)] = flat
                wide[first + n - 1] = tokens.END
                ids = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(stride), len(row), [None, pa.py_buffer(wide)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row)).cast(pa.int64()),
                        pa.array(part, pa.int32()),
                        pa.array(np.minimum(n[row] - part * length, length), pa.int32()),
                        ids.cast(pa.binary()),
                    ],
                    ["doc_id", "part", "n_tokens", "ids"],
                )

    return arrow_map(
        docs.select("doc_id", F.col("text").cast("string").alias("text")),
        cut,
        "doc_id long, part int, n_tokens int, ids binary",
    )


def assign_slots(rows: DataFrame, key: int = 0) -> DataFrame:
    """``rows`` (a staged table with ``_at``) with their dense ``number`` and their ``slot``."""
    part = F.shiftright("_at", _PLACE_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per partition that wrote the table.
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_all"),
    )
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    numbered = numbered.select(*(c for c in rows.columns if c != "_at"), number.alias("number"), "_all")

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                slot = feistel(batch.column("number").to_numpy(), batch.column("_all")[0].as_py(), key)
                arrays = [*batch.columns[:-1], pa.array(slot, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "slot"])

    kept = [f"`{c}` {t}" for c, t in numbered.dtypes if c != "_all"]
    return arrow_map(numbered, permute, ", ".join([*kept, "slot long"]))


def training_order(
    docs: DataFrame, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = 0, vocabulary: str = tokens.VOCABULARY
) -> DataFrame:
    """Every sequence at its place: doc_id, part, n_tokens, ids, number, slot, shard, offset.

    ``offset`` is the first byte of the sequence in its shard. A partition is a shard, sorted by
    slot. The result keeps how to make some of its shards only, for ``write_order``.
    """
    cut = cut_sequences(docs, length, vocabulary).withColumn("_at", F.monotonically_increasing_id())
    rows = staged(cut, "sequences", "zstd")
    shards = max(1, -(-rows.count() // per_shard))
    placed = assign_slots(rows, key)
    stride = np.dtype(tokens.id_type(vocabulary)).itemsize * length
    placed = placed.withColumn("shard", F.expr(f"slot div {per_shard}").cast("int")).withColumn(
        "offset", F.col("slot") % per_shard * stride
    )
    ordered = deal(placed, 0, shards)
    ordered.placed, ordered.shards = placed, shards
    return ordered


def deal(placed: DataFrame, first: int, last: int) -> DataFrame:
    """The shards from ``first`` to before ``last``, each a partition sorted by slot."""
    some = placed.where(F.col("shard").between(first, last - 1))
    return some.repartitionById(last - first, F.col("shard") - first).sortWithinPartitions("slot")


def shard_file(folder: str, shard: int) -> str:
    return f"{folder}/shards/{shard:08d}.ids"


def write_order(ordered: DataFrame, path: str) -> DataFrame:
    """Write the shards and the index of ``training_order``; returns the index, without ids."""
    kept = [c for c in ordered.columns if c != "ids"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = file_system(path)
        files.create_dir(f"{folder}/shards", recursive=True)
        shard = out = temporary = None
        size = 0

        def close() -> None:
            out.close()
            files.move(temporary, shard_file(folder, shard))

        for batch in batches:
            if not batch.num_rows:
                continue
            shards, offsets = (batch.column(c).to_numpy() for c in ("shard", "offset"))
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            ids = batch.column("ids")
            for a, b in zip(cuts, cuts[1:], strict=False):
                if shards[a] != shard:
                    if out:
                        close()
                    shard, size = int(shards[a]), 0
                    temporary = f"{folder}/shards/_{shard:08d}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(temporary, compression=None)
                data = b"".join(ids.slice(a, b - a).to_pylist())
                stride = len(data) // (b - a)
                if (offsets[a:b] != size + stride * np.arange(b - a)).any():
                    raise ValueError(f"shard {shard}: sequences out of place")
                out.write(data)
                size += len(data)
            columns = [batch.column(c) for c in kept]
            stride = pa.array(pc.binary_length(ids), pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, stride], [*kept, "stride"])
        if out:
            close()

    schema = ", ".join(f"`{c}` {t}" for c, t in ordered.dtypes if c != "ids") + ", stride int"
    cuts = sorted({0, *(math.ceil(ordered.shards * share) for share in WAVES)})
    waves = [
        staged(arrow_map(deal(ordered.placed, a, b), write, schema), "order-index")
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    index = reduce(DataFrame.union, waves)
    index.write.parquet(f"{path}/index")
    drop_staged(*waves)
    return ordered.sparkSession.read.schema(index.schema).parquet(f"{path}/index")


def read_shards(wanted: DataFrame, path: str, columns: str, value) -> DataFrame:
    """``wanted`` (with shard, offset and stride) and a column made by ``value`` of each sequence's bytes.

    ``columns`` names and types all columns of the result.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = file_system(path)
        shard = source = None
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "stride")), strict=True)
            found = []
            for at, offset, stride in places:
                if at != shard:
                    if source:
                        source.close()
                    shard, source = at, files.open_input_file(shard_file(folder, at))
                source.seek(offset)
                data = source.read(stride)
                if len(data) != stride:
                    raise ValueError(f"shard {at} ends before byte {offset + stride}")
                found.append(value(data))
            names = [c.split()[0] for c in columns.split(", ")]
            kind = pa.binary() if columns.endswith("binary") else pa.int64()
            arrays = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, kind)], names)
        if source:
            source.close()

    return arrow_map(wanted, read, columns)


def checksums(index: DataFrame, path: str) -> DataFrame:
    """The index with ids_crc32, the checksum of each sequence's bytes as they stand in its shard."""
    columns = ", ".join(f"{c} {t}" for c, t in index.dtypes)
    return read_shards(index, path, f"{columns}, ids_crc32 bigint", zlib.crc32).drop("stride")


def read_from(spark: SparkSession, path: str, slot: int, count: int, per_shard: int = PER_SHARD) -> DataFrame:
    """slot, shard, offset and ids of ``count`` slots from ``slot`` on, by seeking in their shards."""
    index = spark.read.parquet(f"{path}/index")
    one = index.select("stride").first()
    stride = one[0] if one else 0
    end = min(slot + count, index.count())
    places = spark.range(slot, max(slot, end), 1, max(1, -(-count // per_shard))).select(
        F.col("id").alias("slot"),
        F.expr(f"id div {per_shard}").cast("int").alias("shard"),
        (F.col("id") % per_shard * stride).alias("offset"),
        F.lit(stride).alias("stride"),
    )
    ids = read_shards(places, path, "slot bigint, shard int, offset bigint, ids binary", bytes)
    return ids.orderBy("slot")
