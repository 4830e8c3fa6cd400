"""Shards cut from the order of a Hilbert curve over metadata.

Each metadata dimension is quantised to the same number of bits; the cells are numbered along a
Hilbert curve, whose neighbours differ in one dimension by one step. Rows sorted by that number
and cut into runs of equal length give shards that are narrow in every dimension at once, so a
reader that filters on any of them skips most files.

Defined results: a null or empty text has size 16; null metadata sorts in the first cell of its
dimension; equal texts of one cell stand together, then rows go by ``doc_id``, null first;
repeated rows get different slots; of a very long text only size and checksum go on; an empty
table gives an empty result; other columns are neither read nor returned.

Shape: texts are read once, to a staged table of narrow rows. One range partitioning orders it
(the key ends in the document's id and a hash, so no cell and no copied text overfills a task);
a row's rank is its place in its partition plus the rows of earlier partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.llm.staging import staged

BITS = 5
SHARDS = 40
_PLACE_BITS = 33  # of monotonically_increasing_id


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Number of a cell along the Hilbert curve; each coordinate is an int below 2**bits.

    The coordinates are turned into the curve's transposed index one bit and one dimension at
    a time (a fold over the steps, so the expression stays small), Gray-decoded, and their bits
    interleaved.
    """
    n = len(cells)
    # Axes to transposed index: for every bit from the highest, and every dimension.
    steps = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(d).alias("d")) for b in range(bits - 1, 0, -1) for d in range(n)))
    one = F.lit(1)

    def turn(x: Column, step: Column) -> Column:
        low = F.call_function("shiftleft", one, step["b"]) - 1
        mine = F.get(x, step["d"])
        set_ = F.call_function("shiftright", mine, step["b"]).bitwiseAND(one) == 1
        swap = F.get(x, F.lit(0)).bitwiseXOR(mine).bitwiseAND(low)
        first = F.get(x, F.lit(0)).bitwiseXOR(F.when(set_, low).otherwise(swap))
        return F.transform(
            x,
            lambda v, i: F.when(i == 0, first)
            .when((i == step["d"]) & ~set_, v.bitwiseXOR(swap))
            .otherwise(v),
        )

    axes = F.aggregate(steps, F.array(*(c.cast("int") for c in cells)), turn)
    # Gray code: each coordinate takes in the one before it.
    gray = F.aggregate(
        F.sequence(F.lit(0), F.lit(n - 1)),
        F.struct(axes.alias("x"), F.array().cast("array<int>").alias("out")),
        lambda a, i: F.struct(
            a["x"].alias("x"),
            F.concat(
                a["out"],
                F.array(F.get(a["x"], i).bitwiseXOR(F.coalesce(F.get(a["out"], i - 1), F.lit(0)))),
            ).alias("out"),
        ),
        lambda a: a["out"],
    )
    # What the last coordinate's bits flip in all of them.
    fixed = F.transform(
        F.array(gray),
        lambda g: F.transform(
            g,
            lambda v: v.bitwiseXOR(
                F.aggregate(
                    F.sequence(F.lit(bits - 1), F.lit(1), F.lit(-1)),
                    F.lit(0),
                    lambda t, b: F.when(
                        F.call_function("shiftright", F.get(g, F.lit(n - 1)), b).bitwiseAND(one) == 1,
                        t.bitwiseXOR(F.call_function("shiftleft", one, b) - 1),
                    ).otherwise(t),
                )
            ),
        ),
    )[0]
    bit = lambda v, b: F.call_function("shiftright", v, b).bitwiseAND(one).cast("long")
    return F.aggregate(
        F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)),
        F.struct(fixed.alias("x"), F.lit(0).cast("long").alias("h")),
        lambda a, b: F.struct(
            a["x"].alias("x"),
            F.aggregate(a["x"], a["h"], lambda h, v: F.call_function("shiftleft", h, F.lit(1)) + bit(v, b)).alias("h"),
        ),
        lambda a: a["h"],
    )


def quantise(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """The cell of a column's value, by quantiles of the column for numbers.

    The 2**bits - 1 cut points come from one approximate quantile pass; the cell is the number
    of cut points below the value.
    """
    n = 1 << bits
    shares = [i / n for i in range(1, n)]
    cuts = df.agg(F.percentile_approx(column, shares, 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    points = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<bigint>")
    return F.coalesce(F.size(F.filter(points, lambda c: c < F.col(column))), F.lit(0))


def label_cell(column: str, bits: int = BITS) -> Column:
    """The cell of a label: a hash, so equal labels share a cell; null is cell 0."""
    return F.when(F.col(column).isNull(), 0).otherwise(
        (F.pmod(F.xxhash64(column), F.lit((1 << bits) - 1)) + 1).cast("int")
    )


def curve_shards(
    rows: DataFrame, cells: dict[str, Column], ties: list[str], shards: int = SHARDS, bits: int = BITS
) -> DataFrame:
    """``rows`` with curve, shard and slot: runs of equal length (at most one row apart).

    Rows go by curve index, then by the columns ``ties``, which should tell rows apart.
    """
    spread = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns))
    ordered = (
        rows.withColumn("curve", hilbert_index(list(cells.values()), bits))
        .withColumn("_spread", spread)
        .repartitionByRange(F.col("curve"), *ties, F.col("_spread"))
        .sortWithinPartitions("curve", *ties, "_spread")
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_spread")
    )
    placed = staged(ordered, "curve-order")  # fixes the places
    part = F.shiftright("_at", _PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per partition of the range partitioning.
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_all"),
    )
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    ranked = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_rank", rank)
    # Shard s holds the ranks from ceil(s * all / shards) on.
    shard = F.expr(f"(_rank * {shards}) div _all")
    first = F.expr(f"((_rank * {shards}) div _all * _all + {shards - 1}) div {shards}")
    return ranked.select(
        *rows.columns,
        "curve",
        shard.cast("int").alias("shard"),
        (F.col("_rank") - first).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Shards of documents by source, language and size: doc_id, size, text_crc32, lang, source, curve, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    rows = staged(narrow, "curve-rows")
    cells = {
        "source": label_cell("source", bits),
        "lang": label_cell("lang", bits),
        "size": quantise(rows, "size", bits),
    }
    return curve_shards(rows, cells, ["size", "text_crc32", "doc_id"], shards, bits)


def shard_ranges(sharded: DataFrame) -> DataFrame:
    """What a reader prunes by: rows, sizes, languages and sources of each shard."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.min("lang").alias("min_lang"),
        F.max("lang").alias("max_lang"),
        F.min("source").alias("min_source"),
        F.max("source").alias("max_source"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows as Parquet, one folder per shard, in curve order inside it."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
