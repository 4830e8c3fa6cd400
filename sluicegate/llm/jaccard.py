"""Join of texts whose word shingles are similar, by adaptive multi-match prefixes.

A text is the set of its shingles (runs of ``words`` words), each named by a hash. In any fixed
order of names, two sets whose Jaccard similarity reaches the threshold share at least l of the
first n - need + l names of either, for every l: the more names of a set are looked at, the
more must be shared. Two lengths of prefix are tried per text (``GROWTH``). From the names
that only one text has among its prefix, a text is dropped that shares too few at any length;
for the others, the most frequent names of a prefix, which may all be among the l - 1 spare
ones, need not be probed. A text probes with the length for which the texts to compare with are
fewest, by the frequencies counted over all texts. The smaller of two similar sets holds at
least the threshold's share of the larger one's number of names, so a name counts for a text only
if a text of such a size has it too.

What probes find is verified exactly. Texts that meet are collected into classes, classes by size
into chunks of bounded size, and each pair of chunks that holds a candidate pair is compared as a
whole by products of incidence matrices, so a group of copies costs no row per pair, each pair
of texts is compared once, and no link is lost. A text goes to another chunk only if one that it
meets there may be similar by its size.

Defined results: texts of equal sets (exact copies) are one node, compared once; a text with
fewer words than a shingle is one shingle of all its words; a null, empty or blank text has no
shingle, no link and its own id as component; a null ``doc_id`` counts as larger than all
others and gives a null component only if nothing in it has an id; rows that share an id are
nodes of their own; an empty table gives an empty result; other columns are neither read nor
returned (``keep_one`` returns them as they were). A very long text is a large set: it is held
whole where its shingles are named and where it is compared, about 60 bytes a word.

Names have 64 bits: two different shingles are taken for one with a chance of 2**-64 a pair.

Shape: texts are read twice; the second time those to compare are shuffled once by id, others
fall out before that, but for the few whose bit in a table of fixed size (``PLACES``) is set too.
Prefix names travel as packed arrays, by name; only names that two texts share become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.llm.packing import batches_by_bytes
from sluicegate.llm.staging import arrow_groups, arrow_map, drop_staged, shuffle_partitions, staged
from sluicegate.llm.substrings import NULL_ID, Ranges
from sluicegate.llm.words import Words, find_words, mix

WORDS = 5
PERCENT = 80
#: l grows by these shares of a set's size: the lengths of prefix.
GROWTH = (0.0, 0.08)
#: Names in a chunk of texts that are compared in one task, about.
CHUNK = 1 << 18
#: Sets in such a chunk, about: bounds the table of pairs of two chunks, however short the sets are.
SETS = 2048
#: Rows of that table that are made at once.
ROWS = 512
#: Rows of 64 bits in the table that tells most texts apart from those to compare.
PLACES = 1 << 18


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least number of names that a set of n shares with any set similar to it."""
    return -(-percent * n // 100)


def matches(n: np.ndarray, level: int) -> np.ndarray:
    """l for sets of n names at a level."""
    return 1 + np.floor(GROWTH[level] * n).astype(np.int64)


def prefix_length(n: np.ndarray, level: int, percent: int) -> np.ndarray:
    return np.minimum(n, n - needed(n, percent) + matches(n, level))


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all texts of a batch, in order within each, and the bounds of the texts."""
    ranges = Ranges(words.name)
    count = np.diff(words.bounds)
    room = np.repeat(words.bounds[1:], count) - np.arange(len(words.name))
    first = np.flatnonzero(room >= size)
    short = np.flatnonzero((count > 0) & (count < size))
    owner = np.append(np.searchsorted(words.bounds, first, side="right") - 1, short)
    name = np.append(ranges.name(first, first + size), ranges.name(words.bounds[short], words.bounds[short + 1]))
    order = np.lexsort((name, owner))
    owner, name = owner[order], name[order]
    new = np.ones(len(name), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])
    owner, name = owner[new], name[new]
    return name, np.searchsorted(owner, np.arange(len(words) + 1))


def set_signatures(name: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    sums = np.append(np.uint64(0), np.cumsum(mix(name + np.uint64(5)), dtype=np.uint64))
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def _batches(batches: Iterator[pa.RecordBatch], words: int, lower: bool):
    for whole in batches:
        for batch in batches_by_bytes(whole, "text"):
            yield batch, *shingle_sets(find_words(batch.column("text"), lower), words)


def scan(docs: DataFrame, words: int, percent: int, lower: bool) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, node (name of its set), n, and the longest prefix."""
    top = len(GROWTH) - 1

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, name, bounds in _batches(batches, words, lower):
            n = np.diff(bounds)
            length = prefix_length(n, top, percent)
            at = np.arange(len(name)) - np.repeat(bounds[:-1], n)
            prefix = name[at < np.repeat(length, n)].view(np.int64)
            cuts = np.append(0, np.cumsum(length)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("text_hash"),
                    pa.array(set_signatures(name, bounds).view(np.int64)),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(prefix)),
                ],
                ["id", "text_hash", "node", "n", "prefix"],
            )

    return arrow_map(_keyed(docs), step, "id long, text_hash long, node long, n long, prefix array<long>")


def shared_names(scanned: DataFrame, percent: int) -> DataFrame:
    """node, n, name, level (of the shortest prefix that has it) and df, for names that a node of a similar size has too."""
    buckets = 4 * shuffle_partitions(scanned.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            name = prefix.flatten().to_numpy(zero_copy_only=False)
            size = prefix.value_lengths().to_numpy(zero_copy_only=False)
            n = np.repeat(batch.column("n").to_numpy(), size)
            at = np.arange(len(name)) - np.repeat(np.cumsum(size) - size, size)
            level = sum((at >= prefix_length(n, k, percent)).astype(np.int64) for k in range(len(GROWTH)))
            node = np.repeat(batch.column("node").to_numpy(), size)
            bucket = (mix(name.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) > 0)) if len(order) else order
            ends = np.append(cuts[1:], len(order))
            columns = [x[order] for x in (name, node, (n * 4 + level).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[order][cuts], pa.int64()),
                    *(pa.array([c[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()) for c in columns),
                ],
                ["bucket", "name", "node", "info"],
            )

    def count(table: pa.Table) -> pa.Table:
        kinds = {"name": np.int64, "node": np.int64, "info": np.int32}
        name, node, info = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in kinds.items())
        info = info.astype(np.int64)
        order = np.lexsort((node, info // 4, name))
        name, node, info = name[order], node[order], info[order]
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (node[1:] != node[:-1])  # rows of one set count once
        name, node, info = name[new], node[new], info[new]
        first = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else order
        size = np.diff(np.append(first, len(name)))
        df = np.repeat(size, size)
        # Of all sizes that have a name, those next to a size are nearest to it.
        n = info // 4
        near = (name[1:] == name[:-1]) & (100 * n[:-1] >= percent * n[1:])
        keep = np.zeros(len(name), dtype=bool)
        keep[1:] |= near
        keep[:-1] |= near
        columns = [node[keep], info[keep] // 4, name[keep], info[keep] % 4, df[keep]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["node", "n", "name", "level", "df"])

    packed = arrow_map(scanned.select("node", "n", "prefix"), pack, "bucket long, name binary, node binary, info binary")
    return arrow_groups(packed, ["bucket"], count, "node long, n long, name long, level long, df long")


def probes(shared: DataFrame, percent: int) -> DataFrame:
    """level, name, node, n, asks: what each node is found by at every level, and at which one it asks."""
    parts = 4 * shuffle_partitions(shared.sparkSession)
    schema = "level long, name long, node long, n long, asks boolean"

    def choose(table: pa.Table) -> pa.Table:
        node, n, name, level, df = (table.column(c).to_numpy() for c in ("node", "n", "name", "level", "df"))
        order = np.lexsort((name, df, node))
        node, n, name, level, df = node[order], n[order], name[order], level[order], df[order]
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else order
        which = np.cumsum(np.append(True, node[1:] != node[:-1])) - 1 if len(node) else order
        size = n[first]
        alive = np.ones(len(first), dtype=bool)
        found, costs = [], []
        for k in range(len(GROWTH)):
            inside = level <= k
            before = np.cumsum(inside) - inside
            rank = before - before[first][which]
            count = np.add.reduceat(inside.astype(np.int64), first) if len(first) else first
            # A similar set has at least needed(size) names, and the pair shares l of the smaller.
            least = matches(needed(size, percent), k)
            alive &= count >= least
            used = inside & (rank < (count - least + 1)[which])
            found.append(used)
            costs.append(np.add.reduceat(np.where(used, df - 1, 0), first) if len(first) else first)
        best = np.argmin(np.stack(costs), axis=0) if len(first) else first
        out = []
        for k, used in enumerate(found):
            at = np.flatnonzero(used & alive[which])
            out.append((np.full(len(at), k), name[at], node[at], n[at], best[which[at]] == k))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        names = [c.split()[0] for c in schema.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    rows = shared.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(parts)))
    return arrow_groups(rows, ["part"], choose, schema)


def chunk_pairs(found: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(nodes with their chunk, pairs of chunks (a, b) with the nodes to compare in each).

    A node's label is the least node that it or what it meets has met; the nodes of a label are
    dealt to chunks by size: bands of like sizes are put together up to what a chunk holds, and a larger band is
    dealt to as many as its names or its number fill. Every node is compared inside its chunk, and in a pair of
    chunks if it meets a node of the other chunk, of a size that may be similar, at a name that one of them asks for.
    """
    at = ["level", "name"]
    groups = found.groupBy(*at).agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c"), F.max("asks").alias("asked"))
    groups = groups.where("c > 1 AND asked").select(*at, "hub")
    meeting = staged(found.join(groups, at), "jaccard-meeting")
    # A node has no more rows than its longest prefix has names, at two levels.
    near = F.min("hub").over(Window.partitionBy("node"))
    hubs = meeting.select(*at, near.alias("near")).groupBy(*at).agg(F.min("near").alias("far"))
    labels = meeting.select(*at, "node", "n").join(hubs, at).groupBy("node").agg(F.min("far").alias("label"), F.max("n").alias("n"))
    labels = labels.withColumn("band", F.floor(8 * F.log2("n")))
    halves = F.greatest(2 * F.sum("n") / CHUNK, 2 * F.count(F.lit(1)) / SETS)
    bands = labels.groupBy("label", "band").agg(halves.alias("halves"))
    smaller = Window.partitionBy("label").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)  # some 200 bands at most
    before = F.coalesce(F.sum("halves").over(smaller), F.lit(0.0))
    bands = bands.select(
        "label",
        "band",
        F.floor(before).alias("place"),
        F.when(F.col("halves") > 1, F.col("band")).otherwise(-1).alias("alone"),
        F.ceil(F.col("halves") / 2).alias("chunks"),
    )
    chunk = F.xxhash64("label", "place", "alone", F.pmod(F.xxhash64("node"), "chunks"))
    nodes = staged(labels.join(bands, ["label", "band"]).select("node", chunk.alias("chunk")), "jaccard-nodes")
    placed = staged(meeting.select(*at, "node", "n", "asks").join(nodes, "node"), "jaccard-placed")
    drop_staged(meeting)
    sizes = [F.min("n").alias("lo"), F.max("n").alias("hi")]
    by_chunk = placed.groupBy(*at, "chunk").agg(F.max("asks").alias("asked"), *sizes)
    # Names that stand in the same chunks are put together before they meet those.
    mark = F.xxhash64("level", F.bit_xor(F.xxhash64("chunk", "asked")), F.count(F.lit(1)))
    marks = by_chunk.groupBy(*at).agg(mark.alias("mark"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    own = placed.join(marks, at).groupBy("mark", "node", "n", "chunk").agg(F.max("asks").alias("asks"))
    other = by_chunk.join(marks, at).groupBy("mark", F.col("chunk").alias("other"), "asked")
    other = other.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    alike = f"{percent} * lo <= 100 * n AND 100 * hi >= {percent} * n"
    across = own.join(other, "mark").where(f"chunk <> other AND (asks OR asked) AND {alike}")
    pairs = across.select(F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "node").distinct()
    pairs = staged(pairs.union(nodes.select("chunk", F.col("chunk"), "node")), "jaccard-pairs")
    drop_staged(placed)
    return nodes, pairs


def local_components(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component, for links a-b among 0..count-1."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def overlaps(name: np.ndarray, owner: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shared names of every two of ``count`` sets, ``ROWS`` sets at a time: (first set, table)."""
    _, column, times = np.unique(name, return_inverse=True, return_counts=True)
    keep = times[column] > 1
    number = np.cumsum(times > 1) - 1
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    for first in range(0, count, ROWS):
        total = np.zeros((min(ROWS, count - first), count), np.float32)
        for cut in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            lo, hi = np.searchsorted(column, [cut, cut + width])
            part = np.zeros((count, min(width, int(column[-1]) + 1 - cut)), np.float32)
            part[owner[lo:hi], column[lo:hi] - cut] = 1
            total += part[first : first + ROWS] @ part.T
        yield first, total


def likely(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``texts`` without most of those that are not ``chosen``, by bits of ``text_hash``."""
    place = F.expr(f"pmod(shiftright(text_hash, 6), {PLACES})").alias("place")
    bit = F.expr("shiftleft(1L, CAST(text_hash & 63 AS int))")
    bits = chosen.groupBy(place).agg(F.bit_or(bit).alias("bits"))
    # PLACES rows at most.
    return texts.select("*", place).join(F.broadcast(bits), "place").where(F.col("bits").bitwiseAND(bit) != 0).drop("place", "bits")


def verify(docs: DataFrame, scanned: DataFrame, classes: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int,
           percent: int, lower: bool) -> DataFrame:
    """node, root, links: links of each node inside each pair of chunks, and its component there."""
    meets = pairs.groupBy("node").agg(F.collect_list(F.struct("a", "b")).alias("meets"))
    chosen = nodes.join(classes, "node").join(meets, "node")
    chosen = chosen.select(F.col("first").alias("id"), "text_hash", "node", "chunk", "size", "meets")
    chosen = staged(chosen, "jaccard-chosen")
    # by id and text: rows without an id, or of one id, meet the sets of their own text only
    texts = likely(_keyed(docs), chosen).join(chosen, ["id", "text_hash"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, name, bounds in _batches(batches, words, lower):
            own = set_signatures(name, bounds).view(np.int64) == batch.column("node").to_numpy()
            packed = [name[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
            kept = [batch.column(c) for c in ("node", "chunk", "size", "meets")]
            made = pa.RecordBatch.from_arrays([*kept, pa.array(packed, pa.binary())], ["node", "chunk", "size", "meets", "names"])
            yield made.filter(pa.array(own))

    members = arrow_map(texts, sets, "node long, chunk long, size long, meets array<struct<a: long, b: long>>, names binary")
    members = members.select("node", "chunk", "size", "names", F.inline("meets"))

    def compare(table: pa.Table) -> pa.Table:
        node, which = np.unique(table.column("node").to_numpy(), return_index=True)
        names = table.column("names").take(pa.array(which)).to_pylist()
        size = table.column("size").to_numpy()[which]
        side = table.column("chunk").to_numpy()[which]
        n = np.array([len(x) // 8 for x in names], np.int64)
        across = table.column("a")[0] != table.column("b")[0]
        links, label = np.zeros(len(n), np.int64), np.arange(len(n))
        for first, both in overlaps(np.frombuffer(b"".join(names), np.uint64), np.repeat(np.arange(len(n)), n), len(n)):
            # Shared names are whole and below 2**24; sums of 64 bits, for the sets that share any.
            i, j = np.nonzero(both)
            shared = both[i, j].astype(np.int64)
            i += first
            linked = (100 * shared >= percent * (n[i] + n[j] - shared)) & (i != j)
            if across:
                linked &= side[i] != side[j]  # pairs inside a chunk are another pair's
            i, j = i[linked], j[linked]
            np.add.at(links, i, size[j])
            every = np.arange(len(n))
            label = local_components(len(n), np.append(i, every), np.append(j, label))
        root = node[label]
        keep = links > 0
        return pa.table([pa.array(x[keep], pa.int64()) for x in (node, root, links)], ["node", "root", "links"])

    return arrow_groups(members, ["a", "b"], compare, "node long, root long, links long")


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component, the least node reachable, for the nodes of all edges.

    Each round every node takes the least label among its own and its neighbours', then the
    label of that label; rounds end when no label changes. Edges are read both ways.
    """
    both = staged(
        edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(b, a)).where("x <> y").distinct(),
        "edges",
    )
    labels = staged(both.groupBy(F.col("x").alias("node")).agg(F.least("x", F.min("y")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(
            F.min("component").alias("near")
        )
        new = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("of_next"))
        new = staged(
            new.join(jump, "next").select("node", "old", F.least("next", "of_next").alias("component")), "labels"
        )
        if new.where("component <> old").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")


def _joined(docs: DataFrame, words: int, percent: int, lower: bool) -> DataFrame:
    """id, text_hash, node, n, component (its least node), least (id of the component) and links of every row of ``docs``."""
    whole = staged(scan(docs, words, percent, lower), "jaccard-scan")
    scanned = staged(whole.drop("prefix"), "jaccard-rows")
    rows = scanned.where("n > 0")
    least = F.min(F.struct("id", "text_hash")).alias("least")
    classes = staged(
        rows.groupBy("node")
        .agg(least, F.count(F.lit(1)).alias("size"))
        .select("node", F.col("least.id").alias("first"), "least.text_hash", "size"),
        "jaccard-classes",
    )
    shared = staged(shared_names(whole.where("n > 0"), percent), "jaccard-shared")
    drop_staged(whole)
    found = staged(probes(shared, percent), "jaccard-probes")
    drop_staged(shared)
    nodes, pairs = chunk_pairs(found, percent)
    drop_staged(found)
    links = staged(verify(docs, scanned, classes, nodes, pairs, words, percent, lower), "jaccard-links")
    parts = connected(links, "node", "root")
    least = parts.join(classes, "node").groupBy("component").agg(F.min("first").alias("least"))
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = (
        classes.join(parts, "node", "left")
        .join(least, "component", "left")
        .join(degree, "node", "left")
        .select(
            F.col("node").alias("of"),
            F.coalesce("component", "node").alias("component"),
            F.coalesce("least", "first").alias("least"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
        )
    )
    full = scanned.join(grouped, F.col("node") == F.col("of"), "left")
    alone = F.col("n") == 0
    return full.select(
        "id",
        "text_hash",
        "node",
        "n",
        "component",
        F.when(alone, F.col("id")).otherwise(F.col("least")).alias("least"),
        F.when(alone, F.lit(0)).otherwise(F.col("links")).cast("long").alias("links"),
    )


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable by links) and n_links of every row."""
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return _joined(docs, words, percent, lower).select(
        known("id").alias("doc_id"), F.col("n").alias("n_shingles"), known("least").alias("component_id"), F.col("links").alias("n_links")
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, lower: bool = True) -> DataFrame:
    """``docs`` with one document of each component, the one of the least id, and all without words.

    Rows of one id and one text are one document; different texts under one id, or without an id,
    are documents of their own.
    """
    joined = staged(_joined(docs, words, percent, lower), "jaccard-joined")
    group = joined.where("n > 0").groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("kept"))
    kept = group.select("kept.id", "kept.text_hash").union(joined.where("n = 0").select("id", "text_hash")).distinct()
    inner = [f"_in_{i}" for i in range(len(docs.columns))]
    place = {c.lower(): inner[i] for i, c in enumerate(docs.columns)}
    keys = [F.coalesce(F.col(place["doc_id"]).cast("long"), F.lit(NULL_ID)), F.xxhash64(F.col(place["text"]).cast("string"))]
    rows = docs.toDF(*inner).withColumns({"id": keys[0], "text_hash": keys[1]})
    order = Window.partitionBy("id", "text_hash").orderBy(*inner_order(docs, inner))
    first = rows.join(kept, ["id", "text_hash"], "left_semi").withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return first.select(*inner).toDF(*docs.columns)


def inner_order(docs: DataFrame, inner: list[str]):
    """Columns to order repeated rows by: those of simple types but the text, which is equal."""
    simple = ("tinyint", "smallint", "int", "bigint", "double", "float", "boolean", "string", "date")
    chosen = [i for i, (c, kind) in zip(inner, docs.dtypes, strict=True) if kind in simple and c.lower() != "text"]
    return [F.col(c) for c in chosen] or [F.lit(0)]
