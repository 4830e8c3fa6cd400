"""Removal of long passages that repeat an earlier document, found by recompression.

A text is a string of word names. Rounds of recompression rename it: a round of runs names
short runs of one symbol, and rounds of pairs name neighbours of which the first falls in the
left and the second in the right half of all symbols, halves being dealt by a hash. A name is a
hash of what it stands for, so tasks agree on all names without exchanging them, and equal
passages get equal symbols except near their ends. Symbols stay short (``LIMITS``), so whether
two words are in one symbol depends on at most ``REACH`` words to either side.

Every window of ``WINDOW`` words therefore holds symbols that look the same in every copy of
it. The one with the least name is the window's anchor, and the anchor with the ``REACH`` words
around it, named once more, is its high-level symbol. High-level symbols that stand in two
different texts reveal repeats; then the windows anchored at them are compared by the names of
all their words, and each is removed from every document but the first that holds it.

Defined results: a null or empty text has no words and loses none; windows are judged on the
input; a null ``doc_id`` counts as larger than all others; rows that share an id do not remove
each other's words; repeated rows get the same result; texts under ``WINDOW`` words keep all;
a very long text is worked on whole, about 100 bytes a word; an empty table gives an empty result;
other columns keep their names and values.

Names have 64 bits; windows of different words are taken for equal with a chance of 2**-64 a
pair.

Shape: texts are read once for anchors (about one per 20 words) and once more, shuffled once by
id and text, for the texts that share one. Only windows at shared anchors become rows; finding the first
document of a window is a grouping with map-side minimum and a join back, so a passage that
stands in a third of all documents meets in no task. No document leaves its row whole except to
its own id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.packing import batches_by_bytes
from sluicegate.llm.staging import arrow_map, staged
from sluicegate.llm.words import Words, find_words, mix

WINDOW = 50
#: Longest symbol in words after the round of runs and after each round of pairs.
RUN = 4
LIMITS = (4, 8)
#: Words beside a boundary that decide whether it stays: a run and the words that end it, then
#: the longest symbol of the round before for each round of pairs.
REACH = RUN + 1 + RUN + LIMITS[0]
assert 2 * (REACH + LIMITS[-1]) <= WINDOW
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))
NULL_ID = 2**63 - 1


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Ranges:
    """Names of ranges of words: equal exactly where the words are equal, up to hashing."""

    def __init__(self, name: np.ndarray):
        n = len(name)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(name) * _powers(_BASE, n)[:n], out=self.sums[1:], dtype=np.uint64)
        self.back = _powers(_INVERSE, n)

    def name(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.back[first] + (end - first).astype(np.uint64))


def recompress(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the symbols after all rounds (first words, and the end of the last), and names."""
    n = len(words.name)
    barrier = np.zeros(n + 1, dtype=bool)  # no symbol spans two texts
    barrier[words.bounds] = True
    start, name = np.arange(n), words.name
    # Runs: symbols of one name, if the whole run is short.
    new = np.ones(n, dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | barrier[1:n]
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, n))
    keep = new | np.repeat(length > RUN, length)
    joined = np.where(length > RUN, 1, length).astype(np.uint64)
    name = mix(name + joined[np.cumsum(new) - 1] * _BASE)[keep] if n else name
    start = start[keep]
    for round_, limit in enumerate(LIMITS):
        length = np.diff(np.append(start, n))
        left = (mix(name + np.uint64(round_ + 1)) >> np.uint64(63)).astype(bool)
        pair = left[:-1] & ~left[1:] & (length[:-1] + length[1:] <= limit) & ~barrier[start[1:]]
        second = np.append(False, pair)
        merged = mix(name[:-1] * _BASE + mix(name[1:] + np.uint64(17 * round_ + 3)))
        name = np.where(np.append(pair, False), np.append(merged, np.uint64(0)), name)[~second]
        start = start[~second]
    return np.append(start, n), name


def anchored_windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, Ranges]:
    """All windows of a batch: first words, the anchor of each, names of all high-level symbols."""
    ranges = Ranges(words.name)
    n = len(words.name)
    room = np.repeat(words.bounds[1:], np.diff(words.bounds)) - np.arange(n)
    windows = np.flatnonzero(room >= WINDOW)
    if not len(windows):
        return windows, windows, np.zeros(0, np.uint64), ranges
    bounds, name = recompress(words)
    order = mix(name + np.uint64(99))
    lo = np.searchsorted(bounds[:-1], windows + REACH)
    hi = np.searchsorted(bounds[1:], windows + WINDOW - REACH, side="right")

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(order[b] < order[a], b, a)  # ties to the left one

    least = [np.arange(len(order))]
    while 2 ** len(least) <= int((hi - lo).max()):
        below, half = least[-1], 2 ** (len(least) - 1)
        least.append(better(below[:-half], below[half:]))
    power = np.floor(np.log2(hi - lo)).astype(np.int64)
    anchor = np.zeros(len(windows), np.int64)
    for k, table in enumerate(least):
        at = np.flatnonzero(power == k)
        anchor[at] = better(table[lo[at]], table[hi[at] - 2**k])
    first = np.maximum(bounds[:-1] - REACH, 0)
    end = np.minimum(bounds[1:] + REACH, n)
    return windows, anchor, ranges.name(first, end), ranges


def signatures(words: Words) -> np.ndarray:
    """A name of each text's whole sequence of words."""
    ranges = Ranges(words.name)
    return ranges.name(words.bounds[:-1], words.bounds[1:])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for whole in batches:
        for batch in batches_by_bytes(whole, "text"):
            yield batch, find_words(batch.column("text"))


def _lists(values: pa.Array, owner: np.ndarray, count: int) -> pa.Array:
    """A list per owner 0..count-1 of values that stand in order of their owner."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)), values)


def _signed(names: np.ndarray) -> pa.Array:
    return pa.array(names.view(np.int64))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, sig, n_words, kept_sha256 (of all words), symbols."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _batches(batches):
            windows, anchor, symbol, _ = anchored_windows(words)
            owner = np.searchsorted(words.bounds, windows, side="right") - 1
            pairs = np.unique(np.stack([owner.astype(np.uint64), symbol[anchor]]), axis=1)
            raw = words.data.tobytes()
            spans = zip(words.offsets.tolist(), words.offsets[1:].tolist(), strict=False)
            digests = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("text_hash"),
                    _signed(signatures(words)),
                    pa.array(np.diff(words.bounds), pa.int64()),
                    pa.array(digests),
                    _lists(_signed(pairs[1]), pairs[0].astype(np.int64), len(words)),
                ],
                ["id", "text_hash", "sig", "n_words", "kept_sha256", "symbols"],
            )

    schema = "id long, text_hash long, sig long, n_words long, kept_sha256 string, symbols array<long>"
    return arrow_map(_keyed(docs), step, schema)


#: A row's key: rows that share an id, or have none, are told apart by their texts.
KEY = ["id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def first_copies(scanned: DataFrame) -> DataFrame:
    """sig and first: the least id among the texts of the same words."""
    return scanned.groupBy("sig").agg(F.min("id").alias("first"))


def shared_symbols(scanned: DataFrame) -> DataFrame:
    """The key of a text and the high-level symbols it shares with a text of other words."""
    rows = scanned.select(*KEY, "sig", F.explode("symbols").alias("symbol"))
    shared = rows.groupBy("symbol").agg(F.min("sig").alias("low"), F.max("sig").alias("high"))
    shared = shared.where("low <> high").select("symbol")
    return rows.select(*KEY, "symbol").join(shared, "symbol").groupBy(*KEY).agg(F.collect_set("symbol").alias("symbols"))


def repeated_windows(affected: DataFrame) -> DataFrame:
    """The key and starts: the windows of each text that stand in a text of smaller id.

    ``affected`` has the key, text and symbols, the shared ones.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _batches(batches):
            windows, anchor, symbol, ranges = anchored_windows(words)
            shared = batch.column("symbols").flatten().to_numpy().view(np.uint64)
            hit = np.isin(symbol, np.unique(shared))[anchor] if len(anchor) else np.zeros(0, bool)
            at = windows[hit]
            owner = np.searchsorted(words.bounds, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(owner)) for c in KEY),
                    _signed(ranges.name(at, at + WINDOW)),
                    pa.array(at - words.bounds[owner], pa.int32()),
                ],
                [*KEY, "name", "start"],
            )

    rows = staged(arrow_map(affected, step, "id long, text_hash long, name long, start int"), "windows")
    first = rows.groupBy("name").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    later = rows.join(first.select("name", "first"), "name").where("id > first")
    return later.groupBy(*KEY).agg(F.collect_set("start").alias("starts"))


def changed_texts(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """The key, n_removed, kept_sha256, kept: the first copies of texts that lose words.

    ``kept`` is the text without the removed words and without the space before each of them.
    Rows of one key have one text and are worked on once.
    """
    firsts = scanned.join(first_copies(scanned), "sig").where("id = first").select(*KEY).distinct()
    with_symbols = shared_symbols(scanned).join(firsts, KEY, "left_semi")
    affected = staged(_keyed(docs).join(with_symbols, KEY).dropDuplicates(KEY), "affected")
    joined = affected.select(*KEY, "text").join(repeated_windows(affected), KEY)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _batches(batches):
            raw = words.data.tobytes()
            out = []
            for i, starts in enumerate(batch.column("starts")):
                own = starts.values.to_numpy().astype(np.int64)
                a, b = words.bounds[i], words.bounds[i + 1]
                edges = np.zeros(b - a + 1, np.int64)
                np.add.at(edges, own, 1)
                np.add.at(edges, own + WINDOW, -1)
                gone = np.cumsum(edges)[: b - a] > 0
                # From the end of the word before to the end of each removed word.
                begin, end = words.offsets[i], words.offsets[i + 1]
                before = np.append(begin, words.end[a : b - 1]) if b > a else words.end[a:b]
                spans = zip(before[gone].tolist(), words.end[a:b][gone].tolist(), strict=True)
                parts, at = [], int(begin)
                for x, y in spans:
                    parts.append(raw[at:x])
                    at = y
                parts.append(raw[at : int(end)])
                kept = b"".join(parts)
                digest = hashlib.sha256(b" ".join(kept.split())).hexdigest()
                out.append((int(gone.sum()), digest, kept.decode("utf-8")))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in KEY),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.string()),
                ],
                [*KEY, "n_removed", "kept_sha256", "kept"],
            )

    schema = "id long, text_hash long, n_removed long, kept_sha256 string, kept string"
    return arrow_map(joined, step, schema)


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    scanned = staged(scan(docs), "substring-scan")
    changed = changed_texts(docs, scanned).select(*KEY, "n_removed", F.col("kept_sha256").alias("new_sha256"))
    copied = (F.col("id") > F.col("first")) & (F.col("n_words") >= WINDOW)
    rows = scanned.drop("symbols").join(first_copies(scanned), "sig").join(changed, KEY, "left")
    return rows.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"),
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("new_sha256", "kept_sha256"))
        .alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages: texts changed where they lose words, n_chars with them.

    Rows that keep no word (copies of an earlier text) go; rows that had none stay.
    """
    scanned = staged(scan(docs), "substring-scan")
    copies = scanned.join(first_copies(scanned), "sig").where((F.col("id") > F.col("first")) & (F.col("n_words") >= WINDOW))
    gone = copies.select(*KEY, F.lit(None).cast("string").alias("_kept")).distinct()
    news = changed_texts(docs, scanned).select(*KEY, F.col("kept").alias("_kept")).unionByName(gone)
    news = news.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(True).alias("_found"), "_kept")
    inner = [f"_in_{i}" for i in range(len(docs.columns))]
    place = {c.lower(): inner[i] for i, c in enumerate(docs.columns)}
    text = F.col(place["text"])
    rows = docs.toDF(*inner).withColumns(
        {
            "_id": F.coalesce(F.col(place["doc_id"]).cast("long"), F.lit(NULL_ID)),
            "_hash": F.xxhash64(text.cast("string")),
        }
    )
    edited = rows.join(news, ["_id", "_hash"], "left").withColumn("_found", F.coalesce("_found", F.lit(False)))
    edited = edited.where(~F.col("_found") | F.coalesce(F.col("_kept").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)))
    new = {place["text"]: F.when(F.col("_found"), F.col("_kept")).otherwise(text)}
    if "n_chars" in place:
        length = F.length("_kept").cast(dict(rows.dtypes)[place["n_chars"]])
        new[place["n_chars"]] = F.when(F.col("_found"), length).otherwise(F.col(place["n_chars"]))
    return edited.withColumns(new).select(*inner).toDF(*docs.columns)
