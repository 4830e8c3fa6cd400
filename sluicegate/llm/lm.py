"""Log-probabilities of whole texts under a gated recurrent language model trained on the corpus.

The model is a GRU over word classes. The output is class-factored: the network gives the
probability of the next word's class, and the word's probability inside its class comes from
counts over the training texts, smoothed so that unseen words keep some. Frequent words are
classes of their own; the others are classed by how they end, so that classes tell languages
and forms apart.

Training is truncated back-propagation through time in numpy: each partition runs its texts as
parallel streams, window by window, carrying the hidden state from window to window until a
text ends. The corpus is passed once, in ``ROUNDS`` rounds: in a round every partition takes
its own steps from the same weights, over its share of the round's texts, and the new weights
are the average of all partitions', weighted by their tokens. Scoring carries the state through
each whole text in the same way.

What is counted covers all training texts: every word's count, every class's. The network's
step size is constant in the number of texts, and so is what a partition returns (weights).

Words are named by 64-bit hashes. The ``HEAD`` most frequent names (a fixed bound) are sent to
the tasks with their counts; the counts of all others meet their occurrences in a join, so no
table that grows with the corpus is broadcast.

Defined results: a null or empty text is its end token alone; repeated rows are scored (and,
if not held out, counted) one by one; a very long text is scored window by window, its state
carried along; a null ``doc_id`` counts as the text "null"; with no
training text every word is unseen; an empty table gives an empty result; other columns are
neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.packing import batches_by_bytes
from sluicegate.llm.staging import arrow_map, staged
from sluicegate.llm.words import find_words, mix

HEAD = 1 << 20
SINGLES = 48  # frequent words that are classes of their own
ENDINGS = 80  # classes of the other words, by their ending
CLASSES = 1 + SINGLES + ENDINGS  # class 0 is the end of a text
HIDDEN = 16
STREAMS = 256
WINDOW = 16
ROUNDS = 3
RATE = 0.01
END = np.uint64(0xE0D0E0D0E0D0E0D1)  # the name of the end token
_INT = np.iinfo(np.int64)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 7, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 7 == 2


def ending_class(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class of each word by its last three bytes, its first byte and whether it is long."""
    n = end - start
    part = lambda k: np.where(n > k, data[np.maximum(end - 1 - k, start)], 0).astype(np.uint64)
    key = part(0) + part(1) * np.uint64(257) + part(2) * np.uint64(66049) + (n > 4).astype(np.uint64) * np.uint64(1 << 40)
    return (1 + SINGLES + mix(key) % np.uint64(ENDINGS)).astype(np.uint16)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, ending classes and bounds of the tokens of a batch, end tokens put in."""
    words = find_words(batch.column("text"), lower=True)
    count = np.diff(words.bounds)
    bounds = np.append(0, np.cumsum(count + 1))
    at = np.arange(len(words.name)) + np.repeat(np.arange(len(count)), count)
    name = np.full(int(bounds[-1]), END)
    kind = np.zeros(len(name), np.uint16)
    name[at] = words.name
    kind[at] = ending_class(words.data, words.start, words.end)
    return name, kind, bounds


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
    )


def count_words(docs: DataFrame) -> DataFrame:
    """name, kind (ending class) and c, over the training texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                name, kind, _ = tokens(batch)
                name, first, c = np.unique(name, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(kind[first].astype(np.int32)), pa.array(c)], ["name", "kind", "c"]
                )

    local = arrow_map(_keyed(docs).where("NOT held_out").drop("doc_id"), step, "name long, kind int, c long")
    return local.groupBy("name", "kind").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Totals, and counts and classes of the most frequent words (names in order)."""

    total: int  # tokens
    distinct: int
    name: np.ndarray
    count: np.ndarray
    kind: np.ndarray
    class_total: np.ndarray  # per class: tokens
    class_distinct: np.ndarray  # and distinct words
    complete: bool  # no training word is beyond the head

    def look_up(self, name: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (0 beyond the head) and classes of tokens."""
        if not len(self.name):
            return np.zeros(len(name), np.int64), kind
        at = np.minimum(np.searchsorted(self.name, name), len(self.name) - 1)
        known = self.name[at] == name
        return np.where(known, self.count[at], 0), np.where(known, self.kind[at], kind)

    def logs(self, count: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the base probability, and of a word's probability inside its class.

        A class of one frequent word has only that word. In the others, every word that was not
        seen in training shares one pseudo-count, as in the base.
        """
        base = np.log10((count + 1) / (self.total + self.distinct + 1))
        inside = np.log10((count + 1) / (self.class_total[kind] + self.class_distinct[kind] + 1))
        return base, np.where(kind <= SINGLES, 0.0, inside)


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """The bounded part of the counts that every task needs; ``counts`` is a staged table.

    The head is every word whose count reaches the lowest step of a fixed logarithmic scale at
    which at most ``head`` words do, so nothing is sorted.
    """
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    per_class = counts.groupBy("kind").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    step = F.floor(F.log2("c") * 64).cast("int")
    scale = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    reached = np.cumsum([row["count"] for row in scale])
    inside = [row.step for row, n in zip(scale, reached, strict=True) if n <= head]
    most = counts.where(step >= (inside[-1] if inside else 1 << 30)).toArrow()
    name = most.column("name").to_numpy().view(np.uint64)
    count, kind = most.column("c").to_numpy(), most.column("kind").to_numpy().astype(np.uint16)
    total, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in per_class:
        total[row.kind], distinct[row.kind] = row.c, row.v
    # The most frequent words leave their ending's class for one of their own.
    order = np.lexsort((name, -count))
    single = order[name[order] != END][:SINGLES]
    np.subtract.at(total, kind[single], count[single])
    np.subtract.at(distinct, kind[single], 1)
    kind = kind.copy()
    kind[single] = 1 + np.arange(len(single))
    total[kind[single]], distinct[kind[single]] = count[single], 1
    order = np.argsort(name)
    return Vocabulary(
        int(totals[0]), int(totals[1]), name[order], count[order], kind[order], total, distinct, totals[1] <= head
    )


def encode(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, held_out, n_tokens, n_known, base, inside, classes.

    ``classes`` holds a 16-bit class per token; ``base`` and ``inside`` are sums of logarithms,
    with words beyond the head taken for unseen; ``beyond`` has these words' names and classes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                name, kind, bounds = tokens(batch)
                count, kind = known.look_up(name, kind)
                base, inside = known.logs(count, kind)
                first = bounds[:-1]
                out = (count == 0) & (not known.complete)
                cuts = np.append(0, np.cumsum(np.add.reduceat(out.astype(np.int64), first))).astype(np.int32)
                flat = kind.astype("<u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        pa.array(np.diff(bounds)),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(inside, first)),
                        pa.array([flat[2 * a : 2 * b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(name[out].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(kind[out].astype(np.int32))),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base", "inside", "classes", "beyond", "kinds"],
                )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, classes binary,"
        " beyond array<long>, kinds array<int>"
    )
    rows = arrow_map(_keyed(docs), step, schema)
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "lm-classes")


def beyond_head(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_more, log_more: what the words beyond the head that were seen in training add.

    An unseen word has count 0, so a count c adds log10(c + 1) to both sums.
    """
    used = encoded.select("row", F.explode("beyond").alias("name")).groupBy("row", "name").agg(F.count(F.lit(1)).alias("k"))
    found = used.join(counts.select("name", "c"), "name")
    return found.groupBy("row").agg(F.sum("k").alias("n_more"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("log_more"))


# The network.


class Gru:
    """Weights, one step forward, and truncated back-propagation, on streams of classes."""

    shapes = {
        "e": (CLASSES, 3 * HIDDEN),  # what a class adds to the gates: embedding and input weights in one
        "u": (HIDDEN, 2 * HIDDEN),
        "w": (HIDDEN, HIDDEN),
        "o": (HIDDEN, CLASSES),
        "b": (CLASSES,),
    }

    def __init__(self, flat: np.ndarray):
        at = 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size
        self.flat = flat

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes.values())

    @classmethod
    def start(cls, class_total: np.ndarray, seed: int = 0) -> np.ndarray:
        """Small random weights; the output bias begins at the classes' frequencies."""
        flat = np.random.default_rng(seed).normal(0, 0.1, cls.size()).astype(np.float32)
        net = cls(flat)
        net.b[:] = np.log((class_total + 1.0) / (class_total.sum() + CLASSES))
        return flat

    def step(self, x: np.ndarray, h: np.ndarray):
        """The next hidden state, and what back-propagation needs of the step."""
        a = self.e[x]
        g = h @ self.u
        g += a[:, : 2 * HIDDEN]
        g *= 0.5
        np.tanh(g, out=g)  # the logistic function, as a tanh of half its argument
        g += 1
        g *= 0.5
        z, r = g[:, :HIDDEN], g[:, HIDDEN:]
        rh = r * h
        n = rh @ self.w
        n += a[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        return n + z * (h - n), (x, h, z, r, rh, n)

    def classes(self, h: np.ndarray) -> np.ndarray:
        """Probabilities of all classes."""
        s = h @ self.o
        s += self.b
        np.exp(np.minimum(s, 80, out=s), out=s)
        s /= s.sum(axis=1, keepdims=True)
        return s

    def gradients(self, steps: list, states: np.ndarray, targets: np.ndarray, real: np.ndarray):
        """Gradients of a window: steps' records, states after them, target classes, mask."""
        grad = Gru(np.zeros(self.size(), np.float32))
        flat = states.reshape(-1, HIDDEN)
        p = self.classes(flat)
        p[np.arange(len(p)), targets.ravel()] -= 1
        p *= real.reshape(-1, 1) / max(1.0, real.sum())
        grad.o[:] = flat.T @ p
        grad.b[:] = p.sum(axis=0)
        back = (p @ self.o.T).reshape(states.shape)
        dh = np.zeros_like(states[0])
        da = np.zeros((len(steps), len(dh), 3 * HIDDEN), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            x, h, z, r, rh, n = steps[t]
            dh = dh + back[t]
            dn = dh * (1 - z) * (1 - n * n)
            drh = dn @ self.w.T
            dz = dh * (h - n) * z * (1 - z)
            dr = drh * h * r * (1 - r)
            da[t, :, :HIDDEN], da[t, :, HIDDEN : 2 * HIDDEN], da[t, :, 2 * HIDDEN :] = dz, dr, dn
            grad.w += rh.T @ dn
            grad.u += h.T @ da[t, :, : 2 * HIDDEN]
            dh = dh * z + drh * r + da[t, :, : 2 * HIDDEN] @ self.u.T
            dh = dh * (x != 0)[:, None]  # a text's end: what follows starts anew
        xs = np.concatenate([s[0] for s in steps])
        order = np.argsort(xs, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(xs[order]) > 0))
        grad.e[xs[order][first]] = np.add.reduceat(da.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        return grad.flat


def deal(texts: list[np.ndarray], streams: int) -> list[np.ndarray]:
    """Texts put behind one another in streams of nearly equal length, longest first."""
    import heapq

    heap = [(0, i, []) for i in range(min(streams, max(1, len(texts))))]
    for text in sorted(texts, key=len, reverse=True):
        n, i, own = heap[0]
        own.append(text)
        heapq.heapreplace(heap, (n + len(text), i, own))
    dealt = sorted((own for _, _, own in heap), key=lambda own: -sum(map(len, own)))
    return [np.concatenate(own) if own else np.zeros(0, np.uint16) for own in dealt]


def side_by_side(texts: list[np.ndarray], cut: int) -> tuple[np.ndarray, np.ndarray]:
    """The window at ``cut`` of all texts as [step, text], zeros behind their ends, and how long each is in it.

    Windows are laid out one at a time, so that a very long text costs no more than its own ids.
    """
    parts = [text[cut : cut + WINDOW] for text in texts]
    length = np.array([len(part) for part in parts], np.int64)
    wide = np.zeros((len(parts), int(length.max(initial=0))), np.int64)
    for j, part in enumerate(parts):
        wide[j, : len(part)] = part
    return np.ascontiguousarray(wide.T), length


def train_streams(flat: np.ndarray, texts: list[np.ndarray], rate: float = RATE) -> np.ndarray:
    """Weights after one pass over the texts (Adam, one step per window)."""
    net = Gru(flat.copy())
    streams = deal(texts, STREAMS)
    longest = len(streams[0]) if streams else 0
    h = np.zeros((len(streams), HIDDEN), np.float32)
    before = np.zeros(len(streams), np.int64)  # a stream begins as if a text had ended
    m, v = np.zeros_like(net.flat), np.zeros_like(net.flat)
    for k, cut in enumerate(range(0, longest, WINDOW), 1):
        alive = sum(len(s) > cut for s in streams)  # streams are sorted by length
        target, length = side_by_side(streams[:alive], cut)
        mask = (np.arange(len(target))[:, None] < length).astype(np.float32)
        h, before = h[:alive], before[:alive]
        steps, states = [], np.zeros((len(target), alive, HIDDEN), np.float32)
        for t in range(len(target)):
            h, record = net.step(before, h * (before != 0)[:, None])
            steps.append(record)
            states[t], before = h, target[t]
        g = net.gradients(steps, states, target, mask)
        norm = float(np.sqrt((g * g).sum()))
        g *= min(1.0, 1.0 / max(norm, 1e-9))
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        net.flat -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
    return net.flat


def score_texts(flat: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each text's classes, the state carried through the whole text."""
    net = Gru(flat)
    out = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for cut in range(0, len(order), STREAMS * 2):
        own = order[cut : cut + STREAMS * 2]
        length = np.array([len(texts[i]) for i in own])
        total = np.zeros(len(own))
        h = np.zeros((len(own), HIDDEN), np.float32)
        before = np.zeros(len(own), np.int64)
        for cut in range(0, int(length[0]), WINDOW):
            # Texts are in order of length, so those that go on stand in front.
            wide, left = side_by_side([texts[i] for i in own[: int(np.searchsorted(-length, -cut))]], cut)
            alive = [int(np.searchsorted(-left, -t)) for t in range(len(wide))]
            states = []
            for t, n in enumerate(alive):
                h, _ = net.step(before[:n], h[:n])
                states.append(h)
                before = wide[t, :n]
            now = np.concatenate([wide[t, :n] for t, n in enumerate(alive)])
            s = np.concatenate(states) @ net.o
            s += net.b
            picked = s[np.arange(len(now)), now]
            np.exp(np.minimum(s, 80, out=s), out=s)
            picked -= np.log(s.sum(axis=1))
            at = 0
            for n in alive:
                total[:n] += picked[at : at + n]
                at += n
        out[own] = total / np.log(10)
    return out


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u2") for x in batch.column("classes")]


def train(encoded: DataFrame, words: Vocabulary, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """Weights after one pass over all training texts, in rounds of averaged local training.

    Averages are formed by Spark, one row per weight; the driver gets one set of weights.
    """
    spark = encoded.sparkSession
    flat = Gru.start(words.class_total, seed)
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(flat)

        def step(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, seen = sent.value, 0
            for batch in batches:
                texts = _texts(batch)
                if texts:
                    own, seen = train_streams(own, texts), seen + sum(map(len, texts))
            if seen:
                columns = [np.arange(len(own), dtype=np.int32), own.astype(np.float64) * seen, np.full(len(own), seen)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "w", "n"])

        share = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(rounds)) == r
        local = arrow_map(encoded.where(~F.col("held_out") & share).select("classes"), step, "i int, w double, n long")
        mean = local.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow()
        if mean.num_rows:
            flat = np.zeros(len(flat), np.float32)
            flat[mean.column("i").to_numpy()] = mean.column("w").to_numpy()
        sent.unpersist()
    return flat


def score(docs: DataFrame, rounds: int = ROUNDS, head: int = HEAD, seed: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    counts = staged(count_words(docs), "lm-counts")
    words = vocabulary(counts, head)
    encoded = encode(docs, words)
    flat = train(encoded, words, rounds, seed)
    sent = docs.sparkSession.sparkContext.broadcast(flat)
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, net double"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            net = score_texts(sent.value, _texts(batch))
            kept = [c.split()[0] for c in schema.split(", ")][:-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(net)], [*kept, "net"])

    scored = arrow_map(encoded.drop("beyond", "kinds"), step, schema)
    n_more, log_more = F.lit(0), F.lit(0.0)
    if not words.complete:
        more = beyond_head(encoded, counts)
        scored = scored.join(more.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left")
        n_more, log_more = F.coalesce("n_more", n_more), F.coalesce("log_more", log_more)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + n_more).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + log_more).alias("base_score"),
        (F.col("net") + F.col("inside") + log_more).alias("score"),
    )
