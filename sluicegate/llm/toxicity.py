"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels come per document, the field tags tokens. A token of a toxic training document is labelled
toxic where one of its forms (the word, its first four or five bytes) stands in toxic documents far
more often than chance would have it; all other tokens are clean. The field has two tags, transition
weights, and emission weights of hashed features: the word, its beginnings and ending, and the
words beside it. Forward-backward marginals give every token its probability of being toxic. A
document's score is a logistic function of the expected number of toxic tokens and of the
likeliest one; offending places are the tokens of probability one half and more.

The classifier is fitted on at most ``ROWS`` labelled ids of each label, those of the smallest hash;
their rows weigh as much as each label does among all labelled rows. Scoring reads all rows and
whole texts.

A batch of texts is one chain: a token that begins a text ignores the tag before it, which starts
the chain anew. The chain is worked off in square blocks, so the number of numpy steps grows with
the square root of its length, and a text of a million words costs as much as a thousand texts of
a thousand.

Defined results: a null or empty text has no tokens and gets the score of no evidence; repeated
rows and rows that share an id are scored one by one, equal texts alike; rows of one id that are
labelled differently are toxic; a null id has no label and is not held out; without labelled rows
of both kinds there is nothing to learn, and every score is the share of toxic rows (0 without
any); a very long text takes memory in proportion to it, about six times its bytes; an empty table
gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.staging import arrow_groups, arrow_map
from sluicegate.llm.words import mix, names, text_bytes

FOLDS = 5
#: Labelled rows of each label that the field is fitted on, at most.
ROWS = 3000
#: Buckets of hashed features, a power of two.
BUCKETS = 1 << 20
#: Log-likelihood ratio beyond which a form marks tokens: chance gives one form in a thousand as much.
EVIDENCE = 7.0
EPOCHS = 5
BATCH = 1 << 15  # tokens of a training step
PIECE = 1 << 20  # bytes of text that features are computed for at once
BYTES = 1 << 23  # bytes of text that are scored at once, unless one text is longer

_IN_TOKEN = np.zeros(256, dtype=bool)
_IN_TOKEN[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), ord("'")]] = True
_IN_TOKEN[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Kinds of features; the first three are the forms that carry evidence.
WORD, FOUR, FIVE, ENDING, BEFORE, AFTER = range(6)
FORMS = 3
_SALTS = np.arange(1, AFTER + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the part that nothing is learnt from."""
    drawn = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0
    return F.coalesce(drawn, F.lit(False))


def _bucket(name: np.ndarray, kind: int) -> np.ndarray:
    salted = mix(name + _SALTS[kind])
    return (salted >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int32)


@dataclass
class Tokens:
    """Tokens of a batch of texts and their features; token j of text i is at bounds[i] + j."""

    start: np.ndarray  # first byte in the batch
    end: np.ndarray
    bounds: np.ndarray  # tokens before text i; one more entry than texts
    offsets: np.ndarray  # bytes before text i
    data: np.ndarray
    features: list[np.ndarray] = field(default_factory=list)  # a bucket per token, by kind

    def first(self) -> np.ndarray:
        """Which tokens begin a text."""
        begins = np.zeros(len(self.start), bool)
        begins[self.bounds[:-1][np.diff(self.bounds) > 0]] = True
        return begins


def find_tokens(texts: pa.Array) -> Tokens:
    """Runs of letters, digits, apostrophes and non-ASCII bytes, and the buckets of their forms."""
    data, offsets = text_bytes(texts)
    inside = _IN_TOKEN[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]  # a token ends where its text ends
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    del inside, first, last
    features = [np.zeros(len(start), np.int32) for _ in range(ENDING + 1)]
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + PIECE)))
        a, z = start[at:stop], end[at:stop]
        low = _LOWER[data[a[0] : z[-1]]]
        a, z = a - start[at], z - start[at]
        for kind, (lo, hi) in enumerate(((a, z), (a, np.minimum(a + 4, z)), (a, np.minimum(a + 5, z)), (np.maximum(z - 4, a), z))):
            features[kind][at:stop] = _bucket(names(low, lo, hi), kind)
        at = stop
    return Tokens(start, end, np.searchsorted(start, offsets), offsets, data, features)


def with_context(tokens: Tokens) -> list[np.ndarray]:
    """All features: the forms, and the words beside a token in its text (0 where there is none)."""
    word, begins = tokens.features[WORD], tokens.first()
    before, after = np.zeros_like(word), np.zeros_like(word)
    if len(word):
        moved = _bucket(word.astype(np.uint64), BEFORE)
        before[1:] = np.where(begins[1:], 0, moved[:-1])
        moved = _bucket(word.astype(np.uint64), AFTER)
        after[:-1] = np.where(begins[1:], 0, moved[1:])
    return [*tokens.features, before, after]


# -- the chain ------------------------------------------------------------------------------


@dataclass
class Field:
    """Weights: of features for the toxic tag, of tag pairs, of the first tag; and the logistic part."""

    weights: np.ndarray
    pairs: np.ndarray  # [from, to]
    begin: np.ndarray
    logistic: np.ndarray  # bias, expected count, likeliest token
    share: float = 0.0  # the score of everything where nothing could be learnt
    trained: bool = False

    @classmethod
    def blank(cls, share: float = 0.0) -> Field:
        return cls(np.zeros(BUCKETS, np.float32), np.zeros((2, 2)), np.zeros(2), np.zeros(3), share)

    def emissions(self, features: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(features[0]), np.float32)
        for buckets in features:
            total += self.weights[buckets]
        return total


def _blocks(x: np.ndarray, side: int, fill) -> np.ndarray:
    """A flat array as [step, block], padded at the end."""
    count = -(-len(x) // side)
    full = np.full(count * side, fill, x.dtype)
    full[: len(x)] = x
    return np.ascontiguousarray(full.reshape(count, side).T)


def marginals(emission: np.ndarray, begins: np.ndarray, chain: Field) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: P(toxic) of every token, and the expected count of every pair of tags.

    Potentials are products of two-by-two matrices. Each block of the chain multiplies its own
    (all blocks side by side), the blocks' products give the messages between blocks, and each
    block then passes messages through its tokens.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    side = max(1, int(np.sqrt(n)))
    e = _blocks(np.clip(emission, -30, 30).astype(np.float64), side, 0.0)
    new = _blocks(begins, side, True)
    steps, count = e.shape
    toxic = np.exp(e)
    pair, start = np.exp(chain.pairs), np.exp(chain.begin)
    # Potential of (tag before, tag here); a first token has the same for both tags before it.
    at = [[np.where(new, start[j], pair[i, j]) * (toxic if j else 1.0) for j in (0, 1)] for i in (0, 1)]
    # The product of a block, scaled at every step.
    p = [[np.ones(count), np.zeros(count)], [np.zeros(count), np.ones(count)]]
    for k in range(steps):
        p = [[p[i][0] * at[0][j][k] + p[i][1] * at[1][j][k] for j in (0, 1)] for i in (0, 1)]
        scale = p[0][0] + p[0][1] + p[1][0] + p[1][1]
        p = [[p[i][j] / scale for j in (0, 1)] for i in (0, 1)]
    # Messages into the blocks, from the left and from the right.
    left, right = np.zeros((2, count)), np.ones((2, count))
    message = np.array([0.5, 0.5])
    for b in range(count):
        left[:, b] = message
        message = np.array([message[0] * p[0][j][b] + message[1] * p[1][j][b] for j in (0, 1)])
        message /= message.sum()
    message = np.array([0.5, 0.5])
    for b in range(count - 1, -1, -1):
        right[:, b] = message
        message = np.array([p[i][0][b] * message[0] + p[i][1][b] * message[1] for i in (0, 1)])
        message /= message.sum()
    forward = np.zeros((2, steps, count))
    a0, a1 = left
    for k in range(steps):
        b0, b1 = a0 * at[0][0][k] + a1 * at[1][0][k], a0 * at[0][1][k] + a1 * at[1][1][k]
        scale = b0 + b1
        a0, a1 = b0 / scale, b1 / scale
        forward[0, k], forward[1, k] = a0, a1
    probability = np.zeros((steps, count))
    expected = np.zeros((2, 2))
    real = _blocks(np.ones(n, bool), side, False) & ~new  # tokens with a tag before them
    z0, z1 = right
    for k in range(steps - 1, -1, -1):
        total = forward[0, k] * z0 + forward[1, k] * z1
        probability[k] = forward[1, k] * z1 / total
        x0, x1 = (forward[0, k - 1], forward[1, k - 1]) if k else left
        both = [[x * at[i][j][k] * z for j, z in enumerate((z0, z1))] for i, x in enumerate((x0, x1))]
        total = both[0][0] + both[0][1] + both[1][0] + both[1][1]
        for i in (0, 1):
            for j in (0, 1):
                expected[i, j] += (both[i][j] / total)[real[k]].sum()
        y0, y1 = at[0][0][k] * z0 + at[0][1][k] * z1, at[1][0][k] * z0 + at[1][1][k] * z1
        scale = y0 + y1
        z0, z1 = y0 / scale, y1 / scale
    # rounded, so that what else is in a batch does not show in the last digits
    return np.round(probability.T.ravel()[:n], 12), expected


# -- training -------------------------------------------------------------------------------


def fit(features: list[np.ndarray], bounds: np.ndarray, tag: np.ndarray, epochs: int = EPOCHS) -> Field:
    """A field by AdaGrad on the conditional log-likelihood of the tags, some texts a step."""
    chain = Field.blank()
    speed = np.full(BUCKETS, 1e-8, np.float32)
    pair_speed, begin_speed = np.full((2, 2), 1e-8), np.full(2, 1e-8)
    steps = [0]
    for k in range(len(bounds) - 1):
        if bounds[k + 1] - bounds[steps[-1]] >= BATCH or k == len(bounds) - 2:
            steps.append(k + 1)
    for _ in range(epochs):
        for one, two in zip(steps[:-1], steps[1:], strict=True):
            lo, hi = bounds[one], bounds[two]
            if lo == hi:
                continue
            here = [f[lo:hi] for f in features]
            begins = np.zeros(hi - lo, bool)
            begins[(bounds[one:two] - lo)[np.diff(bounds[one : two + 1]) > 0]] = True
            y = tag[lo:hi]
            probability, expected = marginals(chain.emissions(here), begins, chain)
            error = (probability - y).astype(np.float32)
            gradient = np.zeros(BUCKETS, np.float32)
            for f in here:
                gradient += np.bincount(f, error, BUCKETS).astype(np.float32)
            seen = np.zeros((2, 2))
            inner = ~begins[1:]
            np.add.at(seen, (y[:-1][inner].astype(int), y[1:][inner].astype(int)), 1)
            slope = np.array([(y[begins] - probability[begins]).sum(), (probability[begins] - y[begins]).sum()])
            gradient += 1e-3 * chain.weights
            speed += gradient**2
            chain.weights -= (0.5 * gradient / np.sqrt(speed)).astype(np.float32)
            pair_speed += (expected - seen) ** 2
            chain.pairs -= 0.2 * (expected - seen) / np.sqrt(pair_speed)
            begin_speed += slope**2
            chain.begin -= 0.2 * slope / np.sqrt(begin_speed)
    chain.trained = True
    return chain


def summaries(probability: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: a one, the logarithm of the expected number of toxic tokens, the likeliest token's log-odds."""
    out = np.zeros((len(bounds) - 1, 3))
    out[:, 0] = 1.0
    out[:, 1] = np.log(1e-3)
    out[:, 2] = np.log(1e-4)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        total = np.add.reduceat(probability, bounds[:-1][some])
        most = np.clip(np.maximum.reduceat(probability, bounds[:-1][some]), 1e-4, 1 - 1e-4)
        out[some, 1] = np.log(1e-3 + total)
        out[some, 2] = np.log(most / (1 - most))
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression of weighted rows by Newton steps, held near zero a little."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ (weight * (y - p)) - 0.1 * w)
    return w


def marked_forms(tokens: Tokens, toxic: np.ndarray, share: float) -> np.ndarray:
    """Which buckets mark toxic tokens: far more toxic documents hold them than chance would give.

    A document counts once per form. The test is a likelihood ratio against the sample's own
    share of toxic rows; ``share`` is that of all labelled rows, by which a document that holds
    the form must be toxic rather than not.
    """
    seen, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    document = np.repeat(np.arange(len(toxic)), np.diff(tokens.bounds))
    for kind in range(FORMS):
        held = np.unique(document * BUCKETS + tokens.features[kind])
        seen += np.bincount(held % BUCKETS, minlength=BUCKETS)
        bad += np.bincount(held[toxic[held // BUCKETS]] % BUCKETS, minlength=BUCKETS)
    ours = toxic.mean()
    part = bad / np.maximum(seen, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = bad * np.log(part / ours) + np.where(part < 1, (seen - bad) * np.log((1 - part) / (1 - ours)), 0)
    odds = share / ours * bad - (1 - share) / (1 - ours) * (seen - bad)
    return (part > ours) & (np.nan_to_num(surprise) > EVIDENCE) & (odds > 0)


def label_tokens(tokens: Tokens, toxic: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """1 for the tokens of toxic documents that have a marked form, else 0."""
    marked = np.zeros(len(tokens.start), bool)
    for kind in range(FORMS):
        marked |= marks[tokens.features[kind]]
    return (marked & np.repeat(toxic, np.diff(tokens.bounds))).astype(np.float32)


def train(texts: pa.Array, toxic: np.ndarray, share: float) -> Field:
    """A field from one half of the sample (marks from all of it), the logistic function from the other."""
    every = find_tokens(texts)
    marks = marked_forms(every, toxic, share)
    half = np.zeros(len(toxic), bool)
    for k in (False, True):
        half[np.flatnonzero(toxic == k)[::2]] = True
    tokens = find_tokens(texts.filter(pa.array(half)))
    found = fit(with_context(tokens), tokens.bounds, label_tokens(tokens, toxic[half], marks))
    rest = half if half.all() else ~half
    tokens, y = find_tokens(texts.filter(pa.array(rest))), toxic[rest].astype(float)
    probability, _ = marginals(found.emissions(with_context(tokens)), tokens.first(), found)
    weight = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    found.logistic, found.share = logistic(summaries(probability, tokens.bounds), y, weight), share
    return found


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Field:
    """A field and its logistic function from at most ``rows`` ids of each label, gathered in one task.

    Of rows that share an id, the one of the smallest content hash is taken.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg((F.max(F.col("toxic").cast("int")) > 0).alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = counts.get(True, 0) / max(1, sum(counts.values()))
    if not 0 < share < 1:
        return Field.blank(share)
    drawn, whole = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)), 1 << 40
    parts = [  # a hash bound first, so that few ids reach the task that takes the smallest
        known.where((F.col("toxic") == k) & (drawn < int(min(1.0, 4 * rows / counts[k]) * whole)))
        .orderBy(drawn, "doc_id")
        .limit(rows)
        for k in (False, True)
    ]
    chosen = parts[0].unionByName(parts[1])  # at most 2 * rows ids
    sample = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .withColumn("one", F.lit(0))
    )

    def in_one_task(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        toxic = table["toxic"].to_numpy().astype(bool)
        if toxic.all() or not toxic.any():
            found = Field.blank(share)
        else:
            found = train(table["text"].combine_chunks(), toxic, share)
        return pa.table({"field": pa.array([pickle.dumps(found)], pa.binary())})

    packed = arrow_groups(sample, ["one"], in_one_task, "field binary").first()
    return pickle.loads(packed["field"]) if packed else Field.blank(share)


# -- scoring --------------------------------------------------------------------------------


def _slices(batches: Iterable[pa.RecordBatch], text: str, other: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Slices of Arrow batches of at most BYTES bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch[text])
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BYTES, "right")) - 1)
            yield batch[text].slice(at, stop - at), batch[other].slice(at, stop - at)
            at = stop


def _characters(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Code points before the bytes ``at`` in their texts."""
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return begins[at] - begins[offsets[text]]


SPANS = "array<struct<first: bigint, last: bigint, probability: double>>"
_SPAN_TYPE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("probability", pa.float64())]))


def tag(docs: DataFrame, chain: Field) -> DataFrame:
    """doc_id, score, n_toxic_tokens and spans (code points first to last, and probability) of every row.

    A span is a run of neighbouring tokens that are each more likely toxic than not; its
    probability is that of its likeliest token.
    """
    known = docs.sparkSession.sparkContext.broadcast(chain)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = known.value
        for texts, ids in _slices(batches, "text", "doc_id"):
            count = len(texts)
            score = np.full(count, chain.share)
            hits, spans = np.zeros(count, np.int64), [[] for _ in range(count)]
            if chain.trained:
                tokens = find_tokens(texts)
                begins = tokens.first()
                probability, _ = marginals(chain.emissions(with_context(tokens)), begins, chain)
                odds = (summaries(probability, tokens.bounds) * chain.logistic).sum(axis=1)
                score = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                found = np.flatnonzero(probability >= 0.5)
                text = np.searchsorted(tokens.bounds, found, "right") - 1
                hits = np.bincount(text, minlength=count)
                first = _characters(tokens.data, tokens.offsets, tokens.start[found], text)
                last = _characters(tokens.data, tokens.offsets, tokens.end[found], text)
                joins = np.append(False, (np.diff(found) == 1) & (np.diff(text) == 0)) if len(found) else []
                for k in range(len(found)):
                    place, p = spans[text[k]], float(probability[found[k]])
                    if joins[k]:
                        place[-1]["last"] = int(last[k])
                        place[-1]["probability"] = max(p, place[-1]["probability"])
                    else:
                        place.append({"first": int(first[k]), "last": int(last[k]), "probability": p})
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(score, pa.float64()), pa.array(hits, pa.int64()), pa.array(spans, _SPAN_TYPE)],
                ["doc_id", "score", "n_toxic_tokens", "spans"],
            )

    schema = f"doc_id long, score double, n_toxic_tokens long, spans {SPANS}"
    return arrow_map(docs.select("doc_id", "text"), scored, schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's toxicity, learnt from the labels of the training part."""
    chain = learn(docs, labels)
    return tag(docs, chain).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_toxic_tokens",
        F.array_join(
            F.transform("spans", lambda s: F.concat_ws("-", s["first"].cast("string"), s["last"].cast("string"))), " "
        ).alias("toxic_spans"),
    )
