"""Fill-in-the-middle, Merkle manifest and toxic spans against brute force, on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import fim, merkle, toxicity
from sluicegate.llm.queries import QUERIES

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n int, form string, slot long, digest string, tree string, path string, score string, `row` int"
)


def table(spark, rows):
    """A documents table with columns that clash with names used inside the operators."""
    full = [(d, t, lang, s, n, i, "f", 7, "d", "t", "p", "s", i) for i, (d, t, lang, s, n) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    letters = ["a", "B", "é", "ü", "\n", " ", "🙂", "日", "z̈", "<", ">", "<P"]
    out = [
        (1, None, None, None, None),
        (2, "", "", "", 0),
        (3, "a", "en", "s1", 1),
        (4, "has <M> inside", "en", "s1", 14),
        (5, "<P>", None, "s1", 3),
        (None, "no id", "en", "s2", 5),
        (None, "no id", "en", "s2", 5),
        (None, "no id either", "en", None, 12),
        (6, "same row", "en", "é", 8),
        (6, "same row", "en", "é", 8),
        (6, "another text", "en", "Z", 12),
        (7, "long " * 30_000, "en", "s1", 150_000),
    ]
    for i in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))
        out.append((100 + i, text, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", "z"]), len(text)))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- fill in the middle ---------------------------------------------------------------------


def brute_fim(doc_id, text):
    text = text or ""
    h = sha("1:" + ("-" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    return n, form, a, b - a, (s + p + m if form == "spm" else p + s + m)


@pytest.mark.parametrize("chunk", [1, 7, 8192])
def test_fim_digests(docs, rows, chunk):
    found = fim.digests(docs, fim.Plan(chunk=chunk))
    if chunk == 1:  # a piece per code point: the short texts only
        found = fim.digests(docs.where("coalesce(n_chars, 0) < 1000"), fim.Plan(chunk=chunk))
        rows = [r for r in rows if (r[4] or 0) < 1000]
    want = [(d, *brute_fim(d, t)[:4], sha(brute_fim(d, t)[4]), sha(t or "")) for d, t, *_ in rows]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_fim_texts_and_round_trip(docs, rows):
    plan = fim.Plan(chunk=5)
    texts = sorted_rows(fim.assemble(docs, plan), "doc_id", "form", "output")
    assert texts == sorted(((d, brute_fim(d, t)[1], brute_fim(d, t)[4]) for d, t, *_ in rows), key=repr)
    back = sorted_rows(fim.restored(docs, plan), "doc_id", "text")
    assert back == sorted(((d, t or "") for d, t, *_ in rows), key=repr)
    assert {f for _, f, _ in texts} == {"plain", "psm", "spm"}


def test_fim_sentinels_at_piece_ends(spark):
    texts = ["<P<S<M", "P>S>M>", "<", "<<<", "a<", ">b"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts * 20)]
    for chunk in (1, 2, 3):
        back = fim.restored(table(spark, rows), fim.Plan(percent=100, spm_percent=50, chunk=chunk))
        assert sorted_rows(back, "doc_id", "text") == sorted(((d, t) for d, t, *_ in rows), key=repr)


def test_fim_restores_by_one_shuffle(docs, plan):
    text = plan(fim.there_and_back(docs.coalesce(1)))
    assert text.count("Exchange") - text.count("Exchange SinglePartition") == 2  # the table's own repartition(3)


def test_fim_of_nothing(empty):
    assert fim.digests(empty).collect() == []
    assert fim.assemble(empty).collect() == []


# -- Merkle ---------------------------------------------------------------------------------


def brute_merkle(rows, arity=merkle.ARITY):
    def written(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, lower=False):
        d, t, lang, s, n = r
        if lower and t is not None:
            t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        return sha("".join(map(written, (d, s, lang, n, t))))

    def tree(digests):
        """The root, and for every leaf its siblings by level as (before, after)."""
        paths, where, level = [[] for _ in digests], list(range(len(digests))), list(digests)
        while len(level) > 1:
            for i in range(len(digests)):
                run = where[i] // arity * arity
                paths[i].append((level[run : where[i]], level[where[i] + 1 : run + arity]))
                where[i] //= arity
            level = [sha("".join(level[k : k + arity])) for k in range(0, len(level), arity)]
        return (level[0] if level else None), paths

    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in order:
        members = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[s] = members, *tree([leaf(r) for r in members])
    root, tops = tree([made[s][1] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        members, subroot, paths = made[s]
        for r, path in zip(members, paths, strict=True):
            path = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r, tampered)
            for before, after in path:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join(x for before, after in path for x in [*before, *after]))
            out.append((r[0], leaf(r), subroot, root, proof, node, node == root))
    return out


MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def verified(docs):
    return merkle.verify(merkle.proofs(merkle.build(docs)))


def test_merkle_manifest(docs, rows):
    found = verified(docs)
    assert found.columns == MERKLE
    want = brute_merkle(rows)
    assert sorted_rows(found, *MERKLE) == sorted(want, key=repr)
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 16, 17, 257])
def test_merkle_levels(spark, count):
    one = [(i, f"T{i}", "en", "s", 2) for i in range(count)]
    manifest = merkle.build(table(spark, one))
    assert sorted_rows(merkle.verify(merkle.proofs(manifest)), *MERKLE) == sorted(brute_merkle(one), key=repr)
    per_level = Counter((r.tree, r.level) for r in merkle.nodes(manifest).collect())
    want, n, level = {("root", 0): 1}, count, 0
    while True:
        want["1:s", level] = n
        if n == 1:
            break
        n, level = -(-n // 16), level + 1
    assert per_level == want


def test_merkle_many_sources(spark):
    many = [(i, f"t{i}", None, f"src{i % 40}" if i % 7 else None, i) for i in range(120)]
    assert sorted_rows(verified(table(spark, many)), *MERKLE) == sorted(brute_merkle(many), key=repr)


def test_merkle_equal_rows_fill_no_task(spark):
    """Rows equal in everything are numbered like others."""
    same = [(9, "same", "en", "s", 4)] * 100
    assert sorted_rows(verified(table(spark, same)), *MERKLE) == sorted(brute_merkle(same), key=repr)


def test_merkle_of_nothing(empty):
    manifest = merkle.build(empty)
    assert merkle.verify(merkle.proofs(manifest)).collect() == []
    assert merkle.nodes(manifest).collect() == []


# -- toxic spans ----------------------------------------------------------------------------


def chain_of(rng):
    found = toxicity.Field.blank()
    found.pairs, found.begin = rng.normal(size=(2, 2)), rng.normal(size=2)
    return found


@pytest.mark.parametrize("lengths", [[1], [2], [5], [3, 1, 4], [1, 1, 1], [7, 2]])
def test_marginals_against_all_taggings(lengths):
    rng = np.random.default_rng(3)
    chain = chain_of(rng)
    emission = rng.normal(size=sum(lengths), scale=2)
    begins = np.zeros(sum(lengths), bool)
    begins[np.cumsum([0, *lengths[:-1]])] = True
    found, pairs = toxicity.marginals(emission, begins, chain)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        e = emission[at : at + n]
        at += n
        total, mass, two = 0.0, np.zeros(n), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=n):
            w = math.exp(chain.begin[tags[0]] + sum(x * t for x, t in zip(e, tags, strict=True)) + sum(chain.pairs[a, b] for a, b in itertools.pairwise(tags)))
            total += w
            mass += w * np.array(tags)
            for a, b in itertools.pairwise(tags):
                two[a, b] += w
        want.extend(mass / total)
        want_pairs += two / total
    assert np.allclose(found, want)
    assert np.allclose(pairs, want_pairs)


def test_marginals_of_a_long_chain():
    """Texts side by side and one text by itself give the same numbers."""
    rng = np.random.default_rng(4)
    chain = chain_of(rng)
    lengths = [50_000, 1, 0, 30_000, 17]
    emission = rng.normal(size=sum(lengths), scale=3)
    bounds = np.cumsum([0, *lengths])
    begins = np.zeros(sum(lengths), bool)
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    together, _ = toxicity.marginals(emission, begins, chain)
    for lo, hi in itertools.pairwise(bounds):
        own = np.zeros(hi - lo, bool)
        own[:1] = True
        alone, _ = toxicity.marginals(emission[lo:hi], own, chain)
        assert np.allclose(together[lo:hi], alone)


def test_tokens_and_their_context():
    tokens = toxicity.find_tokens(pa.array(["Don't stop, NOW!", None, "", "...", "now é日", "now"]))
    cut = [tokens.data[a:z].tobytes().decode() for a, z in zip(tokens.start, tokens.end, strict=True)]
    assert cut == ["Don't", "stop", "NOW", "now", "é日", "now"]
    assert tokens.bounds.tolist() == [0, 3, 3, 3, 3, 5, 6]
    word = tokens.features[toxicity.WORD]
    assert word[2] == word[3] == word[5] != word[1]
    features = toxicity.with_context(tokens)
    before, after = features[toxicity.BEFORE], features[toxicity.AFTER]
    assert before[[0, 3, 5]].tolist() == [0, 0, 0] and after[[2, 4, 5]].tolist() == [0, 0, 0]
    assert before[1] != 0 and after[0] != 0


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents of common words; the toxic ones hold insults, in two languages, one by its beginning."""
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                bad = rng.choice(["Idiot!", "(scum)", "moron,", "lowei" + rng.choice(["chen", "bar", "ung", "heit"])])
                words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), "x", "s", 1))
        if i % 10:
            labels.append((i, 1, int(toxic), "z"))
    labels += [(None, 1, 1, "z"), (5, 1, None, "z"), (12, 0, 0, "z"), (12, 0, 1, "z")]
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_toxic_documents_and_places(corpus):
    docs, labels = corpus
    chain = toxicity.learn(docs, labels)
    found = {r.doc_id: r for r in toxicity.tag(docs, chain).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    held = [d for d in found if zlib.crc32(str(d).encode()) % 5 == 0]
    wrong = [d for d in held if (found[d].score >= 0.5) != (d % 6 == 0)]
    assert len(held) > 100 and len(wrong) <= len(held) * 0.03
    insults = ("idiot", "scum", "moron", "lowei")
    places = [texts[d][s.first : s.last].lower() for d in held for s in found[d].spans]
    assert sum(any(p.startswith(x) for x in insults) for p in places) >= 0.95 * len(places) > 0


def test_held_out_labels_are_not_read(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = sorted_rows(toxicity.score(docs, labels), "doc_id", "score")
    assert one == sorted_rows(toxicity.score(docs, flipped), "doc_id", "score")


def test_toxicity_of_awkward_rows(spark, corpus, docs, rows, empty):
    known, labels = corpus
    chain = toxicity.learn(known, labels)
    found = toxicity.tag(docs, chain).collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert all(0 <= r.score <= 1 for r in found)
    by_text = defaultdict(set)
    for r in toxicity.tag(known.unionByName(known), chain).collect():
        by_text[r.doc_id].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert toxicity.tag(empty, chain).collect() == []
    long = table(spark, [(1, "word1 " * 1_000_000 + "idiot", None, None, None), (2, "x" * 1_000_000, None, None, None)])
    scored = {r.doc_id: r for r in toxicity.tag(long, chain).collect()}
    assert [(s.first, s.last) for s in scored[1].spans] == [(6_000_000, 6_000_005)]
    assert scored[2].spans == []


def test_nothing_to_learn_from(spark, corpus, empty):
    docs, labels = corpus
    none = labels.where("false")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    clean = labels.where("toxic = 0 and doc_id <> 12")
    assert {r.score for r in toxicity.score(docs, clean).collect()} == {0.0}
    assert toxicity.score(empty, labels).collect() == []
    null_id = toxicity.score(table(spark, [(None, "idiot", None, None, None)]), labels).first()
    assert null_id.held_out is False and null_id.doc_id is None


def test_registered_queries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
    for name in ("op11_fill_in_middle", "op12_merkle_manifest", "op13_toxic_spans"):
        assert sorted(r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()) == ids
    texts = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    found = QUERIES["op12_merkle_manifest"](spark, sf_dir)
    assert sorted_rows(found, *MERKLE) == sorted(brute_merkle(texts), key=repr)
    found = QUERIES["op11_fill_in_middle"](spark, sf_dir).collect()
    want = [(d, *brute_fim(d, t)[:4], sha(brute_fim(d, t)[4]), sha(t or "")) for d, t, *_ in texts]
    assert sorted(map(tuple, found)) == sorted(want)
