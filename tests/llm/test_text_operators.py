"""Operators on texts against brute force, on small tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import jaccard, licenses, lm, mixing, packing, quality, sequences, substrings, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, node int, id string"
RARE = [None, "", "  \n\t", "a", "A b", "the same", "the same", "x " * 3000, "#$% " * 30, "é ü　ß z"]


def table(spark, rows):
    """A documents table with columns that clash with names used inside the operators."""
    full = [(d, t, "en" if i % 3 else None, s, len(t or ""), "r", i, "z") for i, (d, t, s) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(150)] + ["a", "b", "É", "Zz"]
    base = [[rng.choice(words) for _ in range(rng.randrange(60, 200))] for _ in range(8)]
    out = [(i, t, None if i % 2 else "s0") for i, t in enumerate(RARE)]
    for i in range(150):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.4:
            text = [rng.choice(words) for _ in range(rng.randrange(1, 60))] + text[rng.randrange(40) :]
        out.append((100 + i, rng.choice([" ", "\n", " \t"]).join(text), f"s{rng.randrange(5)}"))
    return [*out, (None, out[20][1], "s1"), (None, None, None), (500, out[30][1], "s2"), (500, out[30][1], "s2")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def words_of(text, lower=False):
    raw = (text or "").encode()
    if lower:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    return raw.split()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- substring removal ----------------------------------------------------------------------


def brute_removals(rows, size=substrings.WINDOW):
    key = lambda d: substrings.NULL_ID if d is None else d
    texts = [(d, words_of(t)) for d, t, _ in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - size + 1):
            gram = tuple(w[i : i + size])
            first[gram] = min(first.get(gram, key(d)), key(d))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < key(d):
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_removals(docs, rows):
    got = collected(substrings.removals(docs))
    assert got == brute_removals(rows)
    assert sum(r[2] for r in got) > 1000


def test_removals_of_runs_and_short_alphabets(spark):
    rng = random.Random(2)
    texts = ["a " * 200, "a " * 77 + "b", "b " + "a " * 60, "a b " * 90, "b " + "a b " * 40]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(40, 300))) for _ in range(40)]
    rows = [(i * 7 % 31, t, None) for i, t in enumerate(texts)]
    assert collected(substrings.removals(table(spark, rows))) == brute_removals(rows)


def test_remove_repeats(docs, rows):
    out = substrings.remove_repeats(docs)
    kept = out.collect()
    want = {(r[0], r[3]) for r in brute_removals(rows) if r[1] > r[2] or r[1] == 0}
    got = {(r.doc_id, hashlib.sha256(b" ".join(words_of(r.text))).hexdigest()) for r in kept}
    assert out.columns == docs.columns and got == want
    assert all(r.n_chars == len(r.text or "") for r in kept)


def test_every_window_has_an_anchor_that_all_its_copies_share():
    import numpy as np
    import pyarrow as pa

    from sluicegate.llm.words import find_words

    rng = random.Random(4)
    for alphabet in ("ab", "abcdefgh"):
        text = [rng.choice(alphabet) for _ in range(300)]
        copies = [" ".join([*(rng.choice(alphabet) for _ in range(k)), *text]) for k in range(40)]
        found = find_words(pa.array(copies))
        windows, anchor, symbol, ranges = substrings.anchored_windows(found)
        names = ranges.name(windows, windows + substrings.WINDOW)
        by_window = {}
        for name, own in zip(names.tolist(), symbol[anchor].tolist(), strict=True):
            assert by_window.setdefault(name, own) == own
        assert len(windows) == sum(len(words_of(c)) - 49 for c in copies) and np.all(anchor >= 0)


# -- language model -------------------------------------------------------------------------


def brute_base(rows):
    held = lambda d: zlib.crc32(("null" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter()
    for d, t, _ in rows:
        if not held(d):
            counts.update([*words_of(t, True), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t, _ in rows:
        w = [*words_of(t, True), None]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        out.append((d, held(d), len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("head", [lm.HEAD, 40])
def test_base_score(docs, rows, head):
    got = [(*r[:5], round(r[5], 6)) for r in collected(lm.score(docs, rounds=1, head=head))]
    assert sorted(got, key=repr) == brute_base(rows)


def test_model_beats_counts_on_held_out_documents(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):  # two languages: a model that remembers which is right more often
        own = [f"{'ab'[i % 2]}{k}" for k in range(30)]
        rows.append((i, " ".join(rng.choice(own) for _ in range(60)), None))
    held = [r for r in lm.score(table(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_gradients_are_the_slopes_of_the_loss():
    import numpy as np

    rng = np.random.default_rng(0)
    flat = (lm.Gru.start(np.ones(lm.CLASSES)) * 3).astype(np.float64)
    x, target = rng.integers(1, lm.CLASSES, (4, 3)), rng.integers(0, lm.CLASSES, (4, 3))
    x[2, 1] = 0

    def run(weights, want_gradient=False):
        net = lm.Gru(weights)
        h, steps, states = np.zeros((3, lm.HIDDEN)), [], np.zeros((4, 3, lm.HIDDEN))
        for t in range(4):
            h, record = net.step(x[t], h * (x[t] != 0)[:, None])
            steps.append(record)
            states[t] = h
        p = net.classes(states.reshape(-1, lm.HIDDEN).copy())
        loss = -np.log(p[np.arange(12), target.ravel()]).mean()
        return (loss, net.gradients(steps, states, target, np.ones((4, 3)))) if want_gradient else loss

    _, gradient = run(flat, True)
    for i in rng.choice(np.flatnonzero(gradient), 40, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert abs((run(up) - run(down)) / 2e-5 - gradient[i]) < 1e-4


def test_score_is_a_chain_of_class_probabilities():
    import numpy as np

    flat = lm.Gru.start(np.ones(lm.CLASSES), seed=3)
    net, text = lm.Gru(flat), np.array([5, 60, 2, 0], np.uint16)
    h, before, total = np.zeros((1, lm.HIDDEN), np.float32), np.zeros(1, np.int64), 0.0
    for c in text:
        h, _ = net.step(before, h)
        p = net.classes(h.copy())
        assert abs(p.sum() - 1) < 1e-5
        total += math.log10(p[0, c])
        before = np.array([c])
    others = [np.array([0], np.uint16), np.arange(1, 60, dtype=np.uint16)]
    assert abs(lm.score_texts(flat, [others[0], text, others[1]])[1] - total) < 1e-4


# -- quality rules --------------------------------------------------------------------------


def brute_measures(text):
    raw = text or ""
    w = [x.decode() for x in words_of(raw)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in raw.split("\n") if words_of(x)]
    symbols = sum(raw.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_measures(docs, rows):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    want = sorted(((d, *brute_measures(t)) for d, t, _ in rows), key=repr)
    assert collected(quality.measure(docs).select(*names)) == want


def test_policies_and_ablation(docs):
    ledger = quality.rule_ledger(docs)
    rows = quality.apply_policy(ledger).collect()
    assert [r.kept for r in rows] == [r.failed & quality.mask(quality.POLICIES[quality.CURRENT]) == 0 for r in rows]
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    effect = {r.rule: r for r in quality.ablation(ledger).collect()}
    for rule in quality.RULES:
        bit = 1 << rule.bit
        assert effect[rule.name].fails == sum(bool(r.failed & bit) for r in rows)
        assert effect[rule.name].fails_alone == sum(r.failed == bit for r in rows)
        assert effect[rule.name].kept_without == sum(r.failed & ~bit == 0 for r in rows)


# -- training order -------------------------------------------------------------------------


def encoded(text):
    return [*tokens.encoder().encode_ordinary(text or ""), tokens.END]


def test_ranks_give_the_ids_of_the_tokenizers_file(sf_dir, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["", " ", "don't  we'll", "a　b  c", "x<|endoftext|>y", "\r\n\t a", "日本 語", "a" * 300]
    assert [encoded(t)[:-1] for t in texts] == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_are_encoded_as_in_the_tokenizers_file(spark):
    import numpy as np
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext| >", "<|ENDOFTEXT|>", "", "it's"]
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    flat, before = tokens.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, before[1:-1])] == want
    assert want[0] == [64, 220, 50256, 275]
    pieces = packing.pack(table(spark, [(1, texts[0], "s")])).collect()
    assert [r.doc_tokens for r in pieces] == [len(want[0]) + 1]
    ordered = sequences.training_order(table(spark, [(1, texts[0], "s")])).collect()
    assert np.frombuffer(ordered[0].ids, tokens.id_type())[:5].tolist() == [*want[0], tokens.END]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    import numpy as np

    slots = sequences.feistel(np.arange(size), size, 7)
    assert sorted(slots.tolist()) == list(range(size))
    assert size < 90 or (slots != sequences.feistel(np.arange(size), size, 8)).any()


def test_training_order_holds_every_token_and_resumes(spark, docs, rows, tmp_path):
    import numpy as np

    ordered = sequences.training_order(docs, length=64, per_shard=50, key=3)
    got = ordered.collect()
    assert [r.slot for r in got] == list(range(len(got)))
    stride = 64 * np.dtype(tokens.id_type()).itemsize
    assert all(r.shard == r.slot // 50 and r.offset == r.slot % 50 * stride and len(r.ids) == stride for r in got)
    parts = Counter()
    for r in got:
        parts[r.doc_id, tuple(np.frombuffer(r.ids, tokens.id_type())[: r.n_tokens].tolist()), r.part] += 1
    want = Counter()
    for d, t, _ in rows:
        ids = encoded(t)
        for p, i in enumerate(range(0, len(ids), 64)):
            want[d, tuple(ids[i : i + 64]), p] += 1
    assert parts == want
    sequences.write_order(ordered, str(tmp_path / "order"))
    again = sequences.read_from(spark, str(tmp_path / "order"), 45, 30, per_shard=50).collect()
    assert [(r.slot, r.ids) for r in again] == [(r.slot, r.ids) for r in got[45:75]]


def test_shards_are_raw_files_of_a_fixed_stride(spark, docs, tmp_path):
    import numpy as np

    ordered = sequences.training_order(docs, length=64, per_shard=50, key=3)
    got = ordered.collect()
    index = sequences.write_order(ordered, f"file://{tmp_path}/order")
    files = sorted((tmp_path / "order" / "shards").iterdir())
    assert [f.name for f in files] == [f"{i:08d}.ids" for i in range(-(-len(got) // 50))]
    stride = 64 * np.dtype(tokens.id_type()).itemsize
    assert [f.stat().st_size for f in files] == [min(50, len(got) - 50 * i) * stride for i in range(len(files))]
    for r in got:
        with open(files[r.shard], "rb") as file:
            file.seek(r.offset)
            assert file.read(stride) == r.ids
    sums = {r.slot: r.ids_crc32 for r in sequences.checksums(index, f"file://{tmp_path}/order").collect()}
    assert sums == {r.slot: zlib.crc32(r.ids) for r in got}
    files[1].write_bytes(b"\0" * files[1].stat().st_size)  # what is read is the shard, not the table
    again = sequences.read_from(spark, f"file://{tmp_path}/order", 45, 10, per_shard=50).collect()
    assert [r.ids for r in again] == [r.ids for r in got[45:50]] + [b"\0" * stride] * 5
    last = sequences.read_from(spark, f"file://{tmp_path}/order", len(got) - 3, 10, per_shard=50).collect()
    assert [r.slot for r in last] == [len(got) - 3, len(got) - 2, len(got) - 1]


def test_shards_are_written_in_waves(spark, docs, tmp_path, monkeypatch):
    """No wave shuffles more than half of the sequences, the last ones a fifth."""
    waves = []

    def staged(df, label, *how):
        waves.append(kept(df, label, *how))
        return waves[-1]

    ordered = sequences.training_order(docs, length=64, per_shard=20, key=3)
    want = ordered.drop("ids").collect()
    kept = sequences.staged
    monkeypatch.setattr(sequences, "staged", staged)
    monkeypatch.setattr(sequences, "drop_staged", lambda *tables: None)
    index = sequences.write_order(ordered, str(tmp_path / "order"))
    assert sorted(index.drop("stride").collect(), key=lambda r: r.slot) == want
    rows = [wave.count() for wave in waves]
    shards = -(-len(want) // 20)
    assert shards > 10 and sum(rows) == len(want) and max(rows) <= 20 * (shards // 2 + 1) and rows[-1] <= 20 * (shards // 5 + 1)
    assert len(list((tmp_path / "order" / "shards").iterdir())) == shards


# -- license scan ---------------------------------------------------------------------------


def brute_licenses(rows, threshold=licenses.THRESHOLD):
    out = set()
    for d, t, _ in rows:
        w = licenses.template_words(t or "")
        for name, text in licenses.TEMPLATES.items():
            own = licenses.template_words(text)
            shingles, size, step = set(licenses._shingles(own)), len(own), licenses._step(len(own))
            best = max(
                (
                    len(shingles & set(licenses._shingles(w[max(0, i - step) : max(0, i - step) + size + 2 * step])))
                    / len(shingles)
                    for i in range(0, len(w), step)
                ),
                default=0,
            )
            if best >= threshold:
                out.add((d, name, round(best, 6)))
    return out


def test_license_scan(spark):
    fill = "lorem ipsum dolor sit amet " * 4
    texts = [None, "", "license", "license " * 50, fill]
    for i, text in enumerate(licenses.TEMPLATES.values()):
        texts += [text, fill + text + ". " + fill, fill + text.upper() + "\n" + text]
        cut = text.split()
        texts.append(" ".join([*cut[: i % 3 + 2], "really", *cut[i % 3 + 2 :]]) + " " + fill)
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(3, texts[6], None)]
    got = {(r.doc_id, r.license, round(r.containment, 6)) for r in licenses.scan_licenses(table(spark, rows)).collect()}
    want = brute_licenses(rows)
    best = {}
    for d, name, share in want:
        best[d, name] = max(share, best.get((d, name), 0))
    assert got == {(*k, v) for k, v in best.items()}


def test_anchors_stand_in_every_match():
    for text in licenses.TEMPLATES.values():
        own = licenses.template_words(text)
        shingles = [s.split() for s in licenses._shingles(own)]
        chosen = licenses.anchors(own, licenses.THRESHOLD)
        without = sum(1 for s in shingles if not chosen & set(s))
        assert without < licenses.THRESHOLD * len(shingles)


def test_notices_that_are_not_copied_from_the_templates(spark):
    gpl = """ * {0} is free software; you can redistribute it and/or modify
 * it under the terms of the GNU {1} Public License as published by
 * the Free Software Foundation; either version {2} of the License, or
 * (at your option) any later version."""
    cases = [
        ("Text. All rights reserved.", {"all-rights-reserved"}),
        ("Copyright 2020 Jane Doe. All rights reserved.", {"all-rights-reserved"}),
        ("Copyright (c) 1999-2004, Acme Inc.\nAll Rights Reserved", {"all-rights-reserved"}),
        (
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
            'documentation files (the "Materials"), to deal in the Materials without restriction, including without limitation '
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Materials, and",
            {"MIT/permission"},
        ),
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
            "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
            "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
            "with the distribution. 3. Neither the name of Acme Inc. nor the names of its contributors may be used to endorse "
            "or promote products derived from this software without specific prior written permission.",
            {"BSD/redistribution", "BSD/source-clause", "BSD/binary-clause", "BSD-3-Clause/endorsement"},
        ),
        (gpl.format("Foo", "General", "3"), {"GPL-3.0/paragraph"}),
        (gpl.format("This program", "General", "2"), {"GPL-2.0/paragraph"}),
        (gpl.format("Bar", "Lesser General", "2.1"), {"LGPL-2.1/paragraph"}),
        (gpl.format("This file", "Affero General", "3"), {"AGPL-3.0/paragraph"}),
        ("// SPDX-License-Identifier: GPL-3.0-or-later\nint x;", {"GPL-3.0/spdx"}),
        ("# SPDX-License-Identifier: MIT", {"MIT/spdx"}),
        ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", {"CC-BY-NC-SA-4.0/spdx"}),
        (
            "This article is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
            {"CC-BY-SA-4.0/sentence"},
        ),
        ("all the rights of man reserved in version 3 of the gnu list", set()),
    ]
    rows = [(i, f"lorem ipsum {t} dolor sit", None) for i, (t, _) in enumerate(cases)]
    got = {i: set() for i in range(len(cases))}
    for r in licenses.scan_licenses(table(spark, rows)).collect():
        got[r.doc_id].add(r.license)
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    for name, text in licenses.STANDARD.items():
        shingles = licenses._shingles(licenses.template_words(text))
        chosen = licenses.template_anchors(name, text, licenses.THRESHOLD)
        without = sum(1 for s in shingles if not chosen & set(s.split()))
        assert set(licenses.MARKS.get(name, [])) <= set(shingles)
        assert name in licenses.MARKS or without < licenses.THRESHOLD * len(shingles)


# -- mixing ---------------------------------------------------------------------------------


def brute_targets(sizes, weights=mixing.WEIGHTS):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 3 * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in free}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_mix(docs, rows):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
    want = brute_targets(sizes)
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(words_of(t))) for d, t, _ in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(0 <= want[s] - taken[s] + 1e-6 <= largest[s] + 1e-5 for s in sizes)
    assert sum(taken.values()) <= sum(want.values()) + 1e-6
    assert collected(mixing.mix(docs)) == sorted((tuple(r) for r in got), key=repr)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(taken.values())


def test_mix_does_not_depend_on_the_split_or_order_of_its_input(spark, rows):
    docs = table(spark, rows)
    taken = lambda df: sorted(((r.doc_id, r.source, r.text_hash, r.taken) for r in mixing.mix(df).collect()), key=repr)
    want = taken(docs.coalesce(1))
    assert taken(docs.repartition(7)) == want and taken(table(spark, rows[::-1])) == want


def test_mix_when_small_sources_are_full(spark):
    rows = [(i, "w " * (5 if i % 2 else 300), "ab"[i % 2]) for i in range(40)]
    got = {r.source: r.target for r in mixing.mix(table(spark, [*rows, (99, None, "c"), (98, "x", None)])).collect()}
    sizes = {"a": 6000, "b": 100, "c": 0, None: 1}
    assert got == pytest.approx(brute_targets(sizes))


# -- Jaccard join ---------------------------------------------------------------------------


def brute_components(rows, words, percent):
    key = lambda d: substrings.NULL_ID if d is None else d
    sets = []
    for _, t, _ in rows:
        w = words_of(t, True)
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        sets.append(grams or ({tuple(w)} if w else set()))
    label, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for x, (d, _, _) in zip(label, rows, strict=True):
        least[x] = min(least.get(x, key(d)), key(d))
    known = lambda v: None if v == substrings.NULL_ID else v
    return sorted(
        ((d, len(sets[i]), known(least[label[i]]), links[i]) for i, (d, _, _) in enumerate(rows)), key=repr
    )


@pytest.mark.parametrize(("words", "percent", "chunk"), [(4, 85, 1 << 18), (5, 80, 500), (1, 50, 300)])
def test_jaccard_components(docs, rows, monkeypatch, words, percent, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    assert collected(jaccard.jaccard_components(docs, words, percent)) == brute_components(rows, words, percent)


def test_chunks_are_bounded_by_their_number_of_sets(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(jaccard, "SETS", 40)
    monkeypatch.setattr(jaccard, "ROWS", 16)
    # Nodes that meet at one name: many short sets of one label.
    found = spark.range(600).selectExpr("0L level", "5L name", "id node", "4L n", "true asks")
    nodes, pairs = jaccard.chunk_pairs(found)
    sizes = [r["count"] for r in nodes.groupBy("chunk").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 2 * 40
    assert max(r["count"] for r in pairs.groupBy("a", "b").count().collect()) <= 4 * 40
    sets = [set(np.random.default_rng(i).integers(0, 60, 20).tolist()) for i in range(70)]
    name = np.array([x for s in sets for x in s], np.uint64)
    owner = np.repeat(np.arange(70), [len(s) for s in sets])
    blocks = list(jaccard.overlaps(name, owner, 70))
    assert max(len(b) for _, b in blocks) <= 16 and [f for f, _ in blocks] == [0, 16, 32, 48, 64]
    assert np.concatenate([b for _, b in blocks]).tolist() == [[len(a & b) for b in sets] for a in sets]
    short = [(i, f"click here to read more about X{i // 2}", "s") for i in range(120)]
    assert collected(jaccard.jaccard_components(table(spark, short), 4, 85)) == brute_components(short, 4, 85)


def test_only_sets_of_similar_sizes_are_brought_together(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SETS", 40)
    # One name in 600 sets of eight sizes, each twice the one before.
    found = spark.range(600).selectExpr("0L level", "5L name", "id node", "shiftleft(10L, CAST(id % 8 AS int)) n", "true asks")
    nodes, pairs = jaccard.chunk_pairs(found, 85)
    together = pairs.join(found.select("node", "n"), "node").groupBy("a", "b").agg(F.countDistinct("n").alias("sizes"))
    assert nodes.count() == 600 and {r.sizes for r in together.collect()} == {1}
    # Name 1 is in sets of 100, 86 and 10 names, name 2 in ones of 100 and 84.
    sets = [(1, 100, [1, 2]), (2, 86, [1]), (3, 10, [1]), (4, 84, [2])]
    scanned = spark.createDataFrame(sets, "node long, n long, prefix array<long>")
    shared = jaccard.shared_names(scanned, 85).collect()
    assert sorted((r.node, r.name, r.df) for r in shared) == [(1, 1, 3), (2, 1, 3)]


def test_components_of_nested_texts_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SETS", 6)
    rows = [(k, " ".join(f"w{i}" for i in range(k)), "s") for k in range(4, 260, 3)]
    rows += [(1000 + k, " ".join(f"w{i}" for i in range(k, 2 * k)), "s") for k in range(4, 130, 3)]
    assert collected(jaccard.jaccard_components(table(spark, rows), 4, 85)) == brute_components(rows, 4, 85)


def test_texts_that_meet_nothing_fall_out_before_the_shuffle(spark):
    texts = spark.range(20_000).selectExpr("id", "xxhash64(id) text_hash")
    chosen = texts.where("id % 1000 = 7")
    kept = {r.id for r in jaccard.likely(texts, chosen).collect()}
    assert {r.id for r in chosen.collect()} <= kept and len(kept) < 40


def test_keep_one(docs, rows):
    kept = jaccard.keep_one(docs)
    want = Counter(r[1] for r in {(r[0], r[2]) for r in brute_components(rows, 5, 80) if r[1] and r[0] == r[2]})
    got = Counter(r.doc_id for r in kept.collect() if words_of(r.text))
    assert kept.columns == docs.columns and got == want


def test_keep_one_of_texts_without_an_id_and_with_one_id(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(None, text("a"), "s"), (None, text("b"), "s"), (None, text("a"), "t"), (7, text("c"), "s"), (7, text("d"), "s")]
    rows += [(None, text("e"), "s"), (3, text("e") + " more", "s"), (None, "short one", "s")]
    got = Counter((r.doc_id, r.text) for r in jaccard.keep_one(table(spark, rows)).collect())
    assert got == Counter([(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (3, text("e") + " more"), (None, "short one")])


# -- packing --------------------------------------------------------------------------------


def brute_first_fit(sizes, room):
    bins, where = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, used in enumerate(bins) if used + sizes[i] <= room), len(bins))
        if at == len(bins):
            bins.append(0)
        where[i] = (at, bins[at])
        bins[at] += sizes[i]
    return where


def test_tournament_packs_as_first_fit_decreasing():
    import numpy as np

    rng = random.Random(8)
    for n in (1, 2, 3, 17, 200):
        sizes = [rng.randrange(1, 101) for _ in range(n)]
        bins, offsets = packing.first_fit_decreasing(np.array(sizes), 100)
        assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == brute_first_fit(sizes, 100)


def test_pack(docs, rows):
    got = packing.pack(docs, length=128, group_size=40, keep_ids=True).collect()
    by_doc, by_sequence = Counter(), {}
    for r in got:
        ids = tuple(r.ids)
        assert len(ids) == r.length and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)) == r.ids_crc32
        by_doc[r.doc_id, r.start, r.doc_tokens, ids] += 1
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = Counter()
    for d, t, _ in rows:
        ids = encoded(t)
        for i in range(0, len(ids), 128):
            want[d, i, len(ids), tuple(ids[i : i + 128])] += 1
    assert by_doc == want
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 128


# -- empty tables ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "operator",
    [
        substrings.removals, substrings.remove_repeats, lm.score, quality.rule_ledger, quality.keep_documents,
        sequences.training_order, licenses.scan_licenses, mixing.mix, mixing.mix_documents,
        jaccard.jaccard_components, jaccard.keep_one, packing.pack,
    ],
)
def test_empty_table(empty, operator):
    assert operator(empty).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").where(F.col("doc_id").isNotNull())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, "")
        assert out.columns == rows.columns and out.dtypes == rows.dtypes
        rows = spark.createDataFrame(out.collect(), out.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, rows, "")
    assert sum(r.length for r in last.collect()) == sum(len(encoded(r.text)) for r in rows.collect())


# -- rows without an id, one id for many rows, very long texts --------------------------------


def many_of(spark, ids):
    """Texts of 60 words under the given ids: each third is near another, two are equal, one repeats a passage."""
    rng = random.Random(21)
    rows = []
    for i in ids:
        words = [f"v{rng.randrange(5000)}" for _ in range(60)]
        if rows and rng.random() < 0.3:
            words = rows[rng.randrange(len(rows))][1].split()
            if rng.random() < 0.7:
                words[rng.randrange(60)] = "changed"
        rows.append((i, " ".join(words), "s"))
    return rows, table(spark, rows)


@pytest.mark.parametrize("kind", ["a third without id", "one id for half"])
def test_ids_do_not_bring_texts_together(spark, kind):
    ids = [None if kind == "a third without id" and i % 3 == 0 else 7 if kind == "one id for half" and i % 2 else 100 + i for i in range(240)]
    rows, docs = many_of(spark, ids)
    assert collected(substrings.removals(docs)) == sorted(brute_removals(rows), key=repr)
    found = jaccard.jaccard_components(docs, words=4, percent=85).select("doc_id", "n_shingles", "component_id")
    assert collected(found) == sorted(((d, n, c) for d, n, c, *_ in brute_components(rows, 4, 85)), key=repr)


def test_joins_are_by_id_and_text(spark, plan):
    """No join or grouping of whole texts is by id alone, or a million rows without an id would be one."""
    _, docs = many_of(spark, [None] * 30)
    texts = jaccard._keyed(docs)
    assert "text_hash" in texts.columns and substrings.KEY == ["id", "text_hash"]
    scanned = substrings.scan(docs)
    shared = plan(substrings.shared_symbols(scanned))
    assert "hashpartitioning(id#" not in shared or "text_hash" in shared.split("hashpartitioning(id#")[1][:40]


def test_memory_of_the_model_does_not_follow_the_longest_text():
    """Windows are laid out one by one: 200 short texts beside one of 60,000 tokens."""
    import tracemalloc

    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 40, 20).astype("<u2") for _ in range(200)] + [rng.integers(1, 40, 60_000).astype("<u2")]
    flat = lm.Gru.start(np.ones(lm.CLASSES), 0)
    tracemalloc.start()
    scores = lm.score_texts(flat, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6 and np.isfinite(scores).all()
    alone = lm.score_texts(flat, texts[-1:])
    assert math.isclose(scores[-1], alone[0], rel_tol=1e-4)


def test_texts_of_many_words(spark):
    """A text of 60,000 words goes through the operators on texts like any other."""
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(20_000)}" for _ in range(60_000))
    rows = [(1, long, "s"), (2, "a short text of ten words or some more of them", "s"), (3, long, "t")]
    docs = table(spark, rows)
    assert collected(substrings.removals(docs)) == sorted(brute_removals(rows), key=repr)
    found = {r.doc_id: r for r in jaccard.jaccard_components(docs).collect()}
    assert [found[i].component_id for i in (1, 2, 3)] == [1, 2, 1]
    assert {r.doc_id: r.n_words for r in quality.rule_ledger(docs).collect()} == {1: 60_000, 2: 11, 3: 60_000}
    assert mixing.mix(docs).count() == 3 and lm.score(docs).count() == 3


def test_license_scan_of_long_texts(spark):
    """16,000 times the same anchor, and notices across the ends of blocks, in time that follows the text."""
    notice = "Licensed under the Apache License, Version 2.0"
    spread = " ".join(f"w{i}" for i in range(licenses.BLOCK - 4)) + " " + notice + " " + "x " * 3000 + notice
    rows = [(1, "license " * 16_000, None), (2, spread, None), (3, "the license of the " * 4000 + notice, None)]
    got = {(r.doc_id, r.license, round(r.containment, 6)) for r in licenses.scan_licenses(table(spark, rows)).collect()}
    best = {}
    for d, name, share in brute_licenses(rows[1:]):
        best[d, name] = max(share, best.get((d, name), 0))
    assert got == {(*k, v) for k, v in best.items()} and (2, "Apache-2.0", 1.0) in got


def test_templates_beyond_a_broadcast_are_joined(spark, monkeypatch):
    rows = [(1, "Released under the MIT License", None), (2, "nothing", None)]
    monkeypatch.setattr(licenses, "BROADCAST_TEMPLATES", 0)
    found = [(r.doc_id, r.license) for r in licenses.scan_licenses(table(spark, rows)).collect()]
    assert found == [(1, "MIT")]
