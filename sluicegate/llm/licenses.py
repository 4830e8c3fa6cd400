"""License notices in texts: MinHash bands retrieve templates, shingle containment verifies them.

Texts and templates are compared as words (lower-case letters, digits and dots inside numbers).
Overlapping windows as long as a template are taken wherever one can match; each window gets a
MinHash signature over its two-word shingles, and a signature that agrees with a template's in
one of the bands makes the pair a candidate. What decides is exact: the share of the template's
shingles that stand in the window, widened by the distance between windows. Where notices of
several licenses differ in a word or two only, the shingles that tell them apart must stand there
as well (``MARKS``); of an SPDX line these are all, and of an expression the first license.

Where a window can match: a match holds more than a share t of a template's shingles, so if the
shingles that contain one of some anchor words make up at least 1 - t of all, a match contains
an anchor. Anchors are chosen per template to satisfy this; text without any is never hashed.

Bands: a window and a template that agree in a share J of their shingles collide in one of b
one-row bands with probability 1 - (1 - J)**b. Windows start at every word for templates up to
32 words and at every eighth of a template beyond, so a matching window has J of about 0.67 or
more, and 16 bands miss it once in 5 * 10**7.

Defined results: a null or empty text matches nothing and has no row; repeated rows match each
by itself; one row per text and template, with the best containment and in how many stretches it
occurs; a very long text is read in blocks; an empty table gives an empty result; other columns are neither read nor returned.

Shape: one pass over the texts; windows exist only around anchors; templates are a small table
(up to ``BROADCAST_TEMPLATES``, which are broadcast; more are joined by shuffle).
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
BANDS = 16
BROADCAST_TEMPLATES = 10_000
_WORD = "[a-z0-9]+(?:\\.[0-9]+)*"
#: Words of a text that go on together.
BLOCK = 1024
_COMMON = frozenset("a an and any are as at be by for from in is it its no not of on or that the this to under with".split())

#: Short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0",
    "all-rights-reserved": "All rights reserved",
}

_FREE = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License "
    "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version"
)
_CC = "This work is licensed under a Creative Commons {kind} 4.0 International License"
_SPDX = (
    "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 EPL-2.0 BSL-1.0 Zlib "
    "Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-NC-ND-4.0"
).split()

#: The notices that public licenses themselves prescribe, named by license and kind.
STANDARD = {
    "Apache-2.0/terms": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "MIT/permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "ISC/permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "BSD/redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "BSD/source-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer",
    "BSD/binary-clause": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSD-3-Clause/endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "Unlicense/dedication": "This is free and unencumbered software released into the public domain",
    "CC0-1.0/waiver": "has waived all copyright and related or neighboring rights to this work",
    "GPL-2.0/paragraph": _FREE.format(what="program", kind="General", version="2"),
    "GPL-3.0/paragraph": _FREE.format(what="program", kind="General", version="3"),
    "LGPL-2.1/paragraph": _FREE.format(what="library", kind="Lesser General", version="2.1"),
    "LGPL-3.0/paragraph": _FREE.format(what="library", kind="Lesser General", version="3"),
    "AGPL-3.0/paragraph": _FREE.format(what="program", kind="Affero General", version="3"),
    "CC-BY-4.0/sentence": _CC.format(kind="Attribution"),
    "CC-BY-SA-4.0/sentence": _CC.format(kind="Attribution-ShareAlike"),
    "CC-BY-ND-4.0/sentence": _CC.format(kind="Attribution-NoDerivatives"),
    "CC-BY-NC-4.0/sentence": _CC.format(kind="Attribution-NonCommercial"),
    "CC-BY-NC-SA-4.0/sentence": _CC.format(kind="Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0/sentence": _CC.format(kind="Attribution-NonCommercial-NoDerivatives"),
} | {f"{name}/spdx": f"SPDX-License-Identifier: {name}" for name in _SPDX}

#: Shingles that must stand in a match, where licenses share all other words of a notice. Every
#: match then holds the first word of the first of them.
MARKS = {
    "GPL-2.0/paragraph": ["gnu general", "version 2"],
    "GPL-3.0/paragraph": ["gnu general", "version 3"],
    "LGPL-2.1/paragraph": ["gnu lesser", "version 2.1"],
    "LGPL-3.0/paragraph": ["gnu lesser", "version 3"],
    "AGPL-3.0/paragraph": ["gnu affero", "version 3"],
    "CC-BY-4.0/sentence": ["attribution 4.0"],
    "CC-BY-SA-4.0/sentence": ["attribution sharealike", "sharealike 4.0"],
    "CC-BY-ND-4.0/sentence": ["attribution noderivatives", "noderivatives 4.0"],
    "CC-BY-NC-4.0/sentence": ["attribution noncommercial", "noncommercial 4.0"],
    "CC-BY-NC-SA-4.0/sentence": ["noncommercial sharealike", "sharealike 4.0"],
    "CC-BY-NC-ND-4.0/sentence": ["noncommercial noderivatives", "noderivatives 4.0"],
}


def template_words(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def _shingles(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))}) if words else []


def anchors(words: list[str], threshold: float) -> set[str]:
    """Words one of which stands in every text that holds a share ``threshold`` of the shingles.

    Rare words first: the longest that are not function words, until their shingles are more
    than a share 1 - ``threshold`` of all.
    """
    shingles = [s.split() for s in _shingles(words)]
    chosen: set[str] = set()
    order = sorted(Counter(words), key=lambda w: (w in _COMMON, -len(w), w))
    for word in order:
        covered = sum(1 for s in shingles if chosen & set(s))
        if covered > (1 - threshold) * len(shingles) + 1e-9:
            break
        chosen.add(word)
    return chosen


MARKS |= {
    name: [" ".join(pair) for pair in zip(w, w[1:], strict=False)]
    for name, w in ((n, template_words(t)) for n, t in STANDARD.items() if n.endswith("/spdx"))
}


def template_anchors(name: str, text: str, threshold: float) -> set[str]:
    """Anchors of a template: of its marks, if it has any, else of all its words."""
    return {MARKS[name][0].split()[0]} if name in MARKS else anchors(template_words(text), threshold)


def _step(size: int) -> int:
    return 1 if size <= 32 else size // 8


def template_table(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """license, size (words), step (between windows), shingles and marks of each template."""
    rows = []
    for name, text in templates.items():
        words = template_words(text)
        if len(words) < 2:
            raise ValueError(f"template {name!r} has fewer than two words")
        rows.append((name, len(words), _step(len(words)), _shingles(words), MARKS.get(name, [])))
    return spark.createDataFrame(rows, "license string, size int, step int, shingles array<string>, marks array<string>")


def signature(shingles: Column, bands: int = BANDS) -> Column:
    """The least hash of the shingles under each of ``bands`` hash functions."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(F.lit(band), s)))

    return F.array(*map(least, range(bands)))


def shingles_between(words: str, first: Column, size: Column) -> Column:
    """Distinct two-word shingles of ``size`` words from position ``first`` (from 1) on."""
    part = F.slice(words, first, size)
    pairs = F.zip_with(
        F.slice(words, first, size - 1),
        F.slice(words, first + 1, size - 1),
        lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b)),
    )
    return F.array_distinct(F.filter(F.when(F.size(part) > 1, pairs).otherwise(part), lambda s: s.isNotNull()))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES | STANDARD, threshold: float = THRESHOLD, bands: int = BANDS
) -> DataFrame:
    """doc_id, license, containment (the best), n_cells (stretches of text that hold a match), first_word (from 0).

    Words are dealt out in blocks that overlap by the widest window, so that what an occurrence of
    an anchor carries does not grow with its text; a window belongs to the first occurrence of the
    anchor in it, so that neighbouring occurrences do not make the same windows.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates, threshold)
    grids: dict[str, set[tuple[int, int]]] = {}
    for name, text in templates.items():
        size = len(template_words(text))
        for word in template_anchors(name, text, threshold):
            grids.setdefault(word, set()).add((size, _step(size)))
    chosen = sorted(grids)
    has_anchor = F.lit(False)
    lowered = F.lower(F.coalesce("text", F.lit("")))
    for word in chosen:
        has_anchor = has_anchor | F.contains(F.col("lowered"), F.lit(word))
    rows = (
        docs.select("doc_id", lowered.alias("lowered"))
        .where(has_anchor)
        .select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.regexp_extract_all("lowered", F.lit(f"({_WORD})")).alias("words"),
        )
    )
    widest = max(size + 2 * step for grid in grids.values() for size, step in grid)
    begin = lambda b: F.greatest(F.lit(1), b - widest)
    blocks = F.transform(
        F.sequence(F.lit(1), F.size("words"), F.lit(BLOCK)),
        lambda b: F.struct(
            b.alias("from"),
            (begin(b) - 1).alias("before"),
            F.slice("words", begin(b), b - begin(b) + BLOCK + widest).alias("words"),
        ),
    )
    cut = rows.where(F.size("words") > 0).select("doc_id", "row", F.explode(blocks).alias("block"))
    cut = cut.select("doc_id", "row", "block.*")
    places = F.filter(
        F.sequence(F.col("from"), F.least(F.col("from") + BLOCK - 1, F.col("before") + F.size("words"))),
        lambda i: F.array_contains(F.array(*(F.lit(w) for w in chosen)), F.element_at("words", (i - F.col("before")).cast("int"))),
    )
    at = cut.withColumn("anchor", F.explode(places)).withColumn("here", F.col("anchor") - F.col("before"))
    word = F.element_at("words", F.col("here"))
    back = F.greatest(F.lit(1), F.col("here") - widest)
    since = F.array_position(F.reverse(F.slice("words", back, F.col("here") - back)), word).cast("int")
    # Windows that hold the anchor, of each size of the templates it is chosen for, on the grid of
    # that size. Only the words around it go on.
    per_word = F.create_map(
        *(
            column
            for word in chosen
            for column in (
                F.lit(word),
                F.array(*(F.struct(F.lit(a).alias("size"), F.lit(b).alias("step")) for a, b in sorted(grids[word]))),
            )
        )
    )
    sizes = F.explode(F.element_at(per_word, word))
    behind = F.when(F.col("since") > 0, F.col("anchor") - F.col("since") + 1)  # after the occurrence before
    first = F.greatest(F.lit(1), F.col("anchor") - F.col("g.size") + 1, behind)
    on_grid = F.ceil((first - 1) / F.col("g.step")).cast("int") * F.col("g.step") + 1
    starts = F.when(on_grid <= F.col("anchor"), F.sequence(on_grid, F.col("anchor"), F.col("g.step")))
    windows = (
        at.withColumn("since", since)
        .withColumn("g", sizes)
        .withColumn("start", F.explode(starts))
        .select(
            "doc_id",
            "row",
            "start",
            F.col("g.size").alias("size"),
            F.col("g.step").alias("step"),
            shingles_between("words", F.col("start") - F.col("before"), F.col("g.size")).alias("shingles"),
            shingles_between(
                "words",
                F.greatest(F.lit(1), F.col("start") - F.col("g.step")) - F.col("before"),
                F.col("g.size") + 2 * F.col("g.step"),
            ).alias("around"),
        )
    )
    hashed = windows.select("*", F.posexplode(signature(F.col("shingles"), bands)).alias("band", "least"))
    banded = known.select(
        "license",
        F.col("size").alias("t_size"),
        F.col("shingles").alias("t_shingles"),
        "marks",
        F.posexplode(signature(F.col("shingles"), bands)).alias("t_band", "t_least"),
    )
    if len(templates) <= BROADCAST_TEMPLATES:
        banded = F.broadcast(banded)
    candidates = hashed.join(
        banded,
        (F.col("size") == F.col("t_size")) & (F.col("band") == F.col("t_band")) & (F.col("least") == F.col("t_least")),
    )
    share = F.size(F.array_intersect("t_shingles", "around")) / F.size("t_shingles")
    marked = F.size(F.array_except("marks", "around")) == 0
    verified = candidates.where(marked).select("doc_id", "row", "license", "start", "size", share.alias("containment")).where(
        F.col("containment") >= threshold
    )
    # One template's matches that overlap are one place: a start is new if none stands within
    # a template's length before it, so starts are counted by cells of that length.
    cell = F.floor(F.col("start") / F.col("size"))
    return (
        verified.groupBy("row", "doc_id", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.size(F.collect_set(cell)).cast("long").alias("n_cells"),
            (F.min("start") - 1).cast("long").alias("first_word"),
        )
        .select("doc_id", "license", "containment", "n_cells", "first_word")
    )
