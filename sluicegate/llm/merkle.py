"""A Merkle manifest of a dataset: a tree per source, and a tree over the sources.

Rows become leaves, numbered within their source. Runs of ``ARITY`` consecutive nodes become
their parent, level by level, until a tree has one node. A level is one window over its runs:
lag and lead columns at fixed offsets, masked by a node's slot and by the length of its run,
hold its siblings, and the first child of a run hashes the parent. A window never holds more
than ``ARITY`` rows, so a source with a third of all rows is many small windows.

Defined results: null values are written ``-``; leaves of null ids come first, rows that share
an id are ordered by digest, equal rows are leaves of their own; a null source is a tree, the
first; an empty table has no leaves, no nodes and no root; a very long text is hashed like any
other, inside its row; other columns are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.llm.staging import staged

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The one tree over the sources.
TOP = "root"
_STEP = "struct<before: string, after: string>"


def digest_of(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of all inputs in a row."""
    return F.sha2(F.concat(*inputs), 256)


def written(value: Column) -> Column:
    """A value as a leaf holds it: its UTF-8 length, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: dict[str, Column]) -> Column:
    """The digest of a row."""
    return digest_of(*(written(values[f]) for f in FIELDS))


@dataclass(frozen=True)
class Manifest:
    """Levels of the trees per source (leaves first) and of the tree over them.

    Leaves have the columns of :func:`numbered` and those they came with; every level has tree,
    slot, n (nodes of that tree on that level) and digest.
    """

    sources: list[DataFrame]
    top: list[DataFrame]


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with slot, the place in their ``tree`` from 0, and n, the rows of the tree.

    A range sort with the row's digest and number as last keys spreads equal rows too; the
    sorted rows are written with their partition and place, and slots are these places moved
    by the rows of the tree in earlier partitions.
    """
    keys = [F.col("tree"), *order, F.col("digest"), F.col("row")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staged(ordered.withColumn("at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    return placed.join(moved, ["tree", "part"]).withColumn("slot", F.col("at") + F.col("shift")).drop("part", "shift", "at")


def leaves(docs: DataFrame) -> DataFrame:
    """Every row's leaf, in its source's tree: tree, slot, n, doc_id, digest, tampered.

    ``tampered`` is the digest of the row with A-Z of its text in lower case, for rows whose id
    has a checksum divisible by five, else null.
    """
    values = {f: F.col(f) for f in FIELDS}
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    hashed = docs.select(*FIELDS).select(
        "doc_id",
        written(F.col("source")).alias("tree"),
        leaf_of(values).alias("digest"),
        F.when(drawn, leaf_of(values | {"text": lowered})).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    return numbered(staged(hashed, "merkle-rows"), [F.col("doc_id").asc_nulls_first()], "merkle-leaves")


def _run() -> Column:
    return F.expr(f"slot div {ARITY}")


def _digests_beside(nodes: DataFrame) -> tuple[DataFrame, list[Column], list[Column]]:
    """Nodes with their run, and the digests before and after them in it; null where there is none."""
    window = Window.partitionBy("tree", "run").orderBy("slot")
    place = F.col("slot") % ARITY
    length = F.least(F.lit(ARITY), F.col("n") - F.col("run") * ARITY)
    before = [F.when(place >= k, F.lag("digest", k).over(window)) for k in range(ARITY - 1, 0, -1)]
    after = [F.when(place + k < length, F.lead("digest", k).over(window)) for k in range(1, ARITY)]
    return nodes.withColumn("run", _run()), before, after


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: trees of more than one node, each run as the digest of its nodes."""
    runs, _, after = _digests_beside(nodes.where("n > 1").select("tree", "slot", "n", "digest"))
    hashed = runs.select(
        "tree",
        "slot",
        F.col("run").alias("parent"),
        F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
        F.sha2(F.concat_ws("", "digest", *after), 256).alias("digest"),
    )
    return hashed.where(F.col("slot") % ARITY == 0).select("tree", F.col("parent").alias("slot"), "n", "digest")


def levels(first: DataFrame, label: str) -> list[DataFrame]:
    """All levels above numbered nodes, each written, up to the one where every tree has one node."""
    most = first.agg(F.max("n")).first()[0] or 0
    found = [first]
    while most > 1:
        found.append(staged(parents(found[-1]), f"{label}-{len(found)}"))
        most = -(-most // ARITY)
    return found


def build(docs: DataFrame) -> Manifest:
    """The manifest of a documents table."""
    below = levels(leaves(docs), "merkle-source")
    ends = [
        nodes.where("n = 1").select("tree", "digest", F.lit(k).alias("level")) for k, nodes in enumerate(below)
    ]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    # A tree is named by its source as written: what follows the first colon orders sources by bytes.
    source = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)"))
    ranked = subroots.select(
        F.lit(TOP).alias("tree"),
        F.col("tree").alias("source_tree"),
        "digest",
        "level",
        source.alias("source"),
        F.lit(0).cast("long").alias("row"),
    )
    top = numbered(ranked, [F.col("source").asc_nulls_first()], "merkle-subroots")
    return Manifest(below, levels(top, "merkle-top"))


def nodes(manifest: Manifest) -> DataFrame:
    """The manifest as a table: tree, level, slot, digest; the tree over the sources is ``root``."""
    found = [
        part.select("tree", F.lit(k).alias("level"), "slot", "digest")
        for group in (manifest.sources, manifest.top)
        for k, part in enumerate(group)
    ]
    table = found[0]
    for more in found[1:]:
        table = table.unionByName(more)
    return table


def _steps(level: DataFrame, above: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes with the path above them: their own siblings, then the path of their parent.

    ``above`` has tree, run, path and what else is carried down; a tree's last node has no
    siblings to name, its path is the one ``above`` has for the tree.
    """
    runs, before, after = _digests_beside(level)
    step = F.struct(F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))
    beside = runs.withColumn("step", step)
    carried = [c for c in above.columns if c not in ("tree", "run", "path")]
    path = F.when(F.col("n") > 1, F.concat(F.array("step"), F.col("path"))).otherwise(F.col("path"))
    return beside.join(above, ["tree", "run"]).select(*keep, *carried, path.alias("path"))


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its subroot, the root and its path: siblings before and after it, by level."""
    none = F.array().cast(f"array<{_STEP}>")
    above = manifest.top[-1].where("n = 1").select("tree", F.col("slot").alias("run"), none.alias("path"), F.col("digest").alias("root"))
    for part in reversed(manifest.top[1:]):
        above = staged(_steps(part, above, ["tree", F.col("slot").alias("run")]), "merkle-top-paths")
    sources = _steps(manifest.top[0], above, ["source_tree", F.col("digest").alias("subroot"), "level"])
    ends = staged(
        sources.select(
            F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("run"), "path", "subroot", "root", "level"
        ),
        "merkle-subroot-paths",
    )
    above = None
    for k in range(len(manifest.sources) - 1, -1, -1):
        last = ends.where(F.col("level") == k).drop("level")
        above = last if above is None else above.unionByName(last)
        keep = ["tree", F.col("slot").alias("run")] if k else ["doc_id", "digest", "tampered"]
        above = _steps(manifest.sources[k], above, keep)
        if k:  # a sixteenth of the nodes below; written, so that no plan holds more than a level
            above = staged(above, "merkle-source-paths")
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def verify(proven: DataFrame) -> DataFrame:
    """Every leaf, its proof's digest, and whether its (tampered) row still folds to the root."""
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["before"], step["after"])), "")
    folded = fold(F.coalesce("tampered", "digest"), F.col("path"))
    return proven.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
