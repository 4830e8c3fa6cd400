"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import (
    curve_shards,
    fim,
    jaccard,
    licenses,
    lm,
    merkle,
    mixing,
    packing,
    quality,
    sequences,
    substrings,
    topk,
    toxicity,
)
from sluicegate.workspace import staging_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document repeat an earlier one in runs of fifty, and what stays."""
    return substrings.removals(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY gram) AS least FROM g) WHERE least < doc_id),
c AS (SELECT DISTINCT doc_id, i + k AS pos FROM r, range(50) AS s(k)),
p AS (SELECT doc_id, w[pos] AS word, pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d)),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.pos) AS kept, count(*) AS n
      FROM p ANTI JOIN c ON p.doc_id = c.doc_id AND p.pos = c.pos GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-probability of every document under the recurrent model and under word counts."""
    return lm.score(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, its base rules and the current policy's verdict."""
    ledger = quality.apply_policy(quality.rule_ledger(_table(spark, sf_dir, "documents")))
    base = F.lit(quality.mask(quality.BASE)).cast("long")
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed").bitwiseAND(base) != 0).alias("base_failed"),
        "kept",
        "n_lines",
        "failed",
    )


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(5) AS s(k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines
  FROM d LEFT JOIN c USING (doc_id)),
f AS (
  SELECT *, n_words < 10 AS r0, 100 * n_repeat_words > 20 * n_words AS r1, 100 * n_symbols > 10 * word_chars AS r2,
         2 * n_dup_lines > n_lines AS r3, word_chars > 40 * n_words AS r4 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed,
       NOT (r0 OR r1 OR r2 OR r3 OR r4) AS kept, n_lines,
       CAST(r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT AS BIGINT) AS failed
FROM f
"""


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot along the Hilbert curve of source, language and size."""
    sharded = curve_shards.shard_documents(_table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op8_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every training sequence at its slot, with a checksum of its ids as they stand in the written shard."""
    path = staging_path(spark, "training-order")
    index = sequences.write_order(sequences.training_order(_table(spark, sf_dir, "documents")), path)
    return sequences.checksums(index, path).select(
        "doc_id", "part", "n_tokens", "number", "slot", "shard", "offset", "ids_crc32"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document, by template."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    vectors = topk.whole_numbers(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.n, c.n AS m, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.n <> c.n WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id, m) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingles and its component of links at a similarity of 0.85 on four words."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op10_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-the-middle form, and digests of its output and of what it restores to."""
    return fim.digests(_table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS h FROM documents),
k AS (SELECT doc_id, t, n, CAST('0x' || substring(h, 1, 8) AS BIGINT) % (n + 1) AS a,
             CAST('0x' || substring(h, 9, 8) AS BIGINT) % (n + 1) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR CAST('0x' || substring(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                  WHEN CAST('0x' || substring(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, least(a, b) AS p, greatest(a, b) AS m FROM k),
s AS (SELECT *, substring(t, 1, p) AS prefix, substring(t, p + 1, m - p) AS middle, substring(t, m + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf, its proof and whether it still folds to the dataset's root after tampering."""
    return merkle.verify(merkle.proofs(merkle.build(_table(spark, sf_dir, "documents"))))


def _merkle_sql(depth: int = 6) -> str:
    """Levels, proofs and folds of trees of up to 16 ** depth leaves, one clause per level."""
    written = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
    number = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    head = " || ".join([number.format("doc_id"), written.format("source"), written.format("lang"), number.format("n_chars")])
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    shift = "(x >> 1)" "::BIGINT"
    bit = "xor(x >> 1, (x & 1) * 3988292384::BIGINT)"
    eight = "list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: " + bit + ")"
    parts = [
        f"""
r AS (SELECT *, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
      FROM documents),
z AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, byte: {eight}), 4294967295::BIGINT) AS crc
      FROM r),
leaf AS (SELECT doc_id, source, sha256({head} || {written.format("text")}) AS digest,
                CASE WHEN crc % 5 = 0 THEN sha256({head} || {written.format(lowered)}) END AS tampered FROM z),
s0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest, rowid_) - 1 AS slot,
              count(*) OVER (PARTITION BY source) AS n, {written.format("source")} AS tree
       FROM (SELECT *, row_number() OVER () AS rowid_ FROM leaf))"""
    ]

    def above(prefix: str) -> None:
        for k in range(1, depth + 1):
            parts.append(
                f"{prefix}{k} AS (SELECT tree, slot // 16 AS slot, (any_value(n) + 15) // 16 AS n, "
                f"CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY slot)) ELSE any_value(digest) END AS digest "
                f"FROM {prefix}{k - 1} GROUP BY tree, slot // 16)"
            )

    above("s")
    parts.append(
        f"""
t0 AS (SELECT 'root' AS tree, s.tree AS source_tree, s.digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS slot,
              count(*) OVER () AS n
       FROM s{depth} AS s JOIN (SELECT DISTINCT tree, source FROM s0) AS names ON names.tree = s.tree)"""
    )
    above("t")

    def sides(prefix: str, carried: str) -> None:
        for k in range(depth):
            parts.append(
                f"{prefix}p{k} AS (SELECT tree, slot, digest, {carried if not k else ''} n, "
                "CASE WHEN n > 1 THEN coalesce(string_agg(digest, '' ) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l, "
                "CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r "
                f"FROM {prefix}{k} WINDOW w AS (PARTITION BY tree, slot // 16 ORDER BY slot))"
            )

    sides("s", "doc_id, tampered,")
    sides("t", "source_tree,")
    joins = [f"s0.n AS n0, s0.l AS l0, s0.r AS r0, {', '.join(f's{k}.n AS n{k}, s{k}.l AS l{k}, s{k}.r AS r{k}' for k in range(1, depth))}"]
    joins.append(", ".join(f"t{k}.n AS n{depth + k}, t{k}.l AS l{depth + k}, t{k}.r AS r{depth + k}" for k in range(depth)))
    source = "FROM sp0 AS s0 "
    for k in range(1, depth):
        source += f"JOIN sp{k} AS s{k} ON s{k}.tree = s0.tree AND s{k}.slot = s0.slot // {16**k} "
    source += "JOIN tp0 AS t0 ON t0.source_tree = s0.tree "
    for k in range(1, depth):
        source += f"JOIN tp{k} AS t{k} ON t{k}.slot = t0.slot // {16**k} "
    parts.append(
        f"f0 AS (SELECT s0.doc_id, s0.digest AS leaf, t0.digest AS subroot, coalesce(s0.tampered, s0.digest) AS node, "
        f"'' AS proof, {', '.join(joins)} {source})"
    )
    for k in range(2 * depth):
        parts.append(
            f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN n{k} > 1 THEN sha256(l{k} || node || r{k}) ELSE node END AS node, "
            f"proof || l{k} || r{k} AS proof) FROM f{k})"
        )
    last = 2 * depth
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, "
        f"node AS folded_root, node = t.digest AS verified FROM f{last}, t{depth} AS t"
    )


OP12_SQL = _merkle_sql()


def op13_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by the marginals of its tokens, and the places that offend."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_model": op2_language_model,
    "op3_quality_rules": op3_quality_rules,
    "op4_training_order": op4_training_order,
    "op5_hilbert_shards": op5_hilbert_shards,
    "op6_license_scan": op6_license_scan,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_fair_queue_mix": op8_fair_queue_mix,
    "op9_jaccard_components": op9_jaccard_components,
    "op10_packed_sequences": op10_packed_sequences,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_toxic_spans": op13_toxic_spans,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op7_exact_top_k": OP7_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
