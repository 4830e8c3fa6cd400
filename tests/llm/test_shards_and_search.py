"""Curve shards and exact search against brute force, and the registered queries against SQL."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check_queries import _rows
from sluicegate.llm import curve_shards, topk
from sluicegate.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 3), (3, 2), (4, 2)])
def test_hilbert_neighbours_differ_by_one_step(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side**dims).select(
        *(F.expr(f"cast(id div {side**d} % {side} as int)").alias(f"x{d}") for d in range(dims))
    )
    columns = [F.col(f"x{d}") for d in range(dims)]
    walk = cells.withColumn("h", curve_shards.hilbert_index(columns, bits)).orderBy("h").collect()
    assert [r.h for r in walk] == list(range(side**dims))
    for a, b in zip(walk, walk[1:], strict=False):
        assert sum(abs(a[f"x{d}"] - b[f"x{d}"]) for d in range(dims)) == 1


def test_shards(spark, tmp_path):
    texts = [None, "", "a", "same"] * 10 + [f"t{i} é" * (i % 50) for i in range(211)]
    rows = [(i if i % 9 else None, t, "en" if i % 4 else None, f"s{i % 3}", 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int, curve string")
    out = curve_shards.shard_documents(docs)
    got = out.collect()
    per_shard = Counter(r.shard for r in got)
    assert len(got) == len(rows) and set(per_shard) == set(range(40))
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    for s, n in per_shard.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)
    ranges = curve_shards.shard_ranges(out).collect()
    assert sum(r.rows for r in ranges) == len(rows)
    curve_shards.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).where("shard = 7").count() == per_shard[7]


def test_shards_of_few_and_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert curve_shards.shard_documents(spark.createDataFrame([], schema)).count() == 0
    few = curve_shards.shard_documents(spark.createDataFrame([(1, "a", None, None), (1, "a", None, None)], schema)).collect()
    assert [r.slot for r in few] == [0, 0] and len({r.shard for r in few}) == 2


def brute_top(rows, k=5):
    """The best k other rows of each query row; of equal scores the smaller id."""
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (q, a) in enumerate(vectors):
        if q % 5 == 0:
            others = [(i, b) for m, (i, b) in enumerate(vectors) if m != n and len(a) == len(b)]
            scored = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in others]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k(spark, block):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(20)]) for i in range(120)]
    rows += [(i + 200, rows[0][1]) for i in range(30)] + [(400, [0.0] * 20), (405, [0.0] * 20)]
    rows += [(500, None), (505, [None] * 20), (510, [float("nan")] * 20), (515, [float("inf")] * 20), (None, rows[1][1])]
    rows += [(520, [0.1, 0.2]), (525, [0.3, 0.1]), (530, []), rows[5], (5, [9.0] * 20)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, embedding array<float>, label int, score string")
    found = topk.top_k(topk.whole_numbers(df), F.col("vec_id") % 5 == 0, candidates=block, queries=block)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows)


def test_query_of_large_vectors_and_repeated_ids_matches_sql(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)]) for i in range(60)]
    rows += [(60, [3e6] + [0.1] * 15), (61, [-40000.0] * 16), (100, [1e6, 2.0] * 8)]
    rows += [(50, [0.5] * 16), (50, [0.5] * 16), (3, [0.9] * 16), (3, [0.8] * 16), rows[7]]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = QUERIES["op7_exact_top_k"](spark, str(tmp_path))
    want = con.execute(ORACLE_SQL["op7_exact_top_k"]).fetchall()
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)


def test_rows_of_one_id_are_queries_of_their_own(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0]), (3, [0.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(tuple(r) for r in topk.top_k(topk.whole_numbers(df), F.col("vec_id") % 50 == 0).collect())
    assert found == brute_top(rows) and len(found) == 8
    equal = spark.createDataFrame([(50, [1.0])] * 300, "vec_id long, embedding array<float>")
    found = topk.top_k(topk.whole_numbers(equal), F.lit(True), candidates=40, queries=40)
    assert found.groupBy("rank").count().collect() and {r["count"] for r in found.groupBy("rank").count().collect()} == {300}


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.whole_numbers(df), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    got = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLE_SQL[name])
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_query_covers_its_table(spark, sf_dir, name):
    ids = {r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    found = {r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()}
    assert found == ids or name == "op6_license_scan" and found < ids


def test_pipeline_runs(spark, sf_dir):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, sf_dir).count() > 0
