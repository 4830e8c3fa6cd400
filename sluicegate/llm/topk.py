"""Exact inner-product search by columnar branch and bound.

Candidates stand in vertical layout, a row per dimension. Scores are summed up block of
dimensions by block, the widest dimensions first; after each block, what the remaining
dimensions can still add to or take from a score is bounded by the product of the remaining
norms, and candidates that can no longer reach the k-th best are compacted away.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part;
ties go to the smaller id, then to either of rows that share it; only vectors of one length are
compared; rows are candidates and queries of their own, also equal ones and those that share an
id (such a query id has k results for each of its rows); a null id takes no part; an empty table
gives an empty result; other columns are neither read nor returned.

Shape: candidates and queries are cut into blocks by hash, and each pair of a query block and a
candidate block is one group of bounded size. The best k of each pair meet in one window per
query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.llm.staging import arrow_groups, staged

K = 5
CANDIDATES = 4096
QUERIES = 4096
DIMENSIONS = 8
_LARGEST = 2**26


def whole_numbers(vectors: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and v: floor(scale * x) of every component x, for the rows that take part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    )
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    whole = vectors.where(F.col(vector).isNotNull() & F.col("vec_id").isNotNull()).where(finite)
    return whole.select("vec_id", numbers.alias("v"))


def branch_and_bound(
    query: np.ndarray, columns: np.ndarray, left: np.ndarray, ids: np.ndarray, others: np.ndarray, k: int, step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k best candidates of one query among ``others``.

    ``columns`` holds a dimension per row; ``left`` the candidates' norms over the dimensions
    from each block on. All numbers are whole and small enough to be exact.
    """
    alive = np.flatnonzero(others)
    score = np.zeros(len(alive))
    rest = np.sqrt(np.append(np.cumsum((query**2)[::-1])[::-1], 0.0))
    for b, d in enumerate(range(0, len(query), step)):
        score = score + query[d : d + step] @ (columns[d : d + step] if len(alive) == len(ids) else columns[d : d + step, alive])
        if len(alive) > k and d + step < len(query):
            slack = rest[d + step] * left[b + 1, alive] * (1 + 1e-9) + 1e-6
            reach = np.partition(score - slack, -k)[-k]  # k candidates score at least this
            keep = score + slack >= reach
            alive, score = alive[keep], score[keep]
    best = np.lexsort((ids[alive], -score))[:k]
    return alive[best], score[best]


def search_large(q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_rows: np.ndarray, c_ids: np.ndarray, k: int):
    """The k best candidates of each query in whole numbers: of 64 bits where they hold every score, else Python's."""
    largest = [max(abs(int(x.max())), abs(int(x.min()))) for x in (q, c)]
    kind = np.int64 if largest[0] * largest[1] * q.shape[1] < 2**63 else object
    q, c = q.astype(kind), c.astype(kind)
    found = []
    for i, query in enumerate(q):
        others = np.flatnonzero(c_rows != q_rows[i])
        scores = c[others] @ query
        order = np.lexsort((c_ids[others], -scores)) if kind is np.int64 else sorted(
            range(len(others)), key=lambda j: (-scores[j], c_ids[others[j]])
        )
        found += [(i, others[j], scores[j]) for j in order[:k]]
    # An int64 refuses a score beyond 64 bits, as BIGINT does.
    return tuple(np.array([int(row[i]) for row in found], np.int64) for i in range(3))


def search_block(
    q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_rows: np.ndarray, c_ids: np.ndarray, k: int, step: int = DIMENSIONS
):
    """The k best candidates of each query of a block: places of queries and of candidates, scores.

    A query is not its own candidate: rows of the same number in ``q_rows`` and ``c_rows``.
    """
    width = np.argsort(-(c.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    columns = np.ascontiguousarray(c[:, width].T, np.float64)
    q_whole, q = q, q[:, width].astype(np.float64)
    if columns.size and q.size and max(abs(columns).max(), abs(q).max()) > _LARGEST / max(1, len(columns)) ** 0.5:
        return search_large(q_whole, q_rows, c, c_rows, c_ids, k)
    squares = np.add.reduceat(columns**2, np.arange(0, len(columns), step), axis=0) if columns.size else columns
    left = np.sqrt(np.append(np.cumsum(squares[::-1], axis=0)[::-1], np.zeros((1, len(c_ids))), axis=0))
    found = [branch_and_bound(q[i], columns, left, c_ids, c_rows != q_rows[i], k, step) for i in range(len(q))]
    sizes = [len(p) for p, _ in found]
    where = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
    score = np.concatenate([s for _, s in found]) if found else np.zeros(0)
    return np.repeat(np.arange(len(q)), sizes), where.astype(np.int64), score.astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, candidates: int = CANDIDATES, queries: int = QUERIES):
    """query_id, rank, vec_id, score: the k best other vectors of each query.

    ``vectors`` has vec_id and v, an array of whole numbers; ``is_query`` tells query rows.
    """
    numbered = vectors.select("vec_id", "v", is_query.alias("asks"), F.monotonically_increasing_id().alias("row"))
    sized = staged(numbered, "top-k-rows")  # a row keeps its number wherever it is read
    counts = sized.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, asking = max(1, -(-counts[0] // candidates)), max(1, -(-counts[1] // queries))
    mine = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    mine_asking = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(asking)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kept = ["vec_id", "row", "v"]
    sides = sized.select(*kept, F.lit(False).alias("asks"), mine.alias("c"), all_of(asking).alias("q")).union(
        sized.where("asks").select(*kept, "asks", all_of(blocks).alias("c"), mine_asking.alias("q"))
    )

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks, ids, rows = (table.column(c).to_numpy() for c in ("asks", "vec_id", "row"))
        vectors = table.column("v").combine_chunks()
        dims = table.column("dims")[0].as_py()
        wide = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims)
        q, c, score = search_block(wide[asks], rows[asks], wide[~asks], rows[~asks], ids[~asks], k)
        found = [rows[asks][q], ids[asks][q], rows[~asks][c], ids[~asks][c], score]
        return pa.table([pa.array(x, pa.int64()) for x in found], ["query_row", "query_id", "row", "vec_id", "score"])

    local = arrow_groups(
        sides.withColumn("dims", F.size("v")),
        ["q", "c", "dims"],
        search,
        "query_row long, query_id long, row long, vec_id long, score long",
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
