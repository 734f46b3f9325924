"""Exact top-k search by inner product with vector-approximation files (operator 7).

Vectors are dealt to blocks. For each block the approximation keeps one small cell number
for every component; the cell of a component bounds it from below and above, so scanning
the cells bounds every inner product. The exact vectors are then read from the best bound
on, until no bound left reaches the kth exact score. Blocks' results are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.llm.common import need, written

#: Cells for each component.
CELLS = 16
#: Average vectors in a block of candidates, and queries in a block of queries.
BLOCK = 4096
#: Exact vectors read at a time.
_READ = 256


def integer_vectors(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector, row): components as floor(scale * x), x as double.

    Rows without id or vector, or with a null or non-finite component, are left out. Rows that
    share an id are vectors of their own; ``row`` (64 bits, from the content) tells them apart. An empty vector has no components
    and scores 0 against others like it.
    """
    need(rows, id_col, vector)

    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    doubles = F.transform(vector, lambda x: x.cast("double"))
    ints = F.transform(doubles, lambda x: F.floor(float(scale) * x).cast("bigint"))
    kept = rows.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.forall(doubles, good))
    equal = kept.groupBy(F.col(id_col).cast("bigint").alias("vec_id"), ints.alias("vector")).agg(F.count(F.lit(1)).alias("n"))
    copies = equal.select("vec_id", "vector", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy"))
    return copies.select("vec_id", "vector", F.xxhash64("vec_id", "vector", "copy").alias("row"))


class Approximation:
    """Cells of a block of integer vectors: all of a component's cells are equally wide."""

    def __init__(self, exact: np.ndarray, cells: int = CELLS):
        self.low = exact.min(axis=0) if len(exact) else np.zeros(exact.shape[1], np.int64)
        span = (exact.max(axis=0) if len(exact) else self.low) - self.low + 1
        self.width = -(-span // cells)
        self.codes = ((exact - self.low) // self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds (queries x vectors), and for each query how far the lower bounds lie below."""
        q = queries.astype(np.float64)
        upper = (q * self.width) @ self.codes.T.astype(np.float64)
        upper += (q @ self.low + np.maximum(q, 0) @ (self.width - 1))[:, None]
        return upper, np.abs(q) @ (self.width - 1)


def _search(exact: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best of a block for each query (by its row); ties go to the smaller id, a query's own row is left out."""
    out_q: list = []
    out_v: list = []
    out_s: list = []
    if float(np.abs(exact).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, exact.shape[1]) >= 2**52:
        return _plain(exact, ids, rows, queries, query_rows, k)
    cells = Approximation(exact)
    values = exact.astype(np.float64)
    for a in range(0, len(queries), 128):
        part = queries[a : a + 128].astype(np.float64)
        upper, _ = cells.bounds(queries[a : a + 128])
        for q, bound, own in zip(part, upper, query_rows[a : a + 128].tolist(), strict=True):
            bound[rows == own] = -np.inf
            seen, scores = np.zeros(0, np.int64), np.zeros(0)
            while True:
                certain = scores.min() if len(scores) == k else -np.inf
                more = np.flatnonzero((bound >= certain) & (bound > -np.inf))
                if not len(more):
                    break
                if len(more) > _READ:
                    more = more[np.argpartition(-bound[more], _READ - 1)[:_READ]]
                bound[more] = -np.inf
                seen = np.concatenate([seen, more])
                scores = np.concatenate([scores, values[more] @ q])
                keep = np.lexsort((ids[seen], -scores))[:k]
                seen, scores = seen[keep], scores[keep]
            best = np.lexsort((ids[seen], -scores))[:k]
            out_q += [own] * len(best)
            out_v += ids[seen[best]].tolist()
            out_s += scores[best].astype(np.int64).tolist()
    return out_q, out_v, out_s


def _plain(exact: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int) -> tuple[list, list, list]:
    """The same by whole numbers of any length, for components too large for floating point."""
    out_q: list = []
    out_v: list = []
    out_s: list = []
    whole = exact.astype(object)
    for q, own in zip(queries.astype(object), query_rows.tolist(), strict=True):
        scores = (whole * q).sum(axis=1) if whole.shape[1] else np.zeros(len(whole), object)
        best = sorted((-s, i) for s, i, r in zip(scores.tolist(), ids.tolist(), rows.tolist(), strict=True) if r != own)[:k]
        out_q += [own] * len(best)
        out_v += [i for _, i in best]
        out_s += [max(-(1 << 63), min((1 << 63) - 1, -s)) for s, _ in best]
    return out_q, out_v, out_s


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = table.column("vector").combine_chunks().flatten()
    return np.asarray(flat).reshape(table.num_rows, dim).astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query, all if fewer.

    Both tables have (vec_id, vector, row), with unique rows; rows that share an id are queries and
    candidates of their own, and only a query's own row is left out. Vectors of another length than the query's are
    no candidates. Ties go to the smaller id. Every block of queries meets every block of candidates
    once; each pair of blocks gives at most k rows for a query. No rows on either side give no rows.
    """
    n, n_queries = vectors.count(), queries.count()
    blocks, query_blocks = max(1, math.ceil(n / block)), max(1, math.ceil(n_queries / block))
    dealt = vectors.select(
        "vec_id", "vector", "row", F.size("vector").alias("dim"), F.pmod("row", F.lit(blocks)).alias("cb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))).alias("qb"),
    )
    asked = queries.select(
        "vec_id", "vector", "row", F.size("vector").alias("dim"), F.pmod(F.xxhash64(F.lit(7), "row"), F.lit(query_blocks)).alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("cb"),
    )

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            dim = key[2].as_py()
            ids, query_rows = left.column("vec_id").to_numpy(), right.column("row").to_numpy()
            found = _search(_matrix(left, dim), ids, left.column("row").to_numpy(), _matrix(right, dim), query_rows, k)
        names = dict(zip(right.column("row").to_pylist(), right.column("vec_id").to_pylist(), strict=True))
        columns = ([names[r] for r in found[0]], *found)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "query_row", "vec_id", "score"), columns, strict=True)})

    keys = ["qb", "cb", "dim"]
    near = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The five best of all ``embeddings`` for each row whose id is divisible by 50."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    vectors = written(integer_vectors(rows), "vectors")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


#: DuckDB SQL of ``op7_exact_top_k`` (ids are unique and vectors equally long in the tables).
OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
