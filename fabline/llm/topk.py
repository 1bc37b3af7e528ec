"""Exact top-k inner products over integer vectors by columnar branch-and-bound.

A shard's vectors lie in vertical layout, one row a dimension. For each query the products are gathered dimension
block by dimension block; after each block the mass that is left (Cauchy-Schwarz over the remaining dimensions)
bounds every candidate's score from both sides, and candidates that can't reach the k-th best are compacted away.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import finite, matrix, meet, search_groups
from .common import cut, with_row_id

EXACT = float(1 << 53)
LONG = (-(1 << 63), (1 << 63) - 1)


class Vertical:
    """A shard in vertical layout with the mass left after each dimension block."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, step: int = 16):
        order = np.lexsort((rows, ids))  # ties in score go to the smaller id
        self.ids, self.rows = ids[order], rows[order]
        self.columns = np.ascontiguousarray(vectors[order].T.astype(np.float64))
        dims = len(self.columns)
        self.cuts = list(range(0, dims, step)) + [dims]
        mass = np.vstack([np.cumsum((self.columns ** 2)[::-1], axis=0)[::-1], np.zeros((1, len(ids)))])
        self.left = [np.sqrt(mass[c]) for c in self.cuts]
        self.place = {r: i for i, r in enumerate(self.rows.tolist())}
        self.largest = float(np.abs(self.columns).max(initial=0.0))
        self.exact = vectors[order]

    def top(self, query: np.ndarray, row: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Places and scores of the k best, best first, without the query's own row."""
        alive = np.arange(len(self.ids))
        if row in self.place:
            alive = np.delete(alive, self.place[row])
        q = query.astype(np.float64)
        if self.largest * float(np.abs(q).max(initial=0.0)) * max(1, len(q)) >= EXACT:  # beyond exact doubles
            scores = [min(max(sum(int(a) * int(b) for a, b in zip(self.exact[i], query)), LONG[0]), LONG[1]) for i in alive]
            best = sorted(range(len(alive)), key=lambda j: (-scores[j], j))[:k]
            return alive[best], [scores[j] for j in best]
        mass = np.r_[np.cumsum((q ** 2)[::-1])[::-1], 0.0]
        part = np.zeros(len(alive))
        for b, (lo, hi) in enumerate(zip(self.cuts, self.cuts[1:])):
            block = self.columns[lo:hi]
            part = part + q[lo:hi] @ (block if len(alive) == len(self.ids) else block[:, alive])
            if len(alive) > k and hi < len(q):
                slack = np.sqrt(mass[hi]) * self.left[b + 1][alive] * (1 + 1e-9) + 1e-6
                kth = np.partition(part - slack, len(alive) - k)[len(alive) - k]
                stay = part + slack >= kth
                if not stay.all():
                    alive, part = alive[stay], part[stay]
        best = np.lexsort((alive, -part))[:k]
        return alive[best], [int(s) for s in part[best]]


def quantised(vectors: DataFrame, factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (row, id, vec): floor(factor * x) of each component, for vectors that are whole and finite."""
    rows = with_row_id(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")), "row")
    return rows.where(finite(F.col("vec"))).select(
        "row", "id", F.transform("vec", lambda x: F.floor(F.lit(float(factor)) * x.cast("double"))).alias("vec"))


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
          block: int = 1 << 20, shard: int = 65536, least_shards: int = 16) -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank (from 1), vec_id, score of its k best.

    Candidates are all other rows of the same length; ties go to the smaller id. Rows with a null id are
    candidates (last among ties) but no queries; equal rows are rows of their own. Scores beyond a long stop
    at its limits.
    """
    rows = cut(quantised(vectors, factor, id_col, vec_col).withColumn("dims", F.size("vec")))
    queries = rows.where(F.col("id") % every == 0)
    parts, groups = meet(queries, rows, block, shard, least_shards)

    def build(t):
        # Null ids sort last among ties.
        ids = np.array([LONG[1] if i is None else i for i in t.column("id").to_pylist()], dtype=np.int64)
        null = np.array(t.column("id").is_null().to_pylist(), dtype=bool)
        vertical = Vertical(matrix(t.column("vec"), np.int64), ids, t.column("row").to_numpy())
        return vertical, set(t.column("row").to_numpy()[null].tolist())

    def search(index, q):
        vertical, nulls = index
        out = ([], [], [], [], [])
        for row, qid, vec in zip(q.column("row").to_pylist(), q.column("id").to_pylist(), matrix(q.column("vec"), np.int64)):
            at, scores = vertical.top(vec, row, k)
            out[0].extend([row] * len(at))
            out[1].extend([qid] * len(at))
            out[2].extend(None if r in nulls else i for i, r in zip(vertical.ids[at].tolist(), vertical.rows[at].tolist()))
            out[3].extend(scores)
            out[4].extend(vertical.rows[at].tolist())
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query_row", "query_id", "vec_id", "score", "row"), out)})

    found = search_groups(parts, groups, "query_row bigint, query_id bigint, vec_id bigint, score bigint, row bigint", build, search)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
