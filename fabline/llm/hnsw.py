"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged.

A shard's graph is a few flat neighbour arrays, one a level. Searches run for many queries at once: each step
expands every query's nearest unexpanded nodes and gathers their neighbours in one array operation. Inner product
is turned into angle by one extra component that makes all indexed vectors equally long, so the graph's order
is that of the inner product. Reported scores are computed in double precision on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import finite, matrix, meet, search_groups
from .common import cut, with_row_id

WIDTH = 4  # nodes expanded a step
BATCH = 256


class Graph:
    """HNSW over the rows of ``vectors``; ``levels[0]`` holds all nodes, higher ones ever fewer."""

    def __init__(self, vectors: np.ndarray, links: int = 16, ef: int = 64, seed: int = 1):
        x = vectors.astype(np.float64)
        norm = (x ** 2).sum(axis=1)
        self.x = np.hstack([x, np.sqrt(np.maximum(norm.max(initial=0.0) - norm, 0))[:, None]]).astype(np.float32)
        n = len(x)
        height = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
        order = np.argsort(-height, kind="stable")  # nodes of upper levels come first on every level
        self.node = order  # position -> row
        self.x, height = self.x[order], height[order]
        self.levels: list[np.ndarray] = []
        self.size = [int((height >= h).sum()) for h in range(int(height.max(initial=0)) + 1)]
        for h in range(len(self.size) - 1, -1, -1):  # top level first; a level starts from those above it
            self._level(self.size[h], links * (2 if h == 0 else 1), links, ef)

    def _level(self, n: int, room: int, links: int, ef: int) -> None:
        near = np.full((n, room), -1, dtype=np.int32)
        upper = list(self.levels)
        done = 0
        while done < n:
            batch = np.arange(done, min(n, done + (BATCH if done else 2 * room)))
            own = self.x[batch] @ self.x[batch].T
            np.fill_diagonal(own, -np.inf)
            ids, sim = np.broadcast_to(batch, own.shape).copy(), own
            if done:  # the graph so far, and the batch itself
                ids0, sim0 = self._search(self.x[batch], near[:done], upper, ef)
                ids, sim = np.hstack([ids0, ids]), np.hstack([sim0, sim])
            k = min(ef, sim.shape[1])
            top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            sim = np.take_along_axis(sim, top, axis=1)
            ids = np.where(np.isfinite(sim), np.take_along_axis(ids, top, axis=1), -1)
            rank = np.argsort(-sim, axis=1, kind="stable")
            ids, sim = np.take_along_axis(ids, rank, axis=1), np.take_along_axis(sim, rank, axis=1)
            kept, kept_sim = self._spread(ids, sim, links)
            near[batch, :links] = kept
            self._back(near, np.repeat(batch, links), kept.ravel(), kept_sim.ravel())
            done = batch[-1] + 1
        self.levels.append(near)

    def _spread(self, ids: np.ndarray, sim: np.ndarray, links: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``links`` neighbours a node, nearest first, each nearer to the node than to those kept before;
        free places go to the nearest of the rest."""
        n, k = ids.shape
        vec = self.x[ids]  # (n, k, dims); index -1 reads any row and is masked below
        cross = np.einsum("nid,njd->nij", vec, vec)
        kept = np.zeros((n, k), dtype=bool)
        for c in range(k):
            closer = (cross[:, c, :] > sim[:, c, None]) & kept
            kept[:, c] = (ids[:, c] >= 0) & ~closer.any(axis=1) & (kept.sum(axis=1) < links)
        first = np.argsort(~kept * 2 + (ids < 0), axis=1, kind="stable")[:, :links]
        out, s = np.take_along_axis(ids, first, axis=1), np.take_along_axis(sim, first, axis=1)
        if out.shape[1] < links:
            pad = links - out.shape[1]
            out = np.pad(out, ((0, 0), (0, pad)), constant_values=-1)
            s = np.pad(s, ((0, 0), (0, pad)), constant_values=-np.inf)
        return out, s

    def _back(self, near: np.ndarray, src: np.ndarray, dst: np.ndarray, sim: np.ndarray) -> None:
        """Add the reverse links; a full node keeps its nearest neighbours."""
        room = near.shape[1]
        ok = dst >= 0
        src, dst, sim = src[ok], dst[ok], sim[ok]
        touched = np.unique(dst)
        old_dst = np.repeat(touched, room)
        old = near[touched].ravel()
        ok = old >= 0
        old_dst, old = old_dst[ok], old[ok]
        a = np.concatenate([old_dst, dst])
        b = np.concatenate([old, src]).astype(np.int64)
        s = np.concatenate([np.einsum("nd,nd->n", self.x[old_dst], self.x[old]), sim])
        order = np.lexsort((b, -s, a))
        a, b = a[order], b[order]
        pair = np.unique(a * (1 << 32) + b, return_index=True)[1]
        pair.sort()
        a, b = a[pair], b[pair]
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        rank = np.arange(len(a)) - np.repeat(start, np.diff(np.r_[start, len(a)]))
        fit = rank < room
        near[touched] = -1
        near[a[fit], rank[fit]] = b[fit]

    def _search(self, q: np.ndarray, near: np.ndarray, upper: list[np.ndarray], ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and similarities (best first, -1 and -inf where fewer) of the ``ef`` nearest found."""
        entry = np.zeros((len(q), 1), dtype=np.int64)
        for level in upper:
            entry = self._beam(q, level, entry, 8)[0][:, :4]
        spare = np.arange(min(len(near), 2), dtype=np.int64)
        entry = np.hstack([entry, np.broadcast_to(spare, (len(q), len(spare)))])
        return self._beam(q, near, entry, ef)

    def _beam(self, q: np.ndarray, near: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(q))[:, None]
        seen = np.zeros((len(q), len(near) + 1), dtype=bool)  # the last place stands for "none"
        ids = np.full((len(q), ef), -1, dtype=np.int64)
        sim = np.full((len(q), ef), -np.inf, dtype=np.float32)
        todo = np.zeros((len(q), ef), dtype=bool)
        new = np.where((entry >= 0) & (entry < len(near)), entry, -1)
        while True:
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[rows, new]] = -1
            got = np.einsum("qd,qkd->qk", q, self.x[new])
            got[new < 0] = -np.inf
            seen[rows, new] = True
            seen[:, -1] = False
            ids = np.hstack([ids, new])
            sim = np.hstack([sim, got])
            todo = np.hstack([todo, new >= 0])
            order = np.argsort(-sim, axis=1, kind="stable")[:, :ef]
            ids, sim, todo = (np.take_along_axis(v, order, axis=1) for v in (ids, sim, todo))
            at = np.argsort(~todo, axis=1, kind="stable")[:, :WIDTH]
            live = np.take_along_axis(todo, at, axis=1)
            if not live.any():
                return ids, sim
            np.put_along_axis(todo, at, False, axis=1)
            open_ = np.where(live, np.take_along_axis(ids, at, axis=1), -1)
            new = np.where(open_[:, :, None] >= 0, near[open_], -1).reshape(len(q), -1).astype(np.int64)

    def width_for(self, recall: float, k: int, ef: int, sample: int = 64, seed: int = 2) -> int:
        """The least beam of ``ef``, 2 ``ef``, 4 ``ef``, ... that finds ``recall`` of the true ``k`` nearest of ``sample`` indexed
        vectors, measured against brute force. A beam as wide as the graph ends the search for one."""
        n = len(self.x)
        at = np.sort(np.random.default_rng(seed).permutation(n)[:sample])
        asked = self.x[at].copy()
        asked[:, -1] = 0  # as queries come: without the component that equals lengths
        true = np.argsort(-(asked @ self.x.T), axis=1, kind="stable")[:, :k]
        while ef < n:
            found = self._search(asked, self.levels[-1], self.levels[:-1], ef)[0][:, :k]
            if np.mean([len(np.intersect1d(t, f)) for t, f in zip(true, found)]) >= recall * true.shape[1]:
                return ef
            ef *= 2
        return max(n, k)

    def search(self, queries: np.ndarray, k: int, ef: int) -> list[np.ndarray]:
        """Rows of the indexed matrix found nearest to each query, in no exact order."""
        out = []
        for lo in range(0, len(queries), BATCH):
            q = np.hstack([queries[lo:lo + BATCH].astype(np.float32), np.zeros((len(queries[lo:lo + BATCH]), 1), np.float32)])
            ids = self._search(q, self.levels[-1], self.levels[:-1], max(ef, k))[0]
            out += [self.node[i[i >= 0]] for i in ids]
        return out


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, ef: int = 64, links: int = 16, id_col: str = "vec_id",
            vec_col: str = "embedding", block: int = 1 << 20, shard: int = 16384, least_shards: int = 8, recall: float = 0.97) -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank (from 1), vec_id, score of the k nearest found.

    Nearness is the inner product in double precision, ties to the smaller id. Vectors that are null, zero or hold
    null or non-finite components take no part, nor do rows with a null id; vectors meet those of their length.
    Equal vectors are indexed once, with their k + 1 smallest ids: no query can name more of them. Every shard's beam starts
    at ``ef`` and is widened until it finds ``recall`` of what brute force finds for a sample of the shard's own vectors, so
    hard tables (long, evenly spread vectors) cost more, not recall.
    """
    double = F.transform("vec", lambda x: x.cast("double") + F.lit(0.0))
    rows = cut(with_row_id(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")), "row")
               .where(F.col("id").isNotNull() & finite(F.col("vec")) & F.exists("vec", lambda x: x != 0))
               .withColumn("vec", double))
    same = Window.partitionBy("vec").orderBy("id", "row")
    index = cut(rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1)
                .groupBy("vec").agg(F.min("row").alias("row"), F.sort_array(F.collect_list(F.struct("id", "row"))).alias("ids"))
                .withColumn("dims", F.size("vec")))
    asked = rows.where(F.col("id") % every == 0)
    asking = cut(asked.groupBy("vec").agg(F.min("row").alias("row")).withColumn("dims", F.size("vec")))
    parts, groups = meet(asking, index, block, shard, least_shards)

    def build(t):
        t = t.select(["row", "vec", "ids"]).sort_by("row")
        x = matrix(t.column("vec"), np.float64)
        graph = Graph(x, links)
        return graph, graph.width_for(recall, k + 1, max(ef, k + 1)), x, t.column("ids").to_pylist()

    def search(built, q):
        graph, beam, x, ids = built
        out, vectors_ = ([], [], [], []), matrix(q.column("vec"), np.float64)
        for row, vec, at in zip(q.column("row").to_pylist(), vectors_, graph.search(vectors_, k + 1, beam)):
            score = x[at] @ vec
            found = sorted((-s, i["id"], i["row"]) for s, a in zip(score.tolist(), at.tolist()) for i in ids[a])[:k + 1]
            for col, v in zip(out, ([row] * len(found), [f[1] for f in found], [f[2] for f in found], [-f[0] for f in found])):
                col.extend(v)
        return pa.table({"asking": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "row": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.float64())})

    found = search_groups(parts, groups, "asking bigint, vec_id bigint, row bigint, score double", build, search)
    best = Window.partitionBy("asking").orderBy(F.col("score").desc(), "vec_id", "row")
    merged = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    by_query = (asked.select(F.col("id").alias("query_id"), F.col("row").alias("query_row"), "vec")
                .join(asking.select("vec", F.col("row").alias("asking")), "vec").drop("vec")
                .join(merged, "asking").where(F.col("row") != F.col("query_row")))
    own = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return by_query.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
