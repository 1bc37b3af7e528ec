"""k-nearest-neighbour classification (J7, R1, A5, A6).

Exact. The training set is the capped one (A8), so it is bounded; its size is
checked before anything is sent. Up to ``broadcast_bytes`` it goes to every
task once and queries are scored where they are, without a shuffle. Beyond
that, training vectors lie in cells round sampled pivots (``cells.py``), near
cells form blocks of bounded size, and a query goes only to the blocks that
hold a cell it can't rule out; the partial lists are merged. Either way
candidates come from matrix products (norms plus inner products) and are then
measured exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.cells import Cells, chain, home, rings
from fabline.session import ensure_checkpoint_dir

PIVOTS = 4096  # at most; more training vectors make larger cells
LISTED = 64  # cells a query of a task lists on average; where they list more, a task has fewer queries
T_CHUNK = 4096  # training rows that a matrix product takes at once
PAIRS = 1 << 15  # pairs whose differences are held at once
NEIGHBOUR_SCHEMA = "q_id long, rank long, t_id long, t_label string, dist double"


def nearest(q: np.ndarray, t: np.ndarray, t_ids: np.ndarray, k: int, chunk: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query index, training indices, distances) of the ``k`` nearest, ties to the smaller training id. What it holds
    beside its input does not grow with the training set."""
    bound = np.full(len(q), np.inf)
    best_d, best_at = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
    for at in range(0, len(t), T_CHUNK):
        rows = np.arange(at, min(at + T_CHUNK, len(t)))
        screen = Screen(q, t[rows])
        for lo in range(0, len(q), chunk):
            who = np.arange(lo, min(lo + chunk, len(q)))
            _merge(q, t, t_ids, who, rows, best_d, best_at, bound, screen, rows - at)
    for i in range(len(q)):
        best = best_at[i][best_at[i] >= 0]
        yield i, best, best_d[i, :len(best)]


class Screen:
    """What tells near pairs from others in one matrix product: q.t - t.t / 2 is the larger the nearer ``t`` lies to ``q``.

    In single precision where all lengths allow it. What rounding can move a product by is at most ``slack`` times the sum
    of both squared lengths: the training side's share is added to its column here, the query's counts in ``least``. So
    no true neighbour is missed, and the pairs that are left are measured in double precision.
    """

    def __init__(self, q: np.ndarray, t: np.ndarray):
        with np.errstate(over="ignore", invalid="ignore"):
            self.q2, self.t2 = np.einsum("qd,qd->q", q, q), np.einsum("td,td->t", t, t)
        single = len(q) and len(t) and self.q2.max() < 1e30 and self.t2.max() < 1e30  # not so beside an infinite or NaN one
        kind = np.float32 if single else np.float64
        self.slack = max(1e-9, (q.shape[1] + 8) * float(np.finfo(kind).eps))
        self.q = np.empty((len(q), q.shape[1] + 1), kind)
        self.q[:, :-1], self.q[:, -1] = q, 1
        self.t = np.empty((len(t), t.shape[1] + 1), kind)
        self.t[:, :-1], self.t[:, -1] = t, np.where(np.isfinite(self.t2), (self.slack - 0.5) * self.t2 + 1e-12, np.nan)

    def near(self, who: np.ndarray, at: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``who``, places in ``at``) of the pairs that can be within ``bound`` and among the ``k`` nearest."""
        with np.errstate(over="ignore", invalid="ignore"):
            s = self.q[who] @ self.t[at].T
            off = self.slack * self.q2[who] + 1e-12
            least = (self.q2[who] - np.square(np.fmin(bound, np.inf))) / 2 - off
            found = np.flatnonzero(s >= self._below(least))
            if len(found) > 4 * k * len(who) and len(at) > k:  # the k-th best of these rows alone is a closer bound
                kth = np.partition(2 * (self.slack * self.t2[at] + 1e-12) - s, k - 1, axis=1)[:, k - 1]
                found = np.flatnonzero(s >= self._below(np.fmax(least, -kth - 2 * off)))
        return np.divmod(found, len(at))

    def _below(self, least: np.ndarray) -> np.ndarray:
        return np.nextafter(least.astype(self.q.dtype), self.q.dtype.type(-np.inf))[:, None]


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _rows(found) -> pa.Table:
    cols = ([], [], [], [], [])
    for q_id, t_ids, labels, dist in found:
        for col, v in zip(cols, ([q_id] * len(dist), range(1, len(dist) + 1), t_ids, labels, dist)):
            col.extend(v)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
    return pa.table({n: pa.array(v, ty) for n, v, ty in zip(("q_id", "rank", "t_id", "t_label", "dist"), cols, types)})


def fits(features: str, dim: int):
    """Vectors of length ``dim`` without null or NaN components."""
    bad = F.exists(features, lambda x: x.isNull() | F.isnan(x))
    return F.coalesce((F.size(features) == dim) & ~bad, F.lit(False))


def split_by_dim(df: DataFrame, dim: int, features: str = "features") -> tuple[DataFrame, DataFrame]:
    """(usable vectors of length ``dim``, quarantined others)."""
    return df.where(fits(features, dim)), df.where(~fits(features, dim))


def knn_neighbours(queries: DataFrame, train: DataFrame, dim: int, k: int = C.KNN_K,
                   q_id: str = "vec_id", t_id: str = "vec_id", features: str = "features",
                   label: str = "label", broadcast_bytes: int = 64 << 20,
                   q_block: int = 16384, t_block: int = 65536, cell_rows: int = 4096) -> DataFrame:
    """The k nearest training vectors (Euclidean) of every usable query vector:
    ``q_id, rank, t_id, t_label, dist``. Ties break on the training id.

    ``dim`` is the line's vector length; vectors of another length, or with
    null or NaN components, have no neighbours (``split_by_dim`` gives them,
    ``knn_decide`` answers them with ``unknown``). Vectors with an infinite
    component have no distances and are nobody's neighbours.

    A training set of over ``broadcast_bytes`` is searched by cells of about
    ``cell_rows`` vectors; a task holds ``t_block`` training vectors and about
    ``q_block`` queries.
    """
    q = split_by_dim(queries.select(F.col(q_id).alias("q_id"), F.col(features).alias("features")), dim)[0]
    t = split_by_dim(train.select(F.col(t_id).alias("t_id"), F.col(features).alias("features"),
                                  F.col(label).alias("t_label")), dim)[0]
    n_t = t.count()
    if n_t * (dim + 4) * 8 <= broadcast_bytes:
        table = t.toArrow()
        held = queries.sparkSession.sparkContext.broadcast(
            (_matrix(table.column("features"), dim), table.column("t_id").to_numpy(), table.column("t_label").to_pylist()))

        def score(batches):
            tm, tid, lab = held.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = nearest(_matrix(batch.column(1), dim), tm, tid, k) if len(tid) else ()
                yield from _rows(((ids[i], tid[at].tolist(), [lab[j] for j in at], dist.tolist())
                                       for i, at, dist in found)).to_batches()

        return q.mapInArrow(score, NEIGHBOUR_SCHEMA)
    part = _by_cells(q, t, n_t, dim, k, q_block, t_block, cell_rows)
    w = Window.partitionBy("q_id").orderBy("dist", "t_id")
    return part.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k) \
        .select("q_id", "rank", "t_id", "t_label", "dist")


def _by_cells(q: DataFrame, t: DataFrame, n_t: int, dim: int, k: int, q_block: int, t_block: int, cell_rows: int) -> DataFrame:
    """Neighbours of the queries within each block that they are sent to."""
    spark = q.sparkSession
    ensure_checkpoint_dir(spark)
    finite = t.where(F.forall("features", lambda x: F.abs(x) < float("inf")))
    sample = finite.orderBy(F.xxhash64("t_id"), "t_id").limit(min(PIVOTS, math.ceil(n_t / cell_rows))).select("features").toArrow()
    n_cells = sample.num_rows
    if not n_cells:
        return spark.createDataFrame([], NEIGHBOUR_SCHEMA).drop("rank")
    held = spark.sparkContext.broadcast(_matrix(sample.column(0), dim))

    def assign(batches):
        for batch in batches:
            cell, dist = home(_matrix(batch.column(1), dim), held.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(dist)], [*batch.schema.names, "cell", "t_dist"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema.fields)
    placed = t.mapInArrow(assign, f"{kinds}, cell long, t_dist double").checkpoint()
    first = F.row_number().over(Window.partitionBy("cell").orderBy("t_dist"))
    near = placed.select("cell", "t_dist", first.alias("j")).where(F.col("j") <= k).groupBy("cell").agg(F.collect_list("t_dist").alias("near"))
    about = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("t_dist").alias("low"), F.max("t_dist").alias("high"))
    known = about.join(near, "cell").collect()  # at most PIVOTS rows
    n, low, high, least = np.zeros(n_cells, np.int64), np.zeros(n_cells), np.zeros(n_cells), np.full((n_cells, k), np.inf)
    for r in known:
        n[r.cell], low[r.cell], high[r.cell] = r.n, r.low, r.high
        least[r.cell, :len(r.near)] = r.near
    block_of = chain(held.value, n, t_block)
    parts = np.maximum(1, -(-np.bincount(block_of, n) // t_block)).astype(np.int64)  # over 1 where one cell alone is larger
    cells = spark.sparkContext.broadcast((Cells(held.value, least, low, high), block_of))

    def route(batches):
        for batch in batches:
            c, of = cells.value
            at, block, listed, dists, bounds = [], [], [], [], []
            for i, some, dist, bound in c.route(_matrix(batch.column(1), dim)):
                order = np.argsort(of[some], kind="stable")
                some, dist = some[order], dist[order]
                edges = np.flatnonzero(np.diff(of[some], prepend=-1, append=-1)) if len(some) else []
                for a, b in zip(edges[:-1], edges[1:]):
                    at.append(i)
                    block.append(of[some[a]])
                    listed.append(some[a:b])
                    dists.append(dist[a:b])
                    bounds.append(bound)
                if len(at) >= 4096:
                    yield _sent(batch, at, block, listed, dists, bounds)
                    at, block, listed, dists, bounds = [], [], [], [], []
            if at:
                yield _sent(batch, at, block, listed, dists, bounds)

    kind = q.schema["features"].dataType.simpleString()
    sent = q.mapInArrow(route, f"q_id {q.schema['q_id'].dataType.simpleString()}, features {kind}, block long, cells array<bigint>, dists array<double>, bound double")
    asked = {r.block: r.n for r in sent.groupBy("block").agg(F.greatest(F.count(F.lit(1)), F.ceil(F.sum(F.size("cells")) / LISTED)).alias("n")).collect()}
    shape = [(int(c), int(b), int(parts[b]), math.ceil(asked[b] / q_block)) for c, b in enumerate(block_of) if b in asked]
    sizes = spark.createDataFrame(shape, "cell long, block long, n_parts long, n_qb long")
    by_block = F.broadcast(sizes.drop("cell").distinct())  # at most PIVOTS rows, as is the next

    def spread(column):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    qx = sent.join(by_block, "block").withColumns({"qb": F.pmod(F.xxhash64("q_id"), F.col("n_qb")), "part": spread("n_parts")}).drop("n_parts", "n_qb")
    tx = (placed.join(F.broadcast(sizes), "cell").withColumns({"part": F.pmod(F.xxhash64("t_id"), F.col("n_parts")), "qb": spread("n_qb")})
          .drop("n_parts", "n_qb"))

    def search(qs, ts):
        return _rows(_search(qs, ts, dim, k))

    key = ["block", "part", "qb"]
    return qx.groupBy(*key).cogroup(tx.groupBy(*key)).applyInArrow(search, NEIGHBOUR_SCHEMA).drop("rank")


def _sent(batch, at, block, listed, dists, bounds):
    ends = pa.array(np.r_[0, np.cumsum([len(x) for x in listed])], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (listed, dists)]
    rows = batch.take(pa.array(at))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(block, pa.int64()), *lists, pa.array(bounds, pa.float64())],
                                      ["q_id", "features", "block", "cells", "dists", "bound"])


def _search(qs, ts, dim: int, k: int):
    """(query id, training ids, labels, distances) of one block, cell by cell."""
    if not qs.num_rows or not ts.num_rows:
        return
    q, t = _matrix(qs.column("features"), dim), _matrix(ts.column("features"), dim)
    ids, tid, labels = qs.column("q_id").to_pylist(), ts.column("t_id").to_numpy(), ts.column("t_label").to_pylist()
    bound, t_cell, t_dist = (x.to_numpy().copy() for x in (qs.column("bound"), ts.column("cell"), ts.column("t_dist")))
    lists = qs.column("cells").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    owner = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
    cell = lists.flatten().to_numpy()
    dist = qs.column("dists").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    by_q, by_t = np.argsort(cell, kind="stable"), np.argsort(t_cell, kind="stable")
    best_d, best_at = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
    screen = Screen(q, t)
    for c in np.unique(t_cell):
        mine = by_q[slice(*np.searchsorted(cell[by_q], [c, c + 1]))]
        rows = by_t[slice(*np.searchsorted(t_cell[by_t], [c, c + 1]))]
        who = owner[mine]
        for some, ring in rings(q[who], dist[mine], bound[who], t[rows], t_dist[rows]):
            for lo in range(0, len(ring), T_CHUNK):
                at = rows[ring[lo:lo + T_CHUNK]]
                _merge(q, t, tid, who[some], at, best_d, best_at, bound, screen, at)
    for i in range(len(q)):
        found = best_at[i][best_at[i] >= 0]
        yield ids[i], tid[found].tolist(), [labels[j] for j in found], best_d[i, :len(found)].tolist()


def _merge(q, t, tid, who, at, best_d, best_at, bound, screen: Screen, place: np.ndarray) -> None:
    """Bring the training rows ``at``, ``place`` on the screen, into the best lists of the queries ``who``, and draw their bounds closer."""
    k = best_d.shape[1]
    row, col = screen.near(who, place, bound[who], k)
    if not len(row):
        return
    dist = np.empty(len(row))
    for lo in range(0, len(row), PAIRS):
        diff = t[at[col[lo:lo + PAIRS]]] - q[who[row[lo:lo + PAIRS]]]
        dist[lo:lo + PAIRS] = np.sqrt(np.einsum("td,td->t", diff, diff))
    some, row = np.unique(row, return_inverse=True)
    who = who[some]
    row = np.concatenate([row, np.repeat(np.arange(len(who)), k)])
    dist = np.concatenate([dist, best_d[who].ravel()])
    of = np.concatenate([at[col], best_at[who].ravel()])
    order = np.lexsort((tid[of], dist, row))  # places not filled yet are infinite and come last
    row, dist, of = row[order], dist[order], of[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    kept = rank < k
    best_d[who[row[kept]], rank[kept]], best_at[who[row[kept]], rank[kept]] = dist[kept], of[kept]
    last = best_d[who, k - 1]
    bound[who] = np.fmin(bound[who], last * (1 + 1e-9))


def knn_distribution(neigh: DataFrame, queries: DataFrame | None = None, k: int = C.KNN_K, q_id: str = "vec_id") -> DataFrame:
    """Votes per query and class (classes without votes included):
    ``q_id, label, votes, share``.

    With ``queries`` every query has its rows; votes and share of one without
    neighbours are null."""
    # One pass: the neighbours are worked out as often as they are read. A query without an id has no votes.
    found = neigh.groupBy("q_id").agg(*[F.count_if((F.col("t_label") == c) & F.col("q_id").isNotNull()).alias(c) for c in C.CLASSES])
    if queries is not None:
        found = queries.select(F.col(q_id).alias("q_id")).distinct().join(found, "q_id", "left")
    out = found.select("q_id", F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("votes")) for c in C.CLASSES])).alias("v"))
    return out.select("q_id", "v.label", "v.votes", (F.col("v.votes") / F.lit(float(k))).alias("share"))


def decide(good, defect1, defect2):
    """defect1 if it is >= both others, else defect2 if >= both, else good."""
    return (F.when((defect1 >= defect2) & (defect1 >= good), F.lit(C.DEFECT1))
            .when((defect2 >= defect1) & (defect2 >= good), F.lit(C.DEFECT2))
            .otherwise(F.lit(C.GOOD)))


def knn_decide(dist: DataFrame) -> DataFrame:
    """Class decision per query from its vote distribution:
    ``q_id, good, defect1, defect2, decision`` (missing votes -> ``unknown``)."""
    p = dist.groupBy("q_id").pivot("label", C.CLASSES).agg(F.max("votes"))
    g, d1, d2 = F.col(C.GOOD), F.col(C.DEFECT1), F.col(C.DEFECT2)
    dec = F.when(g.isNull() | d1.isNull() | d2.isNull(), F.lit(C.UNKNOWN_LABEL)).otherwise(decide(g, d1, d2))
    return p.withColumn("decision", dec)
