"""Exact neighbours by cells round pivots: bounds, the pairs that are measured, hot cells, ties."""

import random

import numpy as np
import pytest

from fabline.operators import knn as KN
from fabline.operators.cells import Cells, chain, home, rings


def vectors(rng, n, kind):
    if kind == "clustered":
        return rng.normal(size=(40, 16))[rng.integers(0, 40, n)] * 10 + rng.normal(size=(n, 16)) * 0.3
    if kind == "repeated":
        return np.repeat(rng.integers(-2, 3, (7, 16)), -(-n // 7), axis=0)[:n].astype(float)
    return rng.normal(size=(n, 16)) * rng.choice([1e-3, 1.0, 1e3], (n, 1))


@pytest.mark.parametrize("kind", ["clustered", "repeated", "spread"])
def test_cells_find_the_nearest(kind):
    """The pairs measured hold the nearest of all; of clustered vectors they are few."""
    rng, k = np.random.default_rng(3), 5
    both = vectors(rng, 5000, kind)
    t, q = both[:4000], both[4000:]
    pivots = t[rng.permutation(4000)[:100]]
    cell, dist = home(t, pivots)
    near, low, high = np.full((100, k), np.inf), np.zeros(100), np.zeros(100)
    for c in np.unique(cell):
        d = np.sort(dist[cell == c])
        near[c, :len(d[:k])], low[c], high[c] = d[:k], d[0], d[-1]
    lists, measured = [[] for _ in q], 0
    asked = [(i, c, d, b) for i, cs, ds, b in Cells(pivots, near, low, high).route(q) for c, d in zip(cs, ds)]
    for c in range(100):
        mine = [x for x in asked if x[1] == c]
        rows, who = np.flatnonzero(cell == c), np.array([x[0] for x in mine], int)
        for some, ring in rings(q[who], np.array([x[2] for x in mine]), np.array([x[3] for x in mine]), t[rows], dist[rows]):
            measured += len(some) * len(ring)
            for i in who[some]:
                lists[i].append(rows[ring])
    ids = np.arange(4000)
    for i, best, d in KN.nearest(q, t, ids, k):
        some = np.concatenate(lists[i])
        _, at, again = next(KN.nearest(q[i:i + 1], t[some], some, k))
        assert some[at].tolist() == best.tolist() and again.tolist() == d.tolist()
    if kind == "clustered":
        assert measured < 0.1 * len(q) * len(t)


def test_chain_fills_blocks():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 30, 50)
    rows[7] = 500
    block = chain(rng.normal(size=(50, 3)), rows, 100)
    held = np.bincount(block, rows)
    assert sorted(set(block.tolist())) == list(range(block.max() + 1))
    assert all(h <= 100 for b, h in enumerate(held) if b != block[7]) and (rows[block == block[7]] > 0).sum() == 1


def test_infinite_components_disturb_nobody(spark):
    inf = float("inf")
    t = spark.createDataFrame([(i, [float(i), 0.0], "good") for i in range(20)] + [(20 + i, [inf, float(i)], "good") for i in range(5)],
                              "vec_id long, features array<double>, label string")
    q = spark.createDataFrame([(i, [i + 0.2, 0.0]) for i in range(15)] + [(50, [inf, 0.0])], "vec_id long, features array<double>")
    for cell_rows in (2, 100):
        rows = KN.knn_neighbours(q, t, 2, k=3, broadcast_bytes=0, cell_rows=cell_rows).where("q_id < 50").collect()
        assert {(r.q_id, r.t_id) for r in rows if r.rank == 1} == {(i, i) for i in range(15)} and len(rows) == 45
    assert KN.knn_neighbours(q, t.where("vec_id >= 20"), 2, k=3, broadcast_bytes=0).count() == 0


@pytest.mark.parametrize("q_block,t_block,cell_rows", [(16384, 65536, 4096), (7, 20, 5), (50, 1000, 30)])
def test_blocks_give_what_sending_gives(spark, q_block, t_block, cell_rows):
    r = random.Random(5)
    spot = [[r.gauss(0, 10) for _ in range(4)] for _ in range(6)]
    train = [(i, spot[0] if i % 3 == 0 else [x + r.gauss(0, 1) for x in spot[i % 6]], ("good", "defect1", None)[i % 3]) for i in range(300)]
    train += [(300, None, "good"), (301, [1.0, 2.0], "good"), (302, [1.0, float("nan"), 0.0, 0.0], "good")]
    ask = [(i, spot[0] if i % 3 == 0 else [x + r.gauss(0, 1) for x in spot[i % 6]]) for i in range(90)] + [(90, None), (91, [1e6] * 4)]
    t = spark.createDataFrame(train, "vec_id long, features array<double>, label string")
    q = spark.createDataFrame(ask, "vec_id long, features array<double>")
    for k in (1, 5, 400):
        want = sorted(KN.knn_neighbours(q, t, 4, k=k).collect(), key=lambda x: (x.q_id, x.rank))
        got = KN.knn_neighbours(q, t, 4, k=k, broadcast_bytes=0, q_block=q_block, t_block=t_block, cell_rows=cell_rows)
        assert sorted(got.collect(), key=lambda x: (x.q_id, x.rank)) == want and len(want) == 91 * min(k, 300)
        if k == 5 and q_block == 7:
            assert KN.knn_neighbours(q.where("vec_id < 0"), t, 4, k=k, broadcast_bytes=0).count() == 0
