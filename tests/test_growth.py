"""What a task holds and how often it calls the state must not grow with a hot key or a large training set."""

import datetime as dt
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators import knn as KN
from fabline.operators import lifecycle as LC
from fabline.operators.aggs import daily_quality
from fabline.operators.fold import FoldSpec, run_fold
from fabline.plans import registry as R
from fabline.streaming import stateful as SF
from fabline.streaming import stream as ST

T0 = dt.datetime(2024, 1, 1)


# F2-F10
def test_neighbours_hold_bounded_memory():
    rng = np.random.default_rng(1)
    t, q, ids = rng.random((60_000, 8)), rng.random((256, 8)), rng.permutation(60_000)
    t[:20_000] = t[0]  # copies tie, the smaller id wins
    q[0] = t[0]
    tracemalloc.start()
    found = list(KN.nearest(q, t, ids, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    for i, best, dist in found[:20]:
        d = np.sqrt(((t - q[i]) ** 2).sum(1))
        assert best.tolist() == np.lexsort((ids, d))[:5].tolist() and dist.tolist() == pytest.approx(d[best].tolist())


def test_neighbours_beside_many_infinite_vectors():
    t = np.full((KN.T_CHUNK * 2, 2), np.inf)
    t[[3, KN.T_CHUNK + 5]] = [[1.0, 1.0], [2.0, 2.0]]
    (_, best, dist), = KN.nearest(np.zeros((1, 2)), t, np.arange(len(t)), 5)
    assert best.tolist() == [3, KN.T_CHUNK + 5] and dist.tolist() == pytest.approx([2 ** 0.5, 8 ** 0.5])


# r04 F2-F5
@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e20])
def test_the_screen_loses_no_neighbour(scale):
    """Single and double precision, ties, very long and very short vectors: the same neighbours as all pairs measured."""
    rng = np.random.default_rng(2)
    t = np.concatenate([rng.normal(size=(5000, 6)), rng.integers(-1, 2, (3000, 6)), rng.normal(size=(300, 6)) * 1e4]) * scale
    ids, q = rng.permutation(len(t)), np.concatenate([t[::400], rng.normal(size=(40, 6)) * scale])
    assert (KN.Screen(q, t).q.dtype == np.float64) == (scale == 1e20)
    for k in (1, 5, 400):
        for i, best, dist in KN.nearest(q, t, ids, k):
            diff = t - q[i]
            d = np.sqrt(np.einsum("td,td->t", diff, diff))
            want = np.lexsort((ids, d))[:k]
            assert best.tolist() == want.tolist() and dist.tolist() == d[want].tolist()


def test_votes_read_the_neighbours_once(spark):
    """Votes and the queries without any come out of one pass: each pass is a whole neighbour search."""
    asked = spark.sparkContext.accumulator(0)

    def search(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    rows = [(1, "good"), (1, "good"), (1, "defect2"), (2, "defect1"), (2, None), (3, "odd"), (None, "good")]
    near = spark.createDataFrame(rows, "q_id long, t_label string").mapInArrow(search, "q_id long, t_label string")
    queries = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "vec_id long")
    votes = {(r.q_id, r.label): (r.votes, r.share) for r in KN.knn_distribution(near, queries, k=2).collect()}
    assert asked.value == len(rows)
    none = dict.fromkeys(((i, c) for i in (4, None) for c in C.CLASSES), (None, None))
    assert votes == none | dict.fromkeys(((i, c) for i in (1, 2, 3) for c in C.CLASSES), (0, 0.0)) | {
        (1, "good"): (2, 1.0), (1, "defect2"): (1, 0.5), (2, "defect1"): (1, 0.5)}
    alone = {(r.q_id, r.label): r.votes for r in KN.knn_distribution(near).collect()}
    assert len(alone) == 4 * 3 and alone[None, "good"] == 0 and alone[1, "good"] == 2


LIFE = "seq long, ts timestamp, id string, topic string"


def lifecycle_rows(n, ids):
    rnd = random.Random(n)
    return [(i, T0 + dt.timedelta(seconds=rnd.randrange(n)) if i % 40 else None, rnd.choice(ids), rnd.choice(LC.LIFECYCLE_TOPICS)) for i in range(n)]


def test_the_lifecycle_shuffles_its_messages_once(spark, monkeypatch):
    rows = lifecycle_rows(900, ["a", "a", "a", "b", "c", "d", None])
    msgs = spark.createDataFrame(rows, LIFE)
    allow = spark.createDataFrame([("a", "50"), ("b", "60"), ("b", "70"), ("c", None), (None, "1")], "id string, thickness string")
    preds = spark.createDataFrame([(i, ("good", "defect1", None)[i % 3]) for i in range(900) if i % 5], "seq long, prediction string")
    cols = ["id", "seq", "action", "out_topic", "out_payload", "quality"]
    want = sorted(map(str, LC.material_lifecycle_fold(msgs.where("id IS NOT NULL"), allow, preds).select(*cols).collect()))
    plain = LC.material_lifecycle(msgs, allow, preds)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    monkeypatch.setattr(LC, "BUCKET_ROWS", 50)  # ids with more rows than that are cut into buckets
    for got in (plain, LC.material_lifecycle(msgs, allow, preds)):
        got = got.select(*cols).collect()
        assert sorted(str(r) for r in got if r.id is not None) == want and len(got) == len(rows)
        assert {"final", "classified", "unload"} <= {r.action for r in got}


# F16
def test_fold_takes_a_segment_batch_by_batch(spark):
    spec = FoldSpec(lambda: 0, lambda n, r: (n + 1, [(r.seq, n + 1, r.x)]), ["seq", "x"], "seq long, n long, x double")
    rows = [(k, i, i * 10, None if i % 4 == 0 else float(i)) for k in ("a", None, "b") for i in range(25)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "key string, seq long, ts_us long, x double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        for seg in (1000, 7):
            out = run_fold(df, ["key"], ["ts_us", "seq"], spec, segment_rows=seg)
            assert "InPandas" not in out._jdf.queryExecution().toString()  # no segment as one data frame
            assert sorted(((r.key or "", r.seq, r.n, r.x) for r in out.collect()), key=lambda r: r[:2]) == sorted(
                ((k or "", i, i + 1, None if i % 4 == 0 else float(i)) for k, i, _, _ in rows), key=lambda r: r[:2])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# F1, F11, F13-F15
def test_a_hot_key_calls_its_state_seldom(spark, tmp_path, monkeypatch):
    """Rows of one series in random order, with equal places and without numbers: few writes, the same batches."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "series string, seq long, ts timestamp, quality string, datapoints string"
    rows = [("s", None if i % 50 == 7 else i, T0 + dt.timedelta(seconds=i // 3), "good", str(i)) for i in range(6000)]
    random.Random(5).shuffle(rows)
    for b in range(3):
        spark.createDataFrame(rows[b * 2000:b * 2000 + 2000], schema).coalesce(1).write.parquet(f"{src}/{b}")
    spark.createDataFrame([("end", 1, T0 + dt.timedelta(days=9), "good", "")], schema).coalesce(1).write.parquet(f"{src}/end")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    q = SF.write_micro_batches(SF.export_live(s, "1 day"), out, ck)
    q.awaitTermination()
    ops = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in q.recentProgress if p["numInputRows"]]
    assert max(ops) < 200
    got = [(r.seq, r.datapoints) for r in spark.read.parquet(out).orderBy("rn").collect()]
    want = sorted(rows, key=lambda r: (r[2], r[1] is not None, r[1] or 0))
    assert len(got) == 6000 and [g[0] for g in got] == [w[1] for w in want] and sorted(g[1] for g in got) == sorted(w[4] for w in want)


def test_due_rows_of_many_entries_come_in_order():
    fold = SF.OrderedFold(SF.FoldSpec(lambda: 0, None, ["ts_us", "seq"], "seq long"), SF.TypedState("n long"), "ts_us long, seq long", ["k"])
    fold.input = lambda *v: v
    rng, entries, rows = random.Random(7), [], []
    for n in range(300):
        some = sorted(((ts := rng.randrange(500), True, s := rng.randrange(50), n * 10 + j), (ts, s)) for j in range(rng.randrange(1, 9)))
        rows += some
        entries.append(((some[0][0][0], n * 10), (some[-1][0][0], len(some), SF.pickle.dumps(some))))
    left = []
    got = list(fold._due(sorted(e for e in entries if e[0][0] <= 250), 250, left))
    assert got == [v for p, v in sorted(rows) if p[0] <= 250]
    held = {n for n, _ in left}
    assert sorted(r for _, some in left for r in some) == sorted(r for e in entries if e[0][1] in held for r in SF.pickle.loads(e[1][2]) if r[0][0] > 250)


# F2, F8
class Kept(dict):
    """A value state and a map state that keep what they get."""

    def get(self):
        return dict.get(self, None)

    def update(self, value):
        self[None] = value

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(list(self.items()))


class Watermark:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    def registerTimer(self, at):
        pass


def test_what_timers_emit_is_small_until_it_is_written(spark):
    """PySpark holds what all timers of a task emit as dicts: few bytes a row, and the rows unpack batch by batch."""
    rows = "ts_us long, seq long, id string, topic string, payload string, prediction string"
    fold = SF.OrderedFold(SF.LIVE_SPEC, SF.TypedState(SF.LIFE_STATE), rows, ["mid"])
    fold.input, fold.handle = SF.namedtuple("Input", fold.cols), Watermark(0)
    message, n, held = SF.Row(*fold.cols), 10, []
    tracemalloc.start()
    for i in range(3000):
        mid = None if i == 7 else f"{i:08x}"
        fold.held, fold.waiting, fold.clock = Kept(), Kept(), Kept()
        fold.held.update((False, True, False, False, None, "50"))
        list(fold.handleInputRows((mid,), [message(1000 * j, j, mid, C.LOADING_MAT_LOADED, "", None) for j in reversed(range(n))], None))
        fold.clock.update((n, 1))
        before = tracemalloc.get_traced_memory()[0]
        held.append([r.asDict(True) for r in fold.handleExpiredTimer((mid,), Watermark(n * 1000), Watermark(1))])
        held[-1].append(tracemalloc.get_traced_memory()[0] - before)
    tracemalloc.stop()
    assert sum(h.pop() for h in held) < 120 * 3000 * n
    values = pa.record_batch([pa.array([v["packed"] for h in held for v in h], pa.binary())], names=["packed"])
    out = list(SF._unpacker(f"mid string, {SF.LIVE_SPEC.out_schema}")([values, values.slice(0, 0)]))
    assert max(b.num_rows for b in out) < 2 * SF.PACKED_ROWS
    got = [r for b in out for r in b.to_pylist()]
    assert [(r["mid"], r["seq"]) for r in got] == [(None if i == 7 else f"{i:08x}", j) for i in range(3000) for j in range(n)]
    assert all(r["out_payload"] == f"{r['mid']}|F" or r["mid"] is None for r in got)


# r04 F2, F3
def test_many_ids_call_the_state_as_often_as_their_groups(spark, tmp_path, monkeypatch):
    """400 ids in 4 groups: few writes, and the actions of the batch operator."""
    monkeypatch.setattr(SF, "ID_GROUPS", 4, raising=False)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = f"{LIFE}, payload string"
    rows = [(*r, "") for r in lifecycle_rows(2400, [f"{i:03}" for i in range(400)]) if r[1] is not None]
    allow = spark.createDataFrame([(f"{i:03}", str(i)) for i in range(0, 400, 2)], "id string, thickness string")
    preds = spark.createDataFrame([(i, ("good", "defect1", None)[i % 3]) for i in range(2400) if i % 5], "seq long, prediction string")
    rows.sort(key=lambda r: r[1])
    for b in range(3):
        spark.createDataFrame(rows[b * 800:b * 800 + 800], schema).coalesce(1).write.parquet(f"{src}/{b}")
    spark.createDataFrame([(9999, T0 + dt.timedelta(days=9), "end", C.LOADING_MAT_LOADED, "")], schema).coalesce(1).write.parquet(f"{src}/end")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    q = ST.run_to_parquet(SF.lifecycle_live(s, LC.lifecycle_state(allow), "1 hour", preds), out, ck)
    q.awaitTermination()
    ops = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in q.recentProgress if p["numInputRows"]]
    assert max(ops) < 100
    cols = ["id", "seq", "action", "out_topic", "out_payload", "quality"]
    want = LC.material_lifecycle(spark.createDataFrame(rows, schema), allow, preds).select(*cols).collect()
    assert sorted(map(str, spark.read.parquet(out).select(*cols).collect())) == sorted(map(str, want)) and len(want) == len(rows)


def test_the_lifecycle_has_no_more_state_partitions_than_its_groups_need(spark, tmp_path, monkeypatch):
    """Each costs a commit in every micro-batch, and what its tasks send the driver grows with their square."""
    monkeypatch.setattr(SF, "ID_PARTITIONS", 3)
    before, schema = spark.conf.get("spark.sql.shuffle.partitions"), f"{LIFE}, payload string"
    rows = [(i, T0 + dt.timedelta(seconds=i), f"{i % 7}", C.LOADING_MAT_LOADED, "") for i in range(30)]
    rows += [(99, T0 + dt.timedelta(days=9), None, C.LOADING_MAT_LOADED, "")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    allow = spark.createDataFrame([("1", "50")], "id string, thickness string")
    s = SF.lifecycle_live(ST.read_stream(spark, f"{tmp_path}/in", schema), LC.lifecycle_state(allow), "1 hour")
    got = R._lifecycle_out(s, f"{tmp_path}/out", f"{tmp_path}/ck")
    assert {(r.seq, r.action) for r in got.collect()} == {(i, "forward" if i % 7 == 1 else "drop") for i in range(30)}
    assert len([p for p in (tmp_path / "ck" / "state" / "0").iterdir() if p.name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


class Handle:
    def __init__(self):
        self.timers = set()
        self.registerTimer = self.timers.add
        self.getValueState = self.getMapState = lambda *_: Kept()


@pytest.mark.parametrize("idle_ms", [None, 40])
def test_a_group_of_ids_is_as_its_ids_alone(spark, idle_ms):
    """Step by step the same actions, also where idle ids are forgotten, those with waiting rows not."""
    rows = "ts_us long, seq long, id string, topic string, payload string, prediction string"
    state, rnd = SF.TypedState(SF.LIFE_STATE), random.Random(4)
    alone, group, first, forgotten = {}, SF.GroupedFold(SF.LIVE_SPEC, state, rows, "id", idle_ms), ["a", "b", None], 0
    group.init(Handle())
    start = (False, True, False, False, None, "50")
    group.handleInitialState((0,), {"folds": [dict(zip(["id", *group.held_cols], (i, *start))) for i in first]}, None)
    for i in ("a", "b", "c", "d", None):
        alone[i] = SF.OrderedFold(SF.LIVE_SPEC, state, rows, ["id"], idle_ms)
        alone[i].init(Handle())
        if i in first:
            alone[i].handleInitialState((i,), dict(zip(group.held_cols, start)), None)
    message, now, n = SF.Row(*group.cols), 0, 0

    def fired(fold, key):
        due = sorted(t for t in fold.handle.timers if t <= now)
        found = [v.packed for t in due for v in fold.handleExpiredTimer(key, Watermark(now), Watermark(t))]
        fold.handle.timers.difference_update(due)
        return [r for v in found for r in SF.pickle.loads(v)]

    for _ in range(400):
        some = []
        for _ in range(rnd.choice([0, 0, 1, 3])):
            i, n = rnd.choice(list(alone)), n + 1
            topic = rnd.choice([*LC.LIFECYCLE_TOPICS, LC.ALLOW_TOPIC, LC.REMOVE_TOPIC])
            some.append(message((now + rnd.choice([1, 5, 91])) * 1000, n, i, topic, "60", rnd.choice(["good", "defect1", None])))
        for i, fold in alone.items():
            if mine := [r for r in some if r.id == i]:
                list(fold.handleInputRows((i,), iter(mine), None))
        if some:
            list(group.handleInputRows((0,), iter(some), None))
        now += rnd.choice([0, 2, 16, 50])  # never a row's own time, which a group may apply a timer earlier
        assert sorted(map(str, fired(group, (0,)))) == sorted(str(r) for i, f in alone.items() for r in fired(f, (i,)))
        held = {i: tuple(f.held.get()) for i, f in alone.items() if f.held.get() is not None}
        assert {i: tuple(s) for i, (s, _) in group._folds().items()} == held
        forgotten += len(held) < len(alone)
    assert n > 200 and (forgotten > 50) == (idle_ms is not None)


# F1, F11-F15
def test_micro_batches_follow_the_slices_not_the_rows(spark, tmp_path):
    df = spark.range(400).select(F.timestamp_seconds(F.col("id") * 6000).alias("ts"), F.col("id").alias("seq"))
    df = df.unionByName(spark.range(1).select(F.timestamp_seconds(F.lit(30 * 86400)).alias("ts"), F.lit(999).cast("long").alias("seq")))
    path = str(tmp_path / "in")
    delay, files = R._land(df, path, rows=20)
    n = 7  # 30 days and the row after them
    landed = spark.read.schema(df.schema).parquet(path)
    assert files == 3 and len(landed.inputFiles()) == n * files and sorted(r.seq for r in landed.collect()) == [*range(400), 999]
    q = ST.run_to_parquet(ST.read_stream(spark, path, df.schema, max_files=files), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == n


# F12
def test_daily_counts_send_the_driver_no_more_with_more_partitions(spark, tmp_path):
    """What reaches the driver is what tasks send, a metric for every state partition from each task with state."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "day string, quality string"
    rows = [(day, q) for day in ("2023-12-31", "2024-01-01", "2024-02-02", None, "none", "") for q in ("good", "defect2", "?")]
    for some in (rows, rows[:4] * 2, rows[9:] + [("2025-05-05", None)]):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        q = SF.daily_quality_live(ST.read_stream(spark, src, schema, max_files=1), out, ck)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    micro_batches = [p for p in q.recentProgress if p["numInputRows"]]
    assert len(micro_batches) == 3 and {p["stateOperators"][0]["numShufflePartitions"] for p in micro_batches} == {SF.DAY_PARTITIONS}
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(str(q.runId)) for s in tracker.getJobInfo(j).stageIds}
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert sum(n >= SF.DAY_PARTITIONS for n in tasks) == 3 and sum(tasks) < 3 * 64  # the merge runs none a state partition
    got = {r.day: (r.good, r.defect1, r.defect2) for r in spark.read.schema(SF.DAILY).parquet(out).collect()}
    want = {r.day: (r.good, r.defect1, r.defect2) for r in daily_quality(spark.read.schema(schema).parquet(src)).collect()}
    assert len(got) == 7 and got == want
    spark.createDataFrame(rows[:2], schema).coalesce(1).write.mode("append").parquet(src)  # with the session's fewer partitions
    q = SF.daily_quality_live(ST.read_stream(spark, src, schema, max_files=1), out, ck)
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == SF.DAY_PARTITIONS
    got = {r.day: (r.good, r.defect1, r.defect2) for r in spark.read.schema(SF.DAILY).parquet(out).collect()}
    assert got == want | {"2023-12-31": (4, 0, 4)}
