"""Downsampling with gap filling, batch and live (A10); readiness hand-off of a running stream (W10)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fabline.operators import gaps as GP
from fabline.operators import knn as KN
from fabline.operators.aggs import ready_at
from fabline.streaming import gaps as GL
from fabline.streaming import handoff as HO
from fabline.streaming import stream as ST
from tests.test_stateful import forget_last_commit, land, source

T0 = dt.datetime(2024, 1, 1)
POINT = "key string, ts timestamp, x double"


def sec(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


# A10

def plain_fill(rows, step, max_gap):
    """(key, start second, buckets, mean) by a loop over each key's buckets."""
    sums = {}
    for key, s, x in rows:
        if s is not None:
            sums.setdefault(key, {}).setdefault(s // step * step, []).append(x)
    out = []
    for key, buckets in sums.items():
        before = None
        for b in sorted(buckets):
            known = [x for x in buckets[b] if x is not None]
            gap = 0 if before is None else (b - before) // step - 1
            if gap > max_gap:
                out.append((key, before + step, gap, None))
            else:
                out += [(key, before + step * (i + 1), 1, None) for i in range(gap)]
            out.append((key, b, 1, round(sum(known) / len(known), 6) if known else None))
            before = b
    return sorted(out, key=repr)


def got(df):
    t = [(r.key, int((r.bucket_start - T0).total_seconds()), r.n_buckets, None if r.avg_x is None else round(r.avg_x, 6)) for r in df.collect()]
    return sorted(t, key=repr)


def some_points(seed, n=300, span=4000):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.randrange(span), rnd.choice([None, 1.0, 2.5, -3.0])) for _ in range(n)]
    return rows + [("b", None, 9.0), ("far", 5, 1.0), ("far", 50_000, 2.0)]


@pytest.mark.parametrize("run", [3, 100_000])
def test_gaps_are_filled_for_any_run_length(spark, monkeypatch, run):
    monkeypatch.setattr(GP, "RUN", run)
    rows = some_points(1)
    df = spark.createDataFrame([(k, sec(s), x) for k, s, x in rows], POINT)
    out = GP.downsample_fill(df, fields=("x",), bucket_s=10, keys=("key",), max_gap=100)
    want = plain_fill(rows, 10, 100)
    assert got(out) == want
    assert ("far", 10, 4999, None) in want  # one wrong clock is one row
    none = GP.downsample_fill(df.limit(0), fields=("x",), bucket_s=10, keys=("key",))
    assert none.columns == ["key", "bucket_start", "n_buckets", "avg_x"] and none.count() == 0


def test_plan_reads_the_table_once_and_builds_no_grid(spark, tmp_path):
    spark.createDataFrame([(k, sec(s), x) for k, s, x in some_points(2)], POINT).write.parquet(f"{tmp_path}/t")
    GP.RUN, kept = 50, GP.RUN
    try:
        plan = GP.downsample_fill(spark.read.parquet(f"{tmp_path}/t"), fields=("x",), bucket_s=10)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        GP.RUN = kept
    assert "Range (" not in plan and "Join LeftOuter" not in plan


def test_live_gaps_equal_batch_and_survive_a_kill(spark, tmp_path):
    rows = [r for r in some_points(4) if r[0] != "far"]
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "ck"

    def run():
        ST.run_to_parquet(GL.downsample_live(source(spark, src, POINT), "1000 seconds", "key", fields=("x",), bucket_s=10), out, str(ck)).awaitTermination()

    timed = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    for i in range(4):
        part = [r for r in timed if (r[1] or 0) // 1000 == i]
        random.Random(i).shuffle(part)
        land(spark, src, i, [(k, sec(s), x) for k, s, x in part], POINT)
    run()
    forget_last_commit(ck)
    run()
    land(spark, src, "end", [("end", sec(6000), 0.0)], POINT)
    run()
    last = max(s for _, s, _ in rows if s is not None) // 10 * 10
    ends = {k: max(s for q, s, _ in rows if q == k and s is not None) // 10 * 10 for k in ("a", "b", None)}
    want = plain_fill(rows, 10, 10_000) + [(k, s, 1, None) for k, e in ends.items() for s in range(e + 10, last + 1, 10)]
    live = spark.read.parquet(out).where("key IS DISTINCT FROM 'end'")
    assert got(live.where(F.col("bucket_start") <= F.lit(sec(last)))) == sorted(want, key=repr)


def test_a_silent_key_goes_on_with_empty_buckets_until_it_is_idle(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, src, 0, [("quiet", sec(3), 1.0)], POINT)
    for i, s in enumerate((35, 61, 200, 500)):
        land(spark, src, i + 1, [("busy", sec(s), 0.0)], POINT)
    q = GL.downsample_live(source(spark, src, POINT), "0 seconds", "key", fields=("x",), bucket_s=10, max_gap=3, idle_s=90)
    ST.run_to_parquet(q, out, str(tmp_path / "ck")).awaitTermination()
    quiet = [(s, n, x) for k, s, n, x in got(spark.read.parquet(out)) if k == "quiet"]
    assert sum(n for _, n, _ in quiet) == 10  # its bucket and 90 seconds
    covered = sorted(b for s, n, _ in quiet for b in range(s, s + 10 * n, 10))
    assert covered == list(range(0, 100, 10)) and sum(x is not None for _, _, x in quiet) == 1
    assert any(n == 4 for _, n, _ in quiet)  # the jump to 200 s leaves as one row


# W10

MESSAGE = "seq long, features array<double>, label string, is_check boolean"


def some_messages(n=240, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = rnd.choices(["good", "defect1", "defect2", "unknown", None], [5, 3, 1, 1, 1])[0]
        rows.append((i, [rnd.random(), rnd.random()], label, i % 4 == 0))
    return rows


def plain_switch(rows, min_sets):
    seen = dict.fromkeys(("good", "defect1", "defect2"), 0)
    for seq, _, label, check in sorted(rows, key=lambda r: r[0]):
        if not check and label in seen:
            seen[label] += 1
            if min(seen.values()) >= min_sets:
                return seq
    return None


@pytest.mark.parametrize("min_sets", [1, 5, 1000])
def test_switch_row_is_the_one_that_completes_the_last_class(spark, min_sets):
    rows = some_messages()
    records = spark.createDataFrame([(s, l) for s, _, l, c in rows if not c] + [(None, "defect2")], "seq long, label string")
    whole = ready_at(records, min_sets).first()
    assert whole["switch"] == plain_switch(rows, min_sets)
    first = ready_at(records.where("seq < 20"), min_sets).first()
    rest = ready_at(records.where("seq >= 20"), min_sets, first.asDict()).first()
    assert {c: rest[c] for c in ("good", "defect1", "defect2")} == {c: whole[c] for c in ("good", "defect1", "defect2")}
    if first["switch"] is None:
        assert rest["switch"] == whole["switch"]
    assert ready_at(records.limit(0), min_sets).first()["switch"] is None


@pytest.mark.parametrize("files", [1, 6])
def test_decisions_change_at_the_switch_row_for_any_cut_and_any_kill(spark, tmp_path, files):
    rows = some_messages()
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "ck"
    switch = plain_switch(rows, 5)
    checks, records = ([r for r in rows if r[3] == c] for c in (True, False))

    def run():
        HO.classify_live(source(spark, src, MESSAGE), out, str(ck), 2, 5, 3).awaitTermination()

    step = len(rows) // files
    for i in range(files):  # stopped and started again after each file, each micro-batch run twice
        land(spark, src, i, rows[i * step:(i + 1) * step] + ([(None, [0.5, 0.5], None, True)] if i == 0 else []), MESSAGE)
        run()
        forget_last_commit(ck)
        run()
    got = {r.seq: (r.decision, r.version) for r in HO.decisions(spark, out).collect()}
    assert HO.decisions(spark, out).count() == len(checks) + 1 and got.pop(None) == ("unknown", None)
    train = [r for r in records if r[0] <= switch and r[2] in ("good", "defect1", "defect2")]
    stored = HO.training_set(spark, out, switch)
    assert sorted(r.vec_id for r in stored.collect()) == sorted(r[0] for r in train)
    t = spark.createDataFrame([(s, f, l) for s, f, l, _ in train], "vec_id long, features array<double>, label string")
    q = spark.createDataFrame([(s, f) for s, f, _, _ in checks if s > switch], "vec_id long, features array<double>")
    want = {r.q_id: (r.decision, switch) for r in KN.knn_decide(KN.knn_distribution(KN.knn_neighbours(q, t, 2, k=3), q, k=3)).collect()}
    want.update({s: ("unknown", None) for s, *_ in checks if s <= switch})
    assert got == want and 0 < len([v for v in got.values() if v[1]]) < len(got)
