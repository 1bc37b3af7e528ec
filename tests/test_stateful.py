"""Typed streaming state: trigger, alarms with timers, live export, late rows; the store's export and purge."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators import filters as FL
from fabline.operators import lifecycle as LC
from fabline.operators.aggs import daily_quality, train_cap
from fabline.operators.anomaly import anomaly_cooldown
from fabline.operators.triggers import delta_trigger, watermark_late
from fabline.sources import sinks as SK
from fabline.sources import store as STORE
from fabline.streaming import stateful as SF
from fabline.streaming import stream as ST

T0 = dt.datetime(2024, 1, 1)
READING = "key string, ts timestamp, seq long, x double, y double, z double, rolling boolean"


def sec(s):
    return T0 + dt.timedelta(seconds=s)


def land(spark, src, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{name}")


def source(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


def forget_last_commit(checkpoint):
    """As if the query had been killed after the sink wrote its last micro-batch and before that was committed."""
    commits = checkpoint / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    return last


# W2

def test_state_written_follows_new_rows_not_waiting_ones(spark, tmp_path):
    """Nothing becomes due for six batches: each writes its own rows, however many wait."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for b in range(7):
        land(spark, src, b, [("m", sec(b * 50 + i), b * 50 + i, float(i % 4), 0.0, 0.0, False) for i in range(50)], READING)
    q = ST.run_to_parquet(SF.delta_trigger_live(source(spark, src, READING), "1 hour", window="1 day"), out, ck)
    q.awaitTermination()
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"]]
    puts = [o["customMetrics"]["rocksdbPutCount"] for o in ops]
    waits = [o["numRowsTotal"] for o in ops]
    assert waits[-1] > 6 * waits[0] and max(puts[1:]) <= puts[1] * 1.2 and max(puts[1:]) < 50 * 3


def test_windows_go_with_their_state(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for b in range(6):
        land(spark, src, b, [("m", sec(b * 100 + i * 10), b * 10 + i, float(i % 3), 0.0, 0.0, False) for i in range(10)], READING)
    land(spark, src, "end", [("end", sec(5000), 999, 0.0, 0.0, 0.0, False)], READING)
    q = ST.run_to_parquet(SF.delta_trigger_live(source(spark, src, READING), "10 seconds", window="30 seconds"), out, ck)
    q.awaitTermination()
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 10  # the closing row's group only
    rows = [("m", sec(b * 100 + i * 10), b * 10 + i, float(i % 3), 0.0, 0.0, False) for b in range(6) for i in range(10)]
    want = delta_trigger(spark.createDataFrame(rows, READING), window="30 seconds")
    cols = ["key", "fire_seq", "seq", "change"]
    assert sorted(spark.read.parquet(out).select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_equal_rows_and_rows_without_a_time(spark, tmp_path):
    """Equal rows are rows of their own; a row without a time is never due and goes to the side table."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = [("m", sec(0), 1, 0.0, 0.0, 0.0, False), ("m", sec(1), 2, 3.0, 0.0, 0.0, False), ("m", sec(1), 2, 9.0, 0.0, 0.0, False),
            ("m", None, 3, 0.0, 0.0, 0.0, False), ("m", sec(900), 4, 0.0, 0.0, 0.0, False), (None, sec(901), 5, 0.0, 0.0, 0.0, False)]
    land(spark, src, "a", rows, READING)
    land(spark, src, "b", [("end", sec(9000), 9, 0.0, 0.0, 0.0, False)], READING)
    s = source(spark, src, READING)
    ST.run_to_parquet(SF.delta_trigger_live(s, "0 seconds", window="1 minute"), out, ck).awaitTermination()
    assert sorted((r.fire_seq, r.change) for r in spark.read.parquet(out).collect()) == [(2, 1.0), (2, 2.0)]
    ST.run_to_parquet(SF.without_time(s), str(tmp_path / "side"), str(tmp_path / "ck2")).awaitTermination()
    assert [r.seq for r in spark.read.parquet(str(tmp_path / "side")).collect()] == [3]


# W5

def test_start_leaves_by_its_timer(spark, tmp_path):
    """STOP leaves with the alarm, START micro-batches later, though its machine is silent by then."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run():
        live = SF.alarms_live(source(spark, src, READING), "0 seconds", window="1 hour", level_limit=1.2, change_limit=2.0, cooldown_s=300)
        SF.write_micro_batches(live, out, ck).awaitTermination()

    def events():
        return {(r.event, r.seq): (r["micro"], r.ts, r.restart_ts) for r in spark.read.parquet(out).collect()}

    # rolling and still: every reading stalls and fires; the second bad firing in a row is an alarm
    land(spark, src, "0", [("m", sec(i), i, 0.1, 0.1, 0.1, True) for i in range(4)], READING)
    land(spark, src, "1", [("other", sec(60), 100, 0.0, 0.0, 0.0, False)], READING)
    run()
    assert set(events()) == {("stop", 2)}
    land(spark, src, "2", [("other", sec(301), 101, 0.0, 0.0, 0.0, False)], READING)  # restart is due at 302
    run()
    assert set(events()) == {("stop", 2)}
    land(spark, src, "3", [("other", sec(400), 102, 0.0, 0.0, 0.0, False)], READING)
    run()
    got = events()
    assert set(got) == {("stop", 2), ("start", 2)}
    assert got["start", 2][0] > got["stop", 2][0] and got["start", 2][1] == got["stop", 2][2] == sec(302) and got["stop", 2][1] == sec(2)
    commands = sorted((r.payload, r.ts) for r in SF.live_commands(spark.read.parquet(out)).collect())
    assert commands == [("m", sec(302)), ("p", sec(2)), ("s", sec(302)), ("z", sec(2))]


def test_live_alarms_equal_batch_alarms(spark, tmp_path):
    rnd = random.Random(8)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = [(rnd.choice("ab"), sec(20 * i), i, rnd.choice([0.1, 0.1, 3.0]), 0.1, 0.1, rnd.random() < 0.8) for i in range(150)]
    shuffled = sorted(rows, key=lambda r: r[2] + rnd.randint(0, 8))
    for k in range(0, 150, 50):
        land(spark, src, k, shuffled[k:k + 50], READING)
    land(spark, src, "end", [("end", sec(99999), 999, 0.0, 0.0, 0.0, False)], READING)
    live = SF.alarms_live(source(spark, src, READING), "10 minutes", window="1 hour", level_limit=1.2, change_limit=2.0, cooldown_s=120)
    ST.run_to_parquet(live, out, ck).awaitTermination()
    fired = delta_trigger(spark.createDataFrame(rows, READING), window="1 hour", level_limit=1.2)
    want = anomaly_cooldown(fired, level_limit=1.2, change_limit=2.0, cooldown_s=120)
    cols = ["key", "seq", "alarm_ts", "restart_ts", "streak"]
    got = spark.read.parquet(out)
    for event in ("stop", "start"):
        assert sorted(got.where(F.col("event") == event).select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert want.count() > 5


# S3

POINT = "series string, seq long, ts timestamp, quality string, datapoints string"


def point_rows(n, seed=3):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "a", "a", "b", None]), i, sec(rnd.randint(0, 500)), rnd.choice(["good", "defect1"]), str(i)) for i in range(n)]


def batch_exports(spark, rows, batch):
    b = SK.export_batches(spark.createDataFrame(rows, POINT), batch=batch)
    return sorted((r.series or "", r.batch_no, r.rn, r.seq) for r in b.collect())


def test_live_export_equals_batch_and_survives_a_kill(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "ck"
    rows = sorted(point_rows(230), key=lambda r: r[2])

    def run():
        SF.write_micro_batches(SF.export_live(source(spark, src, POINT), "30 seconds", batch=10), out, str(ck)).awaitTermination()

    def got():
        return sorted((r.series or "", r.batch_no, r.rn, r.seq) for r in spark.read.parquet(out).collect())

    for k in range(0, 150, 50):
        land(spark, src, k, rows[k:k + 50], POINT)
    run()
    before = got()
    forget_last_commit(ck)
    run()  # the last micro-batch runs again over its own folder
    assert got() == before
    for k in range(150, 230, 40):
        land(spark, src, k, rows[k:k + 40], POINT)
    land(spark, src, "end", [("end", 999, sec(9999), "good", "")], POINT)
    run()
    forget_last_commit(ck)
    run()
    assert got() == batch_exports(spark, rows, 10)
    assert len({r.batch_no for r in spark.read.parquet(out).where("series = 'a'").collect()}) > 5


def test_open_batch_is_only_added_to(spark, tmp_path):
    """Rows that gather below a full batch are appended, not written again."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for b in range(6):
        land(spark, src, b, [("a", b * 20 + i, sec(b * 20 + i), "good", "v") for i in range(20)], POINT)
    q = SF.write_micro_batches(SF.export_live(source(spark, src, POINT), "0 seconds", batch=1000), out, ck)
    q.awaitTermination()
    puts = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in q.recentProgress if p["numInputRows"]]
    assert max(puts[1:]) <= puts[1] * 1.3


# S10

class Crash(Exception):
    pass


def all_rows(spark, store):
    kept = [("store", r.series, r.seq) for r in STORE.points(spark, store).collect()]
    return sorted([(s or "", q) for _, s, q in kept] + [(r.series or "", r.seq) for r in STORE.exports(spark, store).collect()])


@pytest.mark.parametrize("step", ["exports", "staging", "manifest", "replace", "emptied", "done"])
def test_a_crash_at_any_step_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, step):
    store = str(tmp_path / "store")
    rows = point_rows(120) + [("x:y", 1000 + i, sec(i), "good", "v") for i in range(20)]  # 20 full rows: its partition empties
    STORE.append_points(spark.createDataFrame(rows, POINT), store)
    want = sorted((r[0] or "", r[1]) for r in rows)
    purge, publish, replace = STORE.series_purge, STORE._publish, STORE._replace

    def stop(*_, **__):
        raise Crash(step)

    def publish_until(spark_, path, text):
        if (step == "manifest" and path.endswith(".json")) or (step == "done" and path.endswith(".done")):
            raise Crash(step)
        publish(spark_, path, text)

    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def delete(self, *_):
            raise Crash(step)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    with monkeypatch.context() as m:
        if step == "exports":
            m.setattr(STORE, "series_purge", stop)
        elif step == "replace":
            m.setattr(STORE, "_replace", stop)
        elif step == "emptied":
            real = STORE._fs
            m.setattr(STORE, "_fs", lambda s, p: (Fs(real(s, p)[0]), real(s, p)[1]))
        elif step in ("manifest", "done"):
            m.setattr(STORE, "_publish", publish_until)
        else:
            m.setattr(STORE.json, "dumps", stop)
        with pytest.raises(Crash):
            STORE.export_and_purge(spark, store, batch=20)
    counted = STORE.committed(spark, store)
    assert bool(counted) == (step in ("replace", "emptied", "done"))
    STORE.recover(spark, store)
    assert all_rows(spark, store) == want
    STORE.export_and_purge(spark, store, batch=20)
    assert all_rows(spark, store) == want
    left = STORE.points(spark, store).groupBy("series").count().collect()
    assert all(r["count"] < 20 for r in left) and None in {r.series for r in left} and "x:y" not in {r.series for r in left}
    assert STORE.export_and_purge(spark, store, batch=20) is None and all_rows(spark, store) == want
    assert purge is STORE.series_purge and replace is STORE._replace


def test_points_that_come_later_go_into_the_next_run(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = point_rows(200)
    for k in range(0, 200, 50):
        STORE.append_points(spark.createDataFrame(rows[k:k + 50], POINT), store)
        STORE.export_and_purge(spark, store, batch=7)
    assert all_rows(spark, store) == sorted((r[0] or "", r[1]) for r in rows)
    sizes = STORE.exports(spark, store).groupBy("run", "series", "batch_no").count().collect()
    assert {r["count"] for r in sizes} == {7} and len({r.run for r in sizes}) == 4


def test_null_series_is_purged_and_capped(spark):
    rows = spark.createDataFrame([(None if i % 2 else "a", i, sec(i), "good", "v") for i in range(100)], POINT)
    b = SK.export_batches(rows)
    assert b.count() == 100 and SK.series_purge(rows, b).count() == 0
    recs = b.withColumn("file_ts", F.max("ts").over(Window.partitionBy("series", "batch_no"))).withColumnRenamed("quality", "label")
    assert train_cap(recs, file_cols=("series", "batch_no"), file_order=("file_ts",)).count() == 100


# W3

def test_every_row_is_on_time_or_late(spark, tmp_path):
    rnd = random.Random(4)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "ck"
    schema = "seq long, ts timestamp, v string"
    rows = [(i, None if i % 41 == 0 else sec(i + rnd.choice([0, 0, 0, -30, -90, 40])), "v") for i in range(300)]

    def run():
        SF.split_late(source(spark, src, schema), out, str(ck), delay_ms=20_000).awaitTermination()

    for k in range(0, 200, 50):
        land(spark, src, k, rows[k:k + 50], schema)
    run()
    forget_last_commit(ck)
    run()
    for k in range(200, 300, 50):
        land(spark, src, k, rows[k:k + 50], schema)
    run()
    got = {name: sorted(r.seq for r in spark.read.parquet(f"{out}/{name}").collect()) for name in ("on_time", "late")}
    flags = watermark_late(spark.createDataFrame(rows, schema), delay_ms=20_000).collect()
    assert got == {"on_time": sorted(r.seq for r in flags if not r.is_late), "late": sorted(r.seq for r in flags if r.is_late)}
    assert len(got["late"]) > 20


# W6 / W8

MSG = "seq long, ts timestamp, id string, topic string, payload string"


def messages(rows):
    return [(n, sec(n), mid, topic, payload) for n, (mid, topic, payload) in enumerate(rows)]


def test_ids_are_allowed_and_taken_off_while_the_stream_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = messages([
        ("a", C.LOADING_MAT_LOADED, None), ("b", C.LOADING_MAT_LOADED, None), ("b", LC.ALLOW_TOPIC, "70"), ("b", C.LOADING_MAT_LOADED, None),
        ("b", C.ROLLING_ROLL_QUERY, None), ("a", C.ROLLING_ROLL_QUERY, None), ("a", LC.REMOVE_TOPIC, None), ("a", C.LOADING_MAT_LOADED, None),
        ("a", C.ROLLING_ROLL_QUERY, None), (None, C.LOADING_MAT_LOADED, None), ("a", LC.ALLOW_TOPIC, "90"), ("a", C.ROLLING_ROLL_QUERY, None)])
    state = LC.lifecycle_state(spark.createDataFrame([("a", "50"), (None, "1")], "id string, thickness string"))

    def run():
        ST.run_to_parquet(SF.lifecycle_live(source(spark, src, MSG), state, "3 seconds"), out, ck).awaitTermination()

    land(spark, src, 0, [rows[i] for i in (2, 0, 1)], MSG)
    land(spark, src, 1, [rows[i] for i in (5, 3, 6, 4)], MSG)
    run()
    land(spark, src, 2, rows[7:], MSG)  # after a restart: the state is the stream's own, not the table's
    land(spark, src, 3, [(99, sec(999), "z", C.LOADING_MAT_LOADED, None)], MSG)
    run()
    got = {r.seq: (r.id, r.action, r.out_payload) for r in spark.read.parquet(out).collect()}
    assert got == {0: ("a", "forward", "a|F"), 1: ("b", "drop", "b|D"), 3: ("b", "forward", "b|F"), 4: ("b", "thickness", "b|70"),
                   5: ("a", "thickness", "a|50"), 7: ("a", "drop", "a|D"), 8: ("a", "thickness", "a|null"), 9: (None, "drop", "None|D"),
                   11: ("a", "thickness", "a|90")}


def test_a_stream_goes_on_from_any_point_of_a_batch(spark, tmp_path):
    rnd = random.Random(9)
    topics = [C.LOADING_MAT_LOADED, C.ROLLING_ROLL_QUERY, C.ROLLING_MAT_AFTER_ROLL, C.QUALITY_MAT_READY_TO_QCHECK, C.COLOUR_MAT_CHECK,
              C.UNLOADING_MAT_QUERY, C.UNLOADING_MAT_FINAL, C.LOADING_MAT_POSITION]
    rows = messages([(rnd.choice("abcd"), rnd.choice(topics), None) for _ in range(200)])
    allow = spark.createDataFrame([("a", "50"), ("b", "60"), ("c", "70")], "id string, thickness string")
    preds = spark.createDataFrame([(n, rnd.choice(["good", "defect1"])) for n in range(200)], "seq long, prediction string")
    cols = ["id", "seq", "action", "out_topic", "out_payload", "quality"]
    want = LC.material_lifecycle(spark.createDataFrame(rows, MSG), allow, preds).select(*cols)
    early = spark.createDataFrame(rows[:90], MSG)
    actions = LC.material_lifecycle(early, allow, preds).select(*cols)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for k in range(90, 200, 60):
        land(spark, src, k, rows[k:k + 60], MSG)
    land(spark, src, "end", [(999, sec(9999), "z", C.LOADING_MAT_LOADED, None)], MSG)
    live = SF.lifecycle_live(source(spark, src, MSG), LC.lifecycle_state(allow, actions, early), "5 seconds", preds)
    ST.run_to_parquet(live, out, ck).awaitTermination()
    got = actions.unionByName(spark.read.parquet(out).select(*cols)).collect()
    assert sorted(map(str, got)) == sorted(map(str, want.collect()))
    assert {"final", "classified", "unload"} <= {r.action for r in got}


# A1 / S9

def test_daily_counts_follow_files_and_touch_their_days_only(spark, tmp_path):
    rnd = random.Random(2)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "ck"
    schema = "day string, quality string"
    rows = [(rnd.choice(["2023-12-31", "2024-01-01", "2024-02-02", None]), rnd.choice(["good", "defect1", "defect2", "none"])) for _ in range(200)]
    late = [("2025-05-05", "good")] * 3 + [("2024-02-02", "good")]

    def run():
        q = SF.daily_quality_live(source(spark, src, schema), out, str(ck))
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    def got():
        return {r.day: (r.good, r.defect1, r.defect2) for r in spark.read.schema(SF.DAILY).parquet(out).collect()}

    def want(rows):
        return {r.day: (r.good, r.defect1, r.defect2) for r in daily_quality(spark.createDataFrame(rows, schema)).collect()}

    for k in range(0, 200, 100):
        land(spark, src, k, rows[k:k + 100], schema)
    assert run() == 200 and got() == want(rows)
    files = {p.name for p in (tmp_path / "out" / "year=2023").iterdir()}
    forget_last_commit(ck)
    run()
    assert got() == want(rows)
    files = {p.name for p in (tmp_path / "out" / "year=2023").iterdir()}
    land(spark, src, "late", late, schema)
    assert run() == 4 and got() == want(rows + late)  # old files are not read again
    assert files == {p.name for p in (tmp_path / "out" / "year=2023").iterdir()}


# F6

def test_recent_range_reads_the_last_days_of_a_store(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "seq long, ts timestamp, key string, day date"
    rows = [(i, sec(3600 * i), "a" if i % 2 else "b") for i in range(100)] + [(500, None, "a")]
    df = spark.createDataFrame(rows, "seq long, ts timestamp, key string").withColumn("day", F.to_date("ts"))
    df.write.partitionBy("key", "day").parquet(path)
    got = FL.recent_from_store(spark, path, schema, minutes=240)
    want = FL.recent_range(df, minutes=240)
    assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in want.collect()) == [95, 96, 97, 98, 99]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert {f.split("/day=")[1].split("/")[0] for f in got.inputFiles()} >= {"2024-01-05"}
    spark.createDataFrame([], df.schema).write.parquet(str(tmp_path / "empty"))
    assert FL.recent_from_store(spark, str(tmp_path / "empty"), schema).collect() == []
