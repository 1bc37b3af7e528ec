"""Streaming sinks and the series store."""

import datetime as dt

from pyspark.sql import functions as F

from fabline.sources.sinks import upsert_into
from fabline.streaming import stateful as SF
from fabline.streaming import stream as ST

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _points(spark, rows):
    return spark.createDataFrame(
        [(m, T0 + dt.timedelta(milliseconds=ms), s, x) for m, ms, s, x in rows],
        "measurement string, ts timestamp, seq long, x double").withColumns({"y": F.lit(0.0), "z": F.lit(0.0)})


def test_upsert_last_write_wins_and_keeps_other_partitions(spark, tmp_path):
    store = str(tmp_path / "store")
    upsert_into(spark, _points(spark, [("a", 0, 1, 1.0), ("a", 5, 2, 2.0), ("b", 0, 3, 3.0)]), store)
    upsert_into(spark, _points(spark, [("a", 5, 4, 9.0), ("a", 7, 5, 7.0)]), store)
    got = sorted((r.measurement, r.seq, r.x) for r in spark.read.parquet(store).collect())
    assert got == [("a", 1, 1.0), ("a", 4, 9.0), ("a", 5, 7.0), ("b", 3, 3.0)]


def test_upsert_stream_and_restart(spark, tmp_path):
    src, store, ck = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ck")
    p1 = _points(spark, [("a", 0, 1, 1.0), ("a", 5, 2, 2.0)])
    p1.write.parquet(f"{src}/1")
    schema = p1.schema
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    ST.upsert_stream(s, store, ck).awaitTermination()
    _points(spark, [("a", 5, 3, 5.0)]).write.parquet(f"{src}/2")
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    ST.upsert_stream(s, store, ck).awaitTermination()   # resumes from the checkpoint
    got = sorted((r.seq, r.x) for r in spark.read.parquet(store).collect())
    assert got == [(1, 1.0), (3, 5.0)]


def test_command_stream_round_trip(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    cmds = spark.createDataFrame([("/rolling/control", "z", T0, 1), ("/rolling/control", "p", T0, 1)],
                                 "topic string, payload string, ts timestamp, seq long")
    cmds.write.parquet(src)
    s = spark.readStream.schema(cmds.schema).parquet(src)
    ST.command_stream(s, out, ck).awaitTermination()
    assert sorted(r.payload for r in spark.read.parquet(out).collect()) == ["p", "z"]


def test_stream_trigger_drops_late_rows(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "key string, ts timestamp, seq long, x double, y double, z double, rolling boolean"

    def rows(*rs):
        return spark.createDataFrame([("m", T0 + dt.timedelta(seconds=s), q, x, 0.0, 0.0, False)
                                      for s, q, x in rs], schema)

    def run():
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        ST.run_to_parquet(SF.delta_trigger_live(s, "0 seconds", window="3 seconds"), out, ck).awaitTermination()

    rows((0, 1, 0.0), (1, 2, 3.0), (4, 3, 0.0), (5, 4, 3.0)).coalesce(1).write.parquet(f"{src}/a")
    run()
    # arrives after the watermark passed 5 s: window [0, 3) is closed, this row is late
    rows((2, 5, 9.0), (9, 6, 0.0)).coalesce(1).write.parquet(f"{src}/b")
    run()   # restarts from the checkpoint, watermark included
    got = sorted(r.fire_seq for r in spark.read.parquet(out).collect())
    # [0,3): 1 anchors, 2 fires (late 5 dropped); [3,6): 3 anchors, 4 fires; [9,12) has its anchor only
    assert got == [2, 4]


def test_stream_tumbling_equals_batch_on_closed_windows(spark, tmp_path):
    from fabline.operators.triggers import tumbling
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    rows = [("a" if i % 3 else "b", T0 + dt.timedelta(seconds=i * 1.7), i, float(i % 5), 0.0, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, seq long, x double, y double, z double")
    df.write.parquet(src)
    s = spark.readStream.schema(df.schema).parquet(src)
    ST.run_to_parquet(ST.stream_tumbling(s, window="5 seconds"), out, ck).awaitTermination()
    got = spark.read.parquet(out)
    last = df.agg(F.max("ts")).first()[0]
    exp = tumbling(df, window="5 seconds").where(F.col("window_end") <= F.lit(last))
    cols = ["key", "window_start", "n", "avg_x"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())
    assert got.count() > 0


def test_stream_fold_in_many_shuffled_batches_with_restart(spark, tmp_path):
    """Rows out of order within the delay, one file a batch, a restart in the middle: equal to the batch trigger."""
    import random

    from fabline.operators.triggers import delta_trigger
    rnd = random.Random(5)
    schema = "key string, ts timestamp, seq long, x double, y double, z double, rolling boolean"
    rows = [(rnd.choice(["a", "b"]), T0 + dt.timedelta(seconds=i), i, rnd.choice([0.0, 1.0, 3.0]), 0.0, 0.0, rnd.random() < 0.3) for i in range(120)]
    late = sorted(rows, key=lambda r: r[2] + rnd.randint(0, 15))
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
        ST.run_to_parquet(SF.delta_trigger_live(s, "20 seconds", window="30 seconds"), out, ck).awaitTermination()

    for n, part in enumerate([late[:40], late[40:80], late[80:], [(None, T0 + dt.timedelta(hours=1), 999, 0.0, 0.0, 0.0, False)]]):
        for k in range(0, len(part), 20):
            spark.createDataFrame(part[k:k + 20], schema).coalesce(1).write.parquet(f"{src}/{n}_{k}")
        run()
    want = delta_trigger(spark.createDataFrame(rows, schema), window="30 seconds")
    cols = ["key", "window_start", "fire_seq", "seq", "change", "stall"]
    assert sorted(spark.read.parquet(out).select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert want.count() > 10


def test_session_needs_no_settings(tmp_path):
    """A query without checkpoints runs on a plain session; a cluster without a shared folder is refused."""
    import subprocess
    import sys
    import textwrap
    code = textwrap.dedent("""
        from pyspark.sql import SparkSession
        import fabline.plans.registry as R
        from fabline.session import ensure_checkpoint_dir
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        assert R.QUERIES["daily_quality"](spark, "/root/testdata/sf0.001").count() > 0
        assert R.QUERIES["debounce_change"](spark, "/root/testdata/sf0.001").count() > 0
        print("fine")
    """)
    import os
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "fine" in done.stdout, done.stderr[-2000:]
