"""The bucketed order helpers equal plain per-key window functions."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fabline.operators.ordered import asof_last, day_bucket, prefix_sum, prev_row


def _skewed(spark, n=4000, seed=3):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.34 else rnd.randint(1, 6)      # one key holds a third
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 20 * 86400))
        v = rnd.choice([None, None, rnd.randint(0, 9)])
        rows.append((key, ts, i, v, rnd.randint(0, 5)))
    df = spark.createDataFrame(rows, "k long, ts timestamp, seq long, v int, w int")
    return df.withColumn("__day", day_bucket("ts"))


def test_prefix_sum_equals_window(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("seq", F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("a"),
                    F.coalesce(F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    got_a = prefix_sum(df, ["k"], ["ts", "seq"], "__day", {"a": F.col("w")})
    got_b = prefix_sum(df, ["k"], ["ts", "seq"], "__day", {"b": F.col("w")}, inclusive=False)
    got = got_a.select("seq", "a").join(got_b.select("seq", "b"), "seq")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_asof_last_equals_window(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("seq", F.last("v", ignorenulls=True).over(w).alias("v_asof"))
    got = asof_last(df, ["k"], ["ts", "seq"], "__day", ["v"]).select("seq", "v_asof")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_prev_row_equals_lag(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("seq", F.lag("v").over(w).alias("prev_v"), F.lag("w").over(w).alias("prev_w"))
    got = prev_row(df, ["k"], ["ts", "seq"], "__day", ["v", "w"]).select("seq", "prev_v", "prev_w")
    assert sorted(got.collect()) == sorted(exp.collect())
