"""Vibration anomaly alarms (W4 streak, W5 cool-down) over fired trigger rows.

A fired row is *bad* when the motor is rolling, its level is below the
stall limit and its change is below the streak limit (half the stall limit
by default). Two bad rows in a row raise an alarm (STOP, then START after
the cool-down). During the cool-down readings are ignored and the streak
counter is kept, so one more bad reading after it alarms again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.functions.decode import amplitude
from fabline.operators.fold import FoldSpec, run_fold
from fabline.operators.ordered import asof_last, prefix_sum, row_bucket


def bad_reading(level: Column, change: Column, rolling: Column,
                level_limit: float = C.VIBRATION_LIMIT, change_limit: float | None = None) -> Column:
    cl = level_limit / 2.0 if change_limit is None else change_limit
    return F.coalesce(rolling, F.lit(False)) & (level < F.lit(level_limit)) & (change < F.lit(cl))


def _with_bad(fired: DataFrame, level_limit, change_limit) -> DataFrame:
    lvl = amplitude(F.col("x"), F.col("y"), F.col("z"))
    return fired.withColumns({"level": lvl}).withColumn(
        "bad", bad_reading(F.col("level"), F.col("change"), F.col("rolling"), level_limit, change_limit))


# --- W4 ---------------------------------------------------------------------
def anomaly_streak(fired: DataFrame, key: str = "key", level_limit: float = C.VIBRATION_LIMIT,
                   change_limit: float | None = None, alarm_over: int = C.ALARM_STREAK) -> DataFrame:
    """Consecutive-bad counter per key without cool-down: ``streak`` is the
    number of bad rows ending at this row (0 when not bad); ``alarm`` when
    it exceeds ``alarm_over``. Window functions only (row buckets)."""
    b = row_bucket(_with_bad(fired, level_limit, change_limit), [key])
    order = ["ts", "fire_seq"]
    n = prefix_sum(b, [key], order, "__day", {"__rn": F.lit(1)})
    n = n.withColumn("__nb", F.when(~F.col("bad"), F.col("__rn")))
    a = asof_last(n, [key], order, "__day", ["__nb"])
    streak = F.when(F.col("bad"), F.col("__rn") - F.coalesce(F.col("__nb_asof"), F.lit(0))).otherwise(0)
    return (a.withColumn("streak", streak.cast("bigint"))
            .withColumn("alarm", F.col("streak") > alarm_over)
            .drop("__day", "__rn", "__nb", "__nb_asof"))


# --- W5 ---------------------------------------------------------------------
def cooldown_spec(cooldown_us: int, alarm_over: int) -> FoldSpec:
    def init():
        return [0, None]

    def step(state, r):
        cnt, sup = state
        ts_us = r.ts_us
        if sup is not None and ts_us < sup:
            return state, None
        cnt = cnt + 1 if r.bad else 0
        if cnt > alarm_over:
            restart = ts_us + cooldown_us
            return [cnt, restart], [(r.fire_seq, ts_us, restart, cnt)]
        return [cnt, sup], None

    return FoldSpec(init, step, ["ts_us", "fire_seq", "bad"],
                    "seq long, alarm_us long, restart_us long, streak long")


def anomaly_cooldown(fired: DataFrame, key: str = "key", level_limit: float = C.VIBRATION_LIMIT,
                     change_limit: float | None = None, cooldown_s: float = C.COOLDOWN_S,
                     alarm_over: int = C.ALARM_STREAK, segment_rows: int = 2_000_000) -> DataFrame:
    """Alarms with cool-down per key: ``key, seq, alarm_ts, restart_ts, streak``.

    STOP is sent at ``alarm_ts`` and START at ``restart_ts``; readings before
    ``restart_ts`` are skipped and leave the counter unchanged.
    """
    b = _with_bad(fired, level_limit, change_limit).withColumn("ts_us", F.unix_micros("ts"))
    out = run_fold(b, [key], ["ts_us", "fire_seq"],
                   cooldown_spec(int(cooldown_s * 1_000_000), alarm_over), segment_rows=segment_rows)
    return out.select(key, "seq", F.timestamp_micros("alarm_us").alias("alarm_ts"),
                      F.timestamp_micros("restart_us").alias("restart_ts"), "streak")


def alarm_commands(alarms: DataFrame) -> DataFrame:
    """Motor control messages of each alarm: ``z``, ``p`` (stop) at the alarm
    and ``m``, ``s`` (start) after the cool-down."""
    stop = alarms.select(F.lit(C.ROLLING_CONTROL).alias("topic"),
                         F.explode(F.array(F.lit("z"), F.lit("p"))).alias("payload"),
                         F.col("alarm_ts").alias("ts"), "seq")
    start = alarms.select(F.lit(C.ROLLING_CONTROL).alias("topic"),
                          F.explode(F.array(F.lit("m"), F.lit("s"))).alias("payload"),
                          F.col("restart_ts").alias("ts"), "seq")
    return stop.unionByName(start)
