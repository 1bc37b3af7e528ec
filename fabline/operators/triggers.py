"""Windows and the delta trigger (W1, W2, W3).

The delta trigger keeps, per key and tumbling window, an anchor reading and
fires when the reading's delta from the anchor exceeds the threshold; the
anchor moves only on firing, so the result is a fold over the window's rows
in time order (``run_fold``), the same in batch and stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.fold import FoldSpec, run_fold
from fabline.operators.ordered import null_safe_join


def window_ms(ms: int) -> str:
    return f"{ms} milliseconds"


# --- W1 ---------------------------------------------------------------------
def tumbling(df: DataFrame, key: str = "key", ts: str = "ts", window: str = "3 seconds",
             fields=("x", "y", "z")) -> DataFrame:
    """Keyed tumbling window: per key and window the row count, the time
    span and the field means."""
    g = df.groupBy(key, F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        *[F.avg(f).alias(f"avg_{f}") for f in fields])
    return g.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n", "first_ts", "last_ts", *[f"avg_{f}" for f in fields])


# --- W2 ---------------------------------------------------------------------
def mean_change(anchor: tuple, point: tuple) -> float:
    """The line's delta function: mean absolute change of the three axes."""
    return (abs(anchor[0] - point[0]) + abs(anchor[1] - point[1]) + abs(anchor[2] - point[2])) / 3.0


def delta_spec(window_us: int, threshold: float, level_limit: float,
               delta_fn: Callable[[tuple, tuple], float] = mean_change) -> FoldSpec:
    """The delta trigger as a fold over one key's readings in (ts, seq) order.

    The state carries the window it belongs to and starts anew in the next,
    so a window with very many rows is cut into segments like any other run.
    """
    def step(state, r):
        window = r.ts_us // window_us
        if state is None or state[0] != window:  # first row: anchor only
            return [window, r.x, r.y, r.z, r.ts_us, r.seq, r.x, r.y, r.z], None
        _, ax, ay, az, ets, es, ex, ey, ez = state
        if r.ts_us != ets:                      # newest row so far (maxBy on ts)
            ets, es, ex, ey, ez = r.ts_us, r.seq, r.x, r.y, r.z
        change = delta_fn((ax, ay, az), (r.x, r.y, r.z))
        stall = bool(r.rolling) and (abs(r.x) + abs(r.y) + abs(r.z)) / 3.0 < level_limit
        delta = 1.0 if stall else change
        out = None
        if delta > threshold:
            ax, ay, az = r.x, r.y, r.z
            out = [(window * window_us, r.seq, es, r.ts_us, ex, ey, ez, change, delta, stall, bool(r.rolling))]
        return [window, ax, ay, az, ets, es, ex, ey, ez], out

    return FoldSpec(lambda: None, step, ["seq", "ts_us", "x", "y", "z", "rolling"],
                    "window_us long, fire_seq long, seq long, ts_us long, x double, y double, z double, "
                    "change double, delta double, stall boolean, rolling boolean")


def delta_input(df: DataFrame, key: str, ts: str, seq: str, rolling: str | None) -> DataFrame:
    roll = F.coalesce(F.col(rolling), F.lit(False)) if rolling else F.lit(False)
    return df.where(F.col(ts).isNotNull()).select(
        F.col(key).alias(key), F.col(ts).alias("ts"), F.unix_micros(F.col(ts)).alias("ts_us"), F.col(seq).alias("seq"),
        "x", "y", "z", roll.alias("rolling"))


def delta_output(out: DataFrame, key: str, window_us: int) -> DataFrame:
    return out.select(key, F.timestamp_micros("window_us").alias("window_start"),
                      F.timestamp_micros(F.col("window_us") + window_us).alias("window_end"), "fire_seq", "seq",
                      F.timestamp_micros("ts_us").alias("ts"), "x", "y", "z", "change", "delta", "stall", "rolling")


def delta_trigger(df: DataFrame, key: str = "key", ts: str = "ts", seq: str = "seq",
                  window: str = window_ms(C.WINDOW_MS), threshold: float = C.DELTA_THRESHOLD,
                  level_limit: float = C.VIBRATION_LIMIT, rolling: str | None = "rolling",
                  delta_fn: Callable[[tuple, tuple], float] = mean_change,
                  segment_rows: int = 2_000_000) -> DataFrame:
    """Fired rows of the delta trigger per key and tumbling window.

    For each reading p (in ``(ts, seq)`` order) with anchor a:
    ``change = delta_fn(a, p)`` (default ``(|ax-px|+|ay-py|+|az-pz|)/3``);
    ``stall = rolling and level < limit``; the delta is 1 on a stall, else
    ``change``; fire when delta > threshold and move the anchor to p. The
    first reading of a window only sets the anchor. Each firing emits the
    newest row of the window so far (the earliest one with p's ``ts``).

    Output: ``key, window_start, window_end, fire_seq, seq, ts, x, y, z,
    change, delta, stall, rolling``.

    Comparisons with NaN are false: a NaN (or null) reading never fires, and
    as a window's first reading it keeps the others from firing. A null key
    is a key; readings without a time lie in no window. One pass, linear in
    the rows; keys over ``segment_rows`` rows are folded in parallel
    segments, with the same result.
    """
    us = int(window_seconds(window) * 1_000_000)
    out = run_fold(delta_input(df, key, ts, seq, rolling).drop("ts"), [key], ["ts_us", "seq"],
                   delta_spec(us, threshold, level_limit, delta_fn), segment_rows=segment_rows)
    return delta_output(out, key, us)


_UNITS = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def window_seconds(window: str) -> float:
    """Length of a ``"<n> <unit>"`` window string in seconds."""
    n, unit = window.strip().split()
    return float(n) * _UNITS[unit.lower().rstrip("s")]


# --- W3 ---------------------------------------------------------------------
def watermark_late(df: DataFrame, ts: str = "ts", arrival: str = "seq", delay_ms: int = 0,
                   arrival_width: int = 1_000_000, newest=None) -> DataFrame:
    """Flag rows that arrive behind the watermark: ``ts`` older than the
    newest ``ts`` seen before them (in ``arrival`` order) minus ``delay_ms``.
    ``newest`` is the newest time of rows that arrived before all of ``df``.

    The running maximum works per arrival bucket (``arrival // width``) in
    parallel and carries earlier buckets' maxima through a small table.
    """
    b = df.withColumn("__b", F.floor(F.col(arrival) / arrival_width))
    w_local = Window.partitionBy("__b").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("__lmax", F.max(ts).over(w_local))
    per = b.groupBy("__b").agg(F.max(ts).alias("__bmax"))
    w_b = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select("__b", F.max("__bmax").over(w_b).alias("__cmax"))
    j = null_safe_join(local, carried, ["__b"])
    wm = F.greatest(F.col("__lmax"), F.col("__cmax"), F.lit(newest).cast(df.schema[ts].dataType))
    late = F.coalesce(F.col(ts) < wm - F.expr(f"INTERVAL {delay_ms} MILLISECONDS"), F.lit(False))
    return j.withColumn("is_late", late).drop("__b", "__lmax", "__cmax")
