"""Aggregations: quality statistics, readiness, counts, latest-per-key,
downsampling, station logs and loop-time telemetry.

All are declarative ``groupBy().agg()`` plans, so Spark does a partial
(map-side) aggregate before the shuffle and the shuffled data is one row per
group and map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.ordered import day_bucket, null_safe_join, prefix_sum


def _count_if(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")


# --- A1 ---------------------------------------------------------------------
def daily_quality(df: DataFrame, day: str = "day", quality: str = "quality") -> DataFrame:
    """Per day: counts of good / defect1 / defect2; unknown labels still
    yield the day's row (with zeros). Sorted by day."""
    return daily_counts(df, day, quality).orderBy(day)


def daily_counts(df: DataFrame, day: str = "day", quality: str = "quality") -> DataFrame:
    """``daily_quality`` in no order, also over a stream."""
    q = F.col(quality)
    return df.groupBy(day).agg(
        _count_if(q == C.GOOD).alias("good"),
        _count_if(q == C.DEFECT1).alias("defect1"),
        _count_if(q == C.DEFECT2).alias("defect2"))


# --- A2 ---------------------------------------------------------------------
def train_ready(stats: DataFrame, min_sets: int = C.MIN_SETS_FOR_ML) -> DataFrame:
    """Totals over all days and the readiness flag (each class >= min_sets)."""
    tot = stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in C.CLASSES])
    return tot.withColumn("ready", (F.col(C.GOOD) >= min_sets) & (F.col(C.DEFECT1) >= min_sets)
                          & (F.col(C.DEFECT2) >= min_sets))


def ready_at(records: DataFrame, min_sets: int = C.MIN_SETS_FOR_ML, before: dict | None = None,
             label: str = "label", order: str = "seq") -> DataFrame:
    """One row: counts per class (on top of ``before``) and ``switch``, the order of the record that makes A2 true; null
    while a class lacks records. Records without an order or of no known class don't count. A class is completed by
    one of its first ``min_sets`` records, so a task sends on no more than those."""
    had = {c: (before or {}).get(c, 0) for c in C.CLASSES}
    need = {c: min_sets - n for c, n in had.items()}
    known = records.where(F.col(label).isin(*C.CLASSES) & F.col(order).isNotNull()).select(F.col(label).alias("c"), F.col(order).alias("at"))
    counts = known.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("at"))
    first = known.withColumn("n", F.row_number().over(Window.partitionBy("c").orderBy("at")))
    nth = first.where(F.col("n") <= max(1, *need.values())).where(F.col("n") == F.create_map(*[F.lit(x) for e in need.items() for x in e])[F.col("c")])
    both = counts.unionByName(nth.select("c", F.lit(None).cast("bigint").alias("n"), F.col("at").cast("bigint").alias("at")))
    last = [F.max(F.when(F.col("c") == c, F.col("at"))) for c in C.CLASSES if need[c] > 0]
    complete = F.lit(bool(last))
    for c in last:
        complete = complete & c.isNotNull()
    return both.agg(*[(F.coalesce(F.max(F.when(F.col("c") == c, F.col("n"))), F.lit(0)) + had[c]).cast("bigint").alias(c) for c in C.CLASSES],
                    F.when(complete, F.array_max(F.array(*last or [F.lit(None).cast("bigint")]))).alias("switch"))


# --- A3 ---------------------------------------------------------------------
def series_count(df: DataFrame, series: str = "series", field: str = "datapoints") -> DataFrame:
    """Non-null field count per series."""
    return df.groupBy(series).agg(F.count(field).alias("n_points"))


# --- A4 ---------------------------------------------------------------------
def window_max_by(df: DataFrame, key: str = "key", ts: str = "ts", seq: str = "seq",
                  window: str = "3 seconds", fields=("x", "y", "z")) -> DataFrame:
    """Per key and tumbling window: the row with the newest ts; on ties the
    first seen (smallest seq)."""
    pick = F.max_by(F.struct(F.col(seq).alias("seq"), F.col(ts).alias("ts"), *fields),
                    F.struct(F.col(ts), -F.col(seq)))
    g = df.groupBy(key, F.window(ts, window).alias("w")).agg(pick.alias("m"))
    return g.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[F.col(f"m.{c}").alias(c) for c in ("seq", "ts", *fields)])


# --- A7 ---------------------------------------------------------------------
def material_latest(pos: DataFrame, id_col: str = "id", value: str = "value",
                    ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Latest reported position per material."""
    return pos.groupBy(id_col).agg(
        F.max_by(value, F.struct(ts, seq)).alias("position"),
        F.max(ts).alias("updated_at"),
        F.count(F.lit(1)).alias("n_updates"))


# --- A9 ---------------------------------------------------------------------
def station_warnings(df: DataFrame, topics=tuple(C.WARNING_TOPICS), topic: str = "topic",
                     ts: str = "ts") -> DataFrame:
    """Warning / connection messages per station and day."""
    w = df.where(F.col(topic).isin(*topics))
    return w.groupBy(F.try_element_at(F.split(F.col(topic), "/"), F.lit(2)).alias("station"),
                     F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_messages"))


# --- A11 --------------------------------------------------------------------
def loop_time_stats(df: DataFrame, station: str = "station", ms: str = "ms") -> DataFrame:
    return df.groupBy(station).agg(
        F.count(ms).alias("n_reports"), F.round(F.avg(ms), 6).alias("avg_ms"),
        F.max(ms).alias("max_ms"), F.min(ms).alias("min_ms"))


# --- A8 ---------------------------------------------------------------------
def train_cap(records: DataFrame, file_cols=("file_id",), file_order=("file_order",),
              label: str = "label", min_sets: int = C.MIN_SETS_FOR_ML) -> DataFrame:
    """Keep the records of the files read before the cap: files are taken in
    order and reading stops before the first file at which every class count
    so far is strictly above ``min_sets``.

    Per-file counts are one row per file; the running counts over files run
    on that small table.
    """
    per_file = records.groupBy(*file_cols, *file_order).agg(
        *[_count_if(F.col(label) == c).alias(f"n_{c}") for c in C.CLASSES])
    per_file = per_file.withColumn("__day", day_bucket(file_order[0]))
    before = prefix_sum(per_file, [], [*file_order, *file_cols], "__day",
                        {f"b_{c}": F.col(f"n_{c}") for c in C.CLASSES}, inclusive=False)
    full = F.lit(True)
    for c in C.CLASSES:
        full = full & (F.col(f"b_{c}") > min_sets)
    kept = before.where(~full).select(*file_cols)
    return null_safe_join(records, kept, list(file_cols), "left_semi")
