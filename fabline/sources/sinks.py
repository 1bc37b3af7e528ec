"""Series store and message sinks: upsert (S2), count-triggered export
batches (S3), series purge (S10), command output (S11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.ordered import null_safe_join, prefix_sum, row_bucket
from fabline.session import ensure_checkpoint_dir


# --- S2 ---------------------------------------------------------------------
def point_time(ts: str = "ts", precision_ms: int = 1):
    """Point time truncated to the store's precision (epoch milliseconds)."""
    ms = F.floor(F.unix_micros(F.col(ts)) / 1000).cast("bigint")
    return (F.floor(ms / precision_ms) * precision_ms).cast("bigint") if precision_ms > 1 else ms


def ts_upsert(points: DataFrame, measurement: str = "measurement", ts: str = "ts",
              seq: str = "seq", fields=("x", "y", "z"), precision_ms: int = 1) -> DataFrame:
    """One row per (measurement, point time): the last written (highest
    ``seq``) fields win, as when a store overwrites a point."""
    t = point_time(ts, precision_ms)
    g = points.groupBy(F.col(measurement).alias("measurement"), t.alias("time_ms")).agg(
        F.max_by(F.struct(*fields), F.col(seq)).alias("f"), F.count(F.lit(1)).alias("n_writes"))
    return g.select("measurement", "time_ms", *[F.col(f"f.{c}").alias(c) for c in fields], "n_writes")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def upsert_into(spark: SparkSession, batch: DataFrame, path: str, measurement: str = "measurement",
                ts: str = "ts", seq: str = "seq", fields=("x", "y", "z")) -> None:
    """Merge a batch of points into a parquet series store partitioned by
    measurement and day; only touched partitions are rewritten.

    Suitable as a ``foreachBatch`` function. The store is read with the
    batch's own schema (a measurement ``007`` stays a text) and touched
    partitions are found null-safe. The merged result is checkpointed
    (reliable, shared folder) before the overwrite so the write never reads
    the files it replaces. Partition folders hold no empty text: an empty
    measurement is stored like a null one.
    """
    new = (batch.select(F.col(measurement).alias("measurement"), F.col(ts).alias("ts"),
                        F.col(seq).alias("seq"), *fields)
           .withColumn("day", F.to_date("ts")))
    new = new.withColumn("measurement", F.nullif(F.col("measurement"), F.lit("")))
    allr = new
    if _exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        touched = new.select("measurement", "day").distinct()
        allr = null_safe_join(old, touched, ["measurement", "day"], "left_semi").unionByName(new)
    ensure_checkpoint_dir(spark)
    merged = ts_upsert(allr.withColumn("ms_ts", F.col("ts")), ts="ms_ts", fields=("ts", "seq", *fields))
    merged = merged.select("measurement", "ts", "seq", *fields).withColumn("day", F.to_date("ts")).checkpoint()
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("measurement", "day").parquet(path))


# --- S3 ---------------------------------------------------------------------
def export_batches(df: DataFrame, series: str = "series", order=("ts", "seq"),
                   batch: int = C.EXPORT_BATCH) -> DataFrame:
    """Number each series' points in order and cut them into full batches of
    ``batch`` rows; the incomplete tail stays behind (not exported).

    Row numbers come from a bucketed running count, so a series with most of
    the rows is still numbered by many tasks.
    """
    d = row_bucket(df, [series], order[0])
    n = prefix_sum(d, [series], list(order), "__day", {"rn": F.lit(1)}).drop("__day")
    sizes = df.groupBy(series).agg(F.count(F.lit(1)).alias("__n"))
    out = null_safe_join(n, sizes, [series]).withColumn("batch_no", F.floor((F.col("rn") - 1) / batch).cast("bigint"))
    full = F.col("batch_no") < F.floor(F.col("__n") / batch)
    return out.where(full).drop("__n")


# --- S10 --------------------------------------------------------------------
def series_purge(stored: DataFrame, exported: DataFrame, keys=("series", "seq")) -> DataFrame:
    """Rows still in the store after the exported batches are dropped (a null series is a series)."""
    return null_safe_join(stored, exported.select(*keys), list(keys), "left_anti")


def ensure_database(spark: SparkSession, name: str) -> None:
    """Catalog database of the series tables (one table per measurement)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


# --- S11 --------------------------------------------------------------------
def command_out(commands: DataFrame, topic: str, payload: str = "command",
                ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Decisions as outgoing messages ``topic, payload, ts, seq``."""
    return commands.select(F.lit(topic).alias("topic"), F.col(payload).alias("payload"),
                           F.col(ts).alias("ts"), F.col(seq).alias("seq"))
