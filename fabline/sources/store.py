"""A running series store: points are exported in full batches and then purged (S3, S10), safe against crashes.

The store is a parquet folder partitioned by series and day. One run of ``export_and_purge``

1. writes the full batches of every series to ``exports/run=<n>`` (a run that stopped before is written over),
2. writes what stays of the touched partitions to ``staging/run=<n>``,
3. commits ``manifest/<n>.json`` with one rename: from here on the run counts as exported,
4. replaces the touched partitions by the staged ones and marks the run ``manifest/<n>.done``.

A crash before 3 leaves store and committed exports as they were; a crash after 3 is repaired by the next call, which
does 4 again from the staged files before anything else. So a point is in the store or in one committed export, never in
both and never in neither. One writer at a time; points that arrive later go into the next run.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.ordered import null_safe_join
from fabline.sources.sinks import export_batches, series_purge

POINT = "seq bigint, ts timestamp, quality string, datapoints string, series string, day date"
PARTS = ["series", "day"]


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all: under another name first, then renamed."""
    fs, at = _fs(spark, path)
    part = _fs(spark, path + ".part")[1]
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, at):
        raise RuntimeError(f"{path} exists already")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINT).parquet(path)


def append_points(points: DataFrame, store: str) -> None:
    """Add points (series, seq, ts, quality, datapoints); a partition folder holds no empty text, so ``''`` is stored as null."""
    rows = points.select("seq", "ts", "quality", "datapoints", F.nullif(F.col("series"), F.lit("")).alias("series")).withColumn("day", F.to_date("ts"))
    rows.write.mode("append").partitionBy(*PARTS).parquet(f"{store}/points")


def points(spark: SparkSession, store: str) -> DataFrame:
    """What is in the store."""
    return _read(spark, f"{store}/points")


def committed(spark: SparkSession, store: str) -> list[int]:
    """Runs whose export counts."""
    return [int(n[:-5]) for n in _names(spark, f"{store}/manifest") if n.endswith(".json")]


def exports(spark: SparkSession, store: str) -> DataFrame:
    """All exported rows: run, series, batch_no, rn and the point. A run without its manifest does not count."""
    schema = f"batch_no bigint, rn bigint, {POINT}, run bigint"
    runs = committed(spark, store)
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{store}/exports").parquet(*[f"{store}/exports/run={n}" for n in runs])


def _replace(spark: SparkSession, store: str, run: int) -> None:
    """Put the staged partitions in place of the touched ones; can be repeated."""
    done = f"{store}/manifest/{run}.done"
    fs, at = _fs(spark, done)
    if fs.exists(at):
        return
    plan = json.loads("".join(r.value for r in spark.read.text(f"{store}/manifest/{run}.json").collect()))
    if plan["staged"]:
        staged = _read(spark, f"{store}/staging/run={run}")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(f"{store}/points")
    for folder in plan["emptied"]:  # partitions that nothing is left of
        fs.delete(_fs(spark, f"{store}/points/{folder}")[1], True)
    _publish(spark, done, "")


def recover(spark: SparkSession, store: str) -> None:
    """Finish runs that were committed but not purged."""
    for run in committed(spark, store):
        _replace(spark, store, run)


def export_and_purge(spark: SparkSession, store: str, batch: int = C.EXPORT_BATCH) -> int | None:
    """Export every series' full batches and purge them from the store; the run's number, None if no batch is full.

    Batches and row numbers count from 0 and 1 in every run. A null series is a series.
    """
    recover(spark, store)
    run = max(committed(spark, store), default=-1) + 1
    stored = points(spark, store)
    export_batches(stored, batch=batch).write.mode("overwrite").parquet(f"{store}/exports/run={run}")
    out = spark.read.schema(f"batch_no bigint, rn bigint, {POINT}").parquet(f"{store}/exports/run={run}")
    touched = out.select(*PARTS).distinct()
    if touched.isEmpty():
        return None
    left = series_purge(null_safe_join(stored, touched, PARTS, "left_semi"), out)
    left.write.mode("overwrite").partitionBy(*PARTS).parquet(f"{store}/staging/run={run}")
    # Folders of the partitions that empty, from the files' paths (which are URI-encoded): one per series and day.
    keep = _read(spark, f"{store}/staging/run={run}").select(*PARTS).distinct()
    gone = null_safe_join(touched, keep, PARTS, "left_anti")
    where = null_safe_join(stored.select(*PARTS, F.regexp_extract("_metadata.file_path", r"/points/(.*)/[^/]*$", 1).alias("folder")), gone, PARTS, "left_semi")
    emptied = [unquote(r["folder"]) for r in where.select("folder").distinct().collect()]
    _publish(spark, f"{store}/manifest/{run}.json", json.dumps({"run": run, "emptied": emptied, "staged": not keep.isEmpty()}))
    _replace(spark, store, run)
    return run
