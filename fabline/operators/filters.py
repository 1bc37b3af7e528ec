"""Row filters and predicates (topic routing, quarantine, gates, ranges)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabline.functions import codes as C


def topic_route(df: DataFrame, routes: dict[str, str], topic: str = "topic",
                stage: str = "stage") -> DataFrame:
    """Keep messages on the routed topics and tag each with its stage.

    One pass: an ``isin`` filter (pushed to the scan when ``topic`` is a
    stored column) and a ``when`` chain naming the handler.
    """
    expr = None
    for t, s in routes.items():
        expr = F.when(F.col(topic) == t, s) if expr is None else expr.when(F.col(topic) == t, s)
    return df.where(F.col(topic).isin(*routes)).withColumn(stage, expr)


def split_rejects(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Split a decoded table into (good rows, quarantine rows)."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def quarantine(df: DataFrame, reason: str = "reject_reason",
               keep: Iterable[str] = ("seq",)) -> DataFrame:
    """Quarantine table of a decoded frame: ``keep`` columns plus the reason."""
    return df.where(F.col(reason).isNotNull()).select(*keep, reason)


def stall_filter(level: Column, rolling: Column, limit: float = C.VIBRATION_LIMIT) -> Column:
    """Motor rolling and vibration level strictly below ``limit``."""
    return F.coalesce(rolling, F.lit(False)) & (level < F.lit(limit))


def label_check(label: Column) -> Column:
    """Only the three known classes count."""
    return label.isin(*C.CLASSES)


def recent_range(df: DataFrame, ts: str = "ts", minutes: int = C.RECENT_RANGE_MIN,
                 end: Column | None = None) -> DataFrame:
    """Rows with ``ts`` in the last ``minutes`` before ``end`` (default: the
    newest ``ts`` of the table), oldest first."""
    if end is None:
        # Scalar subquery: the newest ts is planned as one small aggregate.
        end = df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) >= end - F.expr(f"INTERVAL {minutes} MINUTES"))


def recent_from_store(spark, path: str, schema: str, ts: str = "ts", minutes: int = C.RECENT_RANGE_MIN, part: str = "day") -> DataFrame:
    """``recent_range`` over a store partitioned by ``part`` (the date of ``ts``; other partition levels may lie above it).

    The newest day is found in the folder names; only its files are asked for the newest ``ts``, and only the partitions
    that the range reaches into are read. Rows without a time (no day) are in no range; an empty store gives no rows.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    level = at
    days: list[str] = []
    for _ in range(4):  # levels of partitions above
        level = spark._jvm.org.apache.hadoop.fs.Path(level, "*")
        names = [s.getPath().getName() for s in fs.globStatus(level) or []]
        days = [n[len(part) + 1:] for n in names if n.startswith(f"{part}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
        if days:
            break
    stored = spark.read.schema(schema).parquet(path)
    if not days:
        return stored.limit(0)
    newest = F.lit(max(days)).cast("date")
    end = stored.where(F.col(part) == newest).select(F.max(ts)).first()[0]
    if end is None:
        return stored.limit(0)
    start = F.lit(end).cast(stored.schema[ts].dataType) - F.expr(f"INTERVAL {minutes} MINUTES")
    return stored.where((F.col(part) >= F.to_date(start)) & (F.col(ts) >= start))
