"""Downsampling with gap filling (A10): means per time bucket, empty buckets as rows of their own.

No grid over the whole time range is built: every bucket that holds readings looks back at the one before it and fills the
buckets between. Buckets are unique per key, so a run of ``RUN`` bucket numbers bounds what one task orders, whatever the key.
A gap of more than ``max_gap`` buckets, such as one wrong clock makes, is one row that says how many buckets it stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabline.operators.ordered import prev_row

RUN = 100_000
MAX_GAP = 10_000


def bucket_start(ts: str | Column, bucket_s: int) -> Column:
    """Start of the bucket of ``ts`` in microseconds."""
    us = bucket_s * 1_000_000
    c = F.col(ts) if isinstance(ts, str) else ts
    return (F.floor(F.unix_micros(c) / us) * us).cast("bigint")


def bucket_means(df: DataFrame, keys: Sequence[str], ts: str, fields: Sequence[str], bucket_s: int) -> DataFrame:
    """``keys, bucket_us, avg_<field>`` of the buckets that hold rows; rows without a time lie in none."""
    timed = df.where(F.col(ts).isNotNull())
    return (timed.groupBy(*keys, bucket_start(ts, bucket_s).alias("bucket_us"))
            .agg(*[F.round(F.avg(f), 9).alias(f"avg_{f}") for f in fields]))


def fill_gaps(means: DataFrame, keys: Sequence[str], bucket_s: int, max_gap: int = MAX_GAP) -> DataFrame:
    """``means`` (``keys, bucket_us``, values) with the empty buckets of every key between its first and its last one:
    ``bucket_us, n_buckets`` (1, or the length of a gap over ``max_gap``), values null."""
    us = bucket_s * 1_000_000
    values = [c for c in means.columns if c not in (*keys, "bucket_us")]
    cut = means.withColumn("__run", F.floor(F.col("bucket_us") / (us * RUN)).cast("bigint"))
    seen = prev_row(cut, keys, ["bucket_us"], "__run", ["bucket_us"], prefix="__prev_").drop("__run")
    first = F.col("__prev_bucket_us") + us
    gap = ((F.col("bucket_us") - first) / us).cast("bigint")

    def row(at: Column, n: Column, filled: bool) -> Column:
        nulls = [F.lit(None).cast(means.schema[v].dataType).alias(v) for v in values]
        return F.struct(at.cast("bigint").alias("bucket_us"), n.cast("bigint").alias("n_buckets"), *([F.col(v) for v in values] if filled else nulls))

    own = F.array(row(F.col("bucket_us"), F.lit(1), True))
    empty = (F.when(gap > max_gap, F.array(row(first, gap, False)))
             .when(gap > 0, F.transform(F.sequence(first, F.col("bucket_us") - us, F.lit(us)), lambda at: row(at, F.lit(1), False)))
             .otherwise(F.array()))
    return seen.select(*keys, F.explode(F.concat(own, empty)).alias("r")).select(*keys, "r.*")


def downsample_fill(df: DataFrame, ts: str = "ts", fields: Sequence[str] = ("x", "y", "z"), bucket_s: int = 600,
                    keys: Sequence[str] = (), max_gap: int = MAX_GAP) -> DataFrame:
    """Mean per fixed time bucket (and key): ``keys, bucket_start, n_buckets, avg_<field>``, empty buckets with null means."""
    out = fill_gaps(bucket_means(df, keys, ts, fields, bucket_s), keys, bucket_s, max_gap)
    return out.select(*keys, F.timestamp_micros("bucket_us").alias("bucket_start"), "n_buckets", *[f"avg_{f}" for f in fields])
