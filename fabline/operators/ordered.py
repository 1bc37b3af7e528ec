"""Order-dependent building blocks that keep hot keys splittable.

A window ``partitionBy(key).orderBy(ts)`` sends every row of one key to one
task. When a key may hold a large share of all rows, the helpers here split
each key into ordered buckets of bounded row count (``row_bucket``), work
inside each bucket in parallel, and carry what earlier buckets contribute
through a small per-bucket table (one row per key and bucket). Results are
exact. A null key is a key like any other, and rows with a null time come
first in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


BUCKET_ROWS = 200_000
SPAN_SECONDS = 60


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols`` where null equals null; the left side's columns stay."""
    other = right.withColumnsRenamed({c: f"__j_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__j_{c}"))
    return left.join(other, cond, how).drop(*[f"__j_{c}" for c in cols])


def row_bucket(df: DataFrame, keys: Sequence[str], ts: str = "ts", name: str = "__day",
               rows: int = BUCKET_ROWS, seconds: int = SPAN_SECONDS) -> DataFrame:
    """Add a bucket number, monotone in ``ts`` within each key, of about ``rows`` rows a bucket.

    Rows are counted per key and ``seconds``-long span; the running count of
    the spans before, divided by ``rows``, is the bucket. A bucket holds at
    most ``rows`` rows and one span more, however the rows fall in time.
    """
    keys = list(keys)
    spanned = df.withColumn("__span", time_bucket(ts, seconds))
    per = spanned.groupBy(*keys, "__span").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(*keys, "__span", F.floor(F.coalesce(before, F.lit(0)) / rows).cast("bigint").alias(name))
    return null_safe_join(spanned, per, [*keys, "__span"]).drop("__span")


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
               values: dict[str, Column], inclusive: bool = True) -> DataFrame:
    """Add running sums ``name`` of each value per ``keys`` in ``order``.

    ``bucket`` must be monotone in ``order`` (see ``row_bucket``). With
    ``inclusive=False`` the current row is left out.
    """
    keys = list(keys)
    hi = 0 if inclusive else -1
    w_local = (Window.partitionBy(*keys, bucket).orderBy(*_cols(order))
               .rowsBetween(Window.unboundedPreceding, hi))
    tmp = {n: f"__v_{n}" for n in values}
    staged = df.withColumns({tmp[n]: v for n, v in values.items()})
    local = staged.withColumns({f"__l_{n}": F.sum(tmp[n]).over(w_local) for n in values})
    totals = staged.groupBy(*keys, bucket).agg(*[F.sum(tmp[n]).alias(f"__t_{n}") for n in values])
    w_b = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, bucket, *[
        F.coalesce(F.sum(f"__t_{n}").over(w_b), F.lit(0)).alias(f"__o_{n}") for n in values])
    out = null_safe_join(local, offsets, [*keys, bucket])
    return out.withColumns({
        n: F.coalesce(F.col(f"__l_{n}"), F.lit(0)) + F.col(f"__o_{n}") for n in values
    }).drop(*tmp.values(), *[f"__l_{n}" for n in values], *[f"__o_{n}" for n in values])


def asof_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
              values: Sequence[str], suffix: str = "_asof") -> DataFrame:
    """For each row, the last non-null value of each column in ``values``
    among rows up to and including it (per ``keys`` in ``order``).

    Adds ``<value><suffix>`` columns. ``bucket`` must be monotone in order.
    """
    keys = list(keys)
    ordc = F.struct(*_cols(order))
    w_local = (Window.partitionBy(*keys, bucket).orderBy(*_cols(order))
               .rowsBetween(Window.unboundedPreceding, 0))
    local = df.withColumns({f"__l_{v}": F.last(v, ignorenulls=True).over(w_local) for v in values})
    per_bucket = df.groupBy(*keys, bucket).agg(*[
        F.max_by(F.col(v), F.when(F.col(v).isNotNull(), ordc)).alias(f"__b_{v}") for v in values])
    w_b = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(*keys, bucket, *[
        F.last(f"__b_{v}", ignorenulls=True).over(w_b).alias(f"__c_{v}") for v in values])
    out = null_safe_join(local, carried, [*keys, bucket])
    return out.withColumns({
        f"{v}{suffix}": F.coalesce(F.col(f"__l_{v}"), F.col(f"__c_{v}")) for v in values
    }).drop(*[f"__l_{v}" for v in values], *[f"__c_{v}" for v in values])


def time_bucket(ts: str | Column = "ts", seconds: int = 86_400) -> Column:
    """Bucket number of ``ts``: whole ``seconds``-long spans since the epoch."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")


def day_bucket(ts: str | Column = "ts") -> Column:
    """Default bucket: whole days since the epoch of ``ts``."""
    return time_bucket(ts, 86_400)


def prev_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
             values: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<v>``: the value of the previous row of the same key in
    order (null for a key's first row); a bucket's first row takes the last
    row of the nearest earlier bucket."""
    keys = list(keys)
    ordc = F.struct(*_cols(order))
    w = Window.partitionBy(*keys, bucket).orderBy(*_cols(order))
    local = df.withColumns({"__rn": F.row_number().over(w),
                            **{f"__p_{v}": F.lag(v).over(w) for v in values}})
    last = df.groupBy(*keys, bucket).agg(F.max_by(F.struct(*values), ordc).alias("__last"))
    w_b = Window.partitionBy(*keys).orderBy(bucket)
    carried = last.select(*keys, bucket, F.lag("__last").over(w_b).alias("__carry"))
    out = null_safe_join(local, carried, [*keys, bucket])
    return out.withColumns({
        f"{prefix}{v}": F.when(F.col("__rn") == 1, F.col(f"__carry.{v}")).otherwise(F.col(f"__p_{v}"))
        for v in values
    }).drop("__rn", "__carry", *[f"__p_{v}" for v in values])
