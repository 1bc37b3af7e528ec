"""Live downsampling with gap filling (A10).

A windowed mean (partial aggregates, so a hot key is spread) closes a bucket when the watermark passes its end; a typed
state of one number a key knows the next bucket that is due, and an event-time timer at that bucket's end emits it as
empty when nothing closed, also while the key is silent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from fabline.operators.gaps import MAX_GAP
from fabline.streaming.stateful import use_rocksdb


class GapFold(StatefulProcessor):
    """Closed buckets of one key in, closed and empty ones out; a jump over more than ``max_gap`` buckets is one row."""

    def __init__(self, key: str, us: int, values: list[str], max_gap: int, idle_us: int | None):
        self.us, self.values, self.max_gap, self.idle_us = us, values, max_gap, idle_us
        self.out = Row(key, "bucket_us", "n_buckets", *values)

    def init(self, handle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "next_us long, timer long, seen_us long")

    def close(self) -> None:
        pass

    def _empty(self, key, start: int, n: int) -> Iterator[Row]:
        nulls = [None] * len(self.values)
        if n > self.max_gap:
            yield self.out(*key, start, n, *nulls)
        else:
            for i in range(n):
                yield self.out(*key, start + i * self.us, 1, *nulls)

    def _wait(self, next_us: int, timer: int | None, seen_us: int) -> None:
        """Set the timer at the end of the bucket that is due; an older one is left to run out."""
        at = (next_us + self.us) // 1000
        if at != timer:
            self.handle.registerTimer(at)
        self.due.update((next_us, at, seen_us))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.due.get()
        next_us, timer = (None, None) if held is None else held[:2]
        seen = 0
        for r in sorted(rows, key=lambda r: r["bucket_us"]):
            seen = r["bucket_us"]
            if next_us is not None:
                yield from self._empty(key, next_us, (seen - next_us) // self.us)
            yield self.out(*key, seen, 1, *[r[v] for v in self.values])
            next_us = seen + self.us
        self._wait(next_us, timer, seen)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.due.get()
        if held is None or expiredTimerInfo.getExpiryTimeInMs() != held[1]:
            return
        next_us, timer, seen_us = held
        now = timerValues.getCurrentWatermarkInMs() * 1000
        n = max(0, (now - next_us) // self.us)
        if self.idle_us is not None:
            n = min(n, max(0, (seen_us + self.us + self.idle_us - next_us) // self.us))
        yield from self._empty(key, next_us, n)
        if self.idle_us is not None and now - seen_us - self.us >= self.idle_us:
            self.due.clear()
        else:
            self._wait(next_us + n * self.us, None, seen_us)


def downsample_live(rows: DataFrame, delay: str, key: str, ts: str = "ts", fields: Sequence[str] = ("x", "y", "z"),
                    bucket_s: int = 600, max_gap: int = MAX_GAP, idle_s: int | None = None) -> DataFrame:
    """``key, bucket_start, n_buckets, avg_<field>`` of a stream: means as buckets close, empty buckets as the watermark
    passes them. Same rows as ``downsample_fill`` per key, and the empty ones after a key's last reading up to the watermark;
    ``idle_s`` ends those after so long a silence (what comes later starts anew). A gap over ``max_gap`` that the watermark
    passes step by step leaves in as many pieces. Rows later than ``delay`` and rows without a time take no part.
    """
    use_rocksdb(rows.sparkSession)
    us = bucket_s * 1_000_000
    values = [f"avg_{f}" for f in fields]
    closed = (rows.where(F.col(ts).isNotNull()).withWatermark(ts, delay).groupBy(key, F.window(ts, f"{bucket_s} seconds").alias("w"))
              .agg(*[F.round(F.avg(f), 9).alias(v) for f, v in zip(fields, values)])
              .select(key, F.window_time("w").alias("closed"), F.unix_micros("w.start").alias("bucket_us"), *values))
    schema = ", ".join([f"`{key}` {closed.schema[key].dataType.simpleString()}, bucket_us long, n_buckets long", *[f"`{v}` double" for v in values]])
    fold = GapFold(key, us, values, max_gap, None if idle_s is None else idle_s * 1_000_000)
    out = closed.groupBy(key).transformWithState(fold, schema, "Append", "EventTime")
    return out.select(key, F.timestamp_micros("bucket_us").alias("bucket_start"), "n_buckets", *values)
