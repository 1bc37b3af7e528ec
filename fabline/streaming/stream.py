"""Structured Streaming forms: message stream in, as-of motor state,
series upsert and command output. The operators on typed state
(trigger, alarms, lifecycle, exports, late rows) are in ``stateful``.

Batch and stream share the step functions: a stream applies each key's rows
in event-time order once the watermark has reached them.
Sinks use checkpoint locations below the shared ``spark.checkpoint.dir`` so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.operators.fold import FoldSpec
from fabline.operators.triggers import tumbling
from fabline.session import scratch_path
from fabline.sources.sinks import upsert_into
from fabline.streaming.stateful import asof_live


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Unbounded parquet folder source (each new file is new input)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


# --- W1 / W2 / W3 -----------------------------------------------------------
def stream_tumbling(stream: DataFrame, delay: str = "0 seconds", **kw) -> DataFrame:
    return tumbling(stream.withWatermark(kw.get("ts", "ts"), delay), **kw)


def late_rows(batch: DataFrame, watermark_ms: int, ts: str = "ts") -> DataFrame:
    """Rows of a micro-batch that are behind the watermark (for a side table, from ``foreachBatch``)."""
    return batch.where(F.col(ts) <= F.timestamp_millis(F.lit(watermark_ms)))


# --- W7 ---------------------------------------------------------------------
def _asof_step(state, r):
    if r.is_motor:
        return bool(r.state), None
    return state, [(r.seq, r.ts_us, r.x, r.y, r.z, state)]


ASOF_SPEC = FoldSpec(lambda: False, _asof_step, ["seq", "ts_us", "x", "y", "z", "is_motor", "state"],
                     "seq long, ts_us long, x double, y double, z double, rolling boolean")


def stream_asof_motor(readings: DataFrame, motor: DataFrame, delay: str, idle: str | None = None) -> DataFrame:
    """Latest ``isRollingStarted`` state per machine attached to each reading (W7), in event-time order over both inputs."""
    r = readings.select("machine_id", "seq", "ts", "x", "y", "z",
                        F.lit(False).alias("is_motor"), F.lit(None).cast("boolean").alias("state"))
    m = motor.where(F.col("payload").startswith("isRollingStarted")).select(
        "machine_id", "seq", "ts", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"),
        F.lit(None).cast("double").alias("z"), F.lit(True).alias("is_motor"),
        (F.try_element_at(F.split("payload", r"\|"), F.lit(2)) == "1").alias("state"))
    out = asof_live(r.unionByName(m).withColumn("ts_us", F.unix_micros("ts")), "machine_id", ASOF_SPEC, delay, idle=idle)
    return out.select("machine_id", "seq", F.timestamp_micros("ts_us").alias("ts"), "x", "y", "z", "rolling")


# --- sinks ------------------------------------------------------------------
def run_to_parquet(df: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                   mode: str = "append", partition_by: list[str] | None = None):
    """Start a file-sink query (exactly-once through its checkpoint)."""
    w = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint) \
        .outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def upsert_stream(stream: DataFrame, store: str, checkpoint: str, available_now: bool = True, **kw):
    """Series store sink (S2): each micro-batch is merged into the store's
    touched (measurement, day) partitions; last write per point wins."""
    def batch_fn(batch: DataFrame, _epoch: int):
        upsert_into(batch.sparkSession, batch, store, **kw)

    w = stream.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def command_stream(commands: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Outgoing command messages (S11) as a ``topic, payload, ts, seq`` sink."""
    return run_to_parquet(commands.select("topic", "payload", "ts", "seq"), out, checkpoint, available_now)


def scratch_query_paths(spark: SparkSession, name: str) -> tuple[str, str, str]:
    """(input, output, checkpoint) folders for a query under the shared folder."""
    import uuid
    base = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex}")
    return f"{base}/in", f"{base}/out", f"{base}/ckpt"
