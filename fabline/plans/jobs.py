"""The line's three end-to-end flows as composable batch jobs.

* ``vibration_anomaly_job``: readings + motor messages -> as-of motor state
  -> delta trigger per machine and window -> cool-down alarms -> motor
  control commands.
* ``training_data_job``: labelled colour records -> export batches and
  lines -> daily statistics -> readiness -> capped training set.
* ``material_decision_job``: material messages + allow-list + colour check
  vectors + training vectors -> kNN decisions -> lifecycle actions ->
  outgoing commands.

Each returns a dict of DataFrames; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators import aggs as A
from fabline.operators import anomaly as AN
from fabline.operators import joins as J
from fabline.operators import knn as KN
from fabline.operators import lifecycle as LC
from fabline.operators import triggers as TR
from fabline.sources import files as FS
from fabline.sources import sinks as SK


def vibration_anomaly_job(readings: DataFrame, motor: DataFrame, window: str = "3 seconds",
                          threshold: float = C.DELTA_THRESHOLD, level_limit: float = C.VIBRATION_LIMIT,
                          change_limit: float | None = None, cooldown_s: float = C.COOLDOWN_S) -> dict:
    """``readings``: ``seq, ts, machine_id, x, y, z``; ``motor``: ``seq, ts,
    machine_id, payload`` (``isRollingStarted|0/1``)."""
    r = J.asof_motor(readings, motor)
    fired = TR.delta_trigger(r, key="machine_id", window=window, threshold=threshold,
                             level_limit=level_limit).withColumnRenamed("machine_id", "key")
    alarms = AN.anomaly_cooldown(fired, level_limit=level_limit, change_limit=change_limit, cooldown_s=cooldown_s)
    return {"readings": r, "fired": fired, "alarms": alarms, "commands": AN.alarm_commands(alarms)}


def training_data_job(records: DataFrame, min_sets: int = C.MIN_SETS_FOR_ML,
                      batch: int = C.EXPORT_BATCH) -> dict:
    """``records``: ``series, seq, ts, quality, datapoints``."""
    batches = SK.export_batches(records, batch=batch)
    lines = batches.select("series", "batch_no", "seq", "ts", FS.delimited_line(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "quality", "datapoints").alias("line"))
    parsed = lines.withColumn("day", F.substring_index("line", "T", 1)).withColumn(
        "quality", F.try_element_at(F.split("line", ";"), F.lit(2)))
    daily = A.daily_quality(parsed)
    ready = A.train_ready(daily, min_sets)
    one_file = Window.partitionBy("series", "batch_no")  # a batch of ``batch`` rows
    recs = batches.withColumn("file_ts", F.max("ts").over(one_file)).withColumnRenamed("quality", "label")
    train = A.train_cap(recs, file_cols=("series", "batch_no"), file_order=("file_ts",), min_sets=min_sets)
    return {"batches": batches, "lines": lines, "daily": daily, "ready": ready, "training_set": train,
            "left_in_store": SK.series_purge(records, batches)}


def material_decision_job(msgs: DataFrame, allow: DataFrame, checks: DataFrame, train: DataFrame,
                          dim: int, k: int = C.KNN_K, ready: DataFrame | None = None) -> dict:
    """``msgs``: ``seq, ts, id, topic, payload``; ``checks``: ``seq,
    features`` of the colour-check messages; ``train``: ``vec_id, features,
    label``; ``dim``: length of the line's vectors. With ``ready`` (one row
    of ``train_ready``) classification waits for the flag: until it is set
    the training set counts as empty and every decision is ``unknown``."""
    q = checks.select(F.col("seq").alias("vec_id"), "features")
    if ready is not None:
        train = train.join(ready.where(F.col("ready")).limit(1).select(F.lit(1).alias("__go")), F.lit(1) == F.col("__go"), "left_semi")
    dec = KN.knn_decide(KN.knn_distribution(KN.knn_neighbours(q, train, dim, k=k), q, k=k))
    preds = dec.select(F.col("q_id").alias("seq"), F.col("decision").alias("prediction"))
    actions = LC.material_lifecycle(msgs, allow, preds)
    commands = actions.where(F.col("out_topic").isNotNull()).select(
        F.col("out_topic").alias("topic"), F.col("out_payload").alias("payload"), "seq")
    return {"decisions": dec, "actions": actions, "gates": LC.stage_gate(actions), "commands": commands}
