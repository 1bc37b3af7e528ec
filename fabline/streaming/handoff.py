"""Readiness hand-off of a running stream (W10 with A2, J7 and A6).

One stream carries labelled records and checks. Until every class has ``min_sets`` records, checks are answered with
``unknown``; the record that completes the last class is the switch row. The records up to it are stored as the training
set, its version is the switch row's number, and every later decision carries that version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators import knn as KN
from fabline.operators.aggs import ready_at

RECORDS = "seq bigint, features array<double>, label string"
STATUS = ", ".join(f"{c} bigint" for c in C.CLASSES) + ", version bigint"
DECISIONS = "seq bigint, " + ", ".join(f"{c} bigint" for c in C.CLASSES) + ", decision string, version bigint"


def training_set(spark: SparkSession, out: str, version: int) -> DataFrame:
    """The stored training set of a version: ``vec_id, features, label``."""
    return spark.read.schema(RECORDS).parquet(f"{out}/sets/version={version}").withColumnRenamed("seq", "vec_id")


def decisions(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(DECISIONS).parquet(f"{out}/decisions").drop("micro")


def _classify(checks: DataFrame, train: DataFrame, dim: int, k: int, version: int) -> DataFrame:
    q = checks.select(F.col("seq").alias("vec_id"), "features")
    dec = KN.knn_decide(KN.knn_distribution(KN.knn_neighbours(q, train, dim, k=k), q, k=k))
    return dec.select(F.col("q_id").alias("seq"), *C.CLASSES, "decision", F.lit(version).cast("bigint").alias("version"))


def _waiting(checks: DataFrame) -> DataFrame:
    return checks.select("seq", *[F.lit(None).cast("bigint").alias(c) for c in C.CLASSES],
                         F.lit(C.UNKNOWN_LABEL).alias("decision"), F.lit(None).cast("bigint").alias("version"))


def classify_live(messages: DataFrame, out: str, checkpoint: str, dim: int, min_sets: int = C.MIN_SETS_FOR_ML, k: int = C.KNN_K,
                  available_now: bool = True):
    """Decisions of a stream ``seq, features, label, is_check`` below ``out`` (see ``decisions`` and ``training_set``).

    Messages are taken micro-batch by micro-batch, inside one by ``seq``, a unique number: a check before the switch row is
    ``unknown`` without a version, one after it is classified, also in the same micro-batch. Records of no known
    class or without a number neither count nor train; checks without a number stay ``unknown``. A micro-batch reads the status row of the one before and writes its own folders
    over, the status last, so one that is stopped at any step and runs again changes nothing. After the hand-off, records
    are no longer gathered: what the classifier knows is the set it was given.
    """
    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        counts, version = dict.fromkeys(C.CLASSES, 0), None
        if number:
            row = session.read.schema(STATUS).parquet(f"{out}/status/micro={number - 1}").first()
            counts, version = {c: row[c] for c in C.CLASSES}, row["version"]
        batch.persist()
        try:
            is_check = F.coalesce("is_check", F.lit(False))
            checks, answered = batch.where(is_check).select("seq", "features"), F.col("seq").isNotNull()
            if version is None:
                records = batch.where(~is_check & F.col("label").isin(*C.CLASSES) & F.col("seq").isNotNull()).select("seq", "features", "label")
                records.write.mode("overwrite").parquet(f"{out}/records/micro={number}")
                now = ready_at(records, min_sets, counts).first()
                counts, version = {c: now[c] for c in C.CLASSES}, now["switch"]
                answered = F.coalesce(F.col("seq") > F.lit(version), F.lit(False))
                if version is not None:
                    stored = session.read.schema(f"{RECORDS}, micro bigint").parquet(f"{out}/records")
                    kept = stored.where((F.col("micro") < number) | ((F.col("micro") == number) & (F.col("seq") <= version)))
                    kept.drop("micro").write.mode("overwrite").parquet(f"{out}/sets/version={version}")
            answer = _waiting(checks.where(~answered))
            if version is not None:
                answer = answer.unionByName(_classify(checks.where(answered), training_set(session, out, version), dim, k, version))
            answer.write.mode("overwrite").parquet(f"{out}/decisions/micro={number}")
            status = [tuple(counts[c] for c in C.CLASSES) + (version,)]
            session.createDataFrame(status, STATUS).coalesce(1).write.mode("overwrite").parquet(f"{out}/status/micro={number}")
        finally:
            batch.unpersist()

    w = messages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
