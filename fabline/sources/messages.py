"""Message sources (S1): the raw message table and its streaming form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])


def topic_source(df: DataFrame, topic: str | list[str], topic_col: str = "topic") -> DataFrame:
    """Messages on one exact topic (or a list of topics). Works unchanged on
    a batch table and on a streaming DataFrame."""
    topics = [topic] if isinstance(topic, str) else list(topic)
    return df.where(F.col(topic_col).isin(*topics))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a raw message folder (parquet, partition pruning on topic)."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded read of a raw message folder (new files are new messages)."""
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def stream_kafka(spark: SparkSession, bootstrap: str, topics: list[str] | str,
                 starting: str = "latest") -> DataFrame:
    """Message stream from Kafka in the raw message shape (``topic, payload,
    ts, seq``). ``seq`` is unique over all subscribed topics: 7 bits of the
    topic's place in the list, 16 of the partition, 40 of the offset. Needs
    the Spark Kafka connector on the classpath."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    if len(names) > 127:
        raise ValueError("at most 127 topics in one stream")
    subs = ",".join(names)
    k = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", subs).option("startingOffsets", starting).load())
    return k.select("topic", F.col("value").alias("payload"), F.col("timestamp").alias("ts"),
                    kafka_seq(names).alias("seq"))


def kafka_seq(names: list[str]) -> Column:
    """``seq`` of a Kafka record from its topic, partition and offset."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col("topic")) - 1
    return F.shiftleft(place, 56) + F.shiftleft(F.col("partition").cast("bigint"), 40) + F.col("offset")


def to_kafka(commands: DataFrame, bootstrap: str, checkpoint: str):
    """Publish ``topic, payload`` command messages to Kafka (S11)."""
    out = commands.select("topic", F.col("payload").cast("binary").alias("value"))
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("checkpointLocation", checkpoint).start())
