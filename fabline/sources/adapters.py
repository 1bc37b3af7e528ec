"""Domain tables derived from the driver tables.

The line's inputs (vibration readings, motor and material messages, frames,
quality records, labelled vectors) are built here from ``events``,
``lineitem`` and ``embeddings`` with plain column expressions, so every
downstream query scales with those tables. Each adapter has a DuckDB twin in
``fabline.plans.oracle`` that must stay equal to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.sources.tables import table


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id", "event_type", "value", _k().alias("k"),
    ).select("seq", "ts", *cols) if cols else ev


def _hex_bytes(prefixes: str, seq: Column) -> Column:
    """Concatenated md5 hex of ``p || seq`` for each prefix letter."""
    sid = seq.cast("string")
    return F.concat(*[F.md5(F.concat(F.lit(p), sid)) for p in prefixes])


def vibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded readings: ``seq, ts, key, machine_id, x, y, z``."""
    ev = _events(spark, sf_dir, "user_id", "event_type", "value", "k")
    return ev.select(
        "seq", "ts",
        F.col("event_type").alias("key"),
        (F.col("user_id") % 8).alias("machine_id"),
        ((F.round(F.col("value") * 100).cast("bigint") % 2000) / 1000.0).alias("x"),
        ((F.col("k") % 40) / 20.0).alias("y"),
        ((F.col("user_id") % 40) / 20.0).alias("z"),
    )


def vibration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated raw messages ``x;y;z`` on the vibration topic."""
    v = vibration(spark, sf_dir)
    return v.select(
        F.lit(C.VIBRATION).alias("topic"),
        F.concat_ws(";", "x", "y", "z").cast("binary").alias("payload"),
        "ts", "seq", "machine_id")


MOTOR_TYPES = {"signup": "1", "error": "0"}
READING_TYPES = ["view", "click", "purchase"]


def motor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``isRollingStarted|0/1`` messages of each machine: ``seq, ts, machine_id, topic, payload``."""
    ev = _events(spark, sf_dir, "user_id", "event_type")
    return ev.where(F.col("event_type").isin(*MOTOR_TYPES)).select(
        "seq", "ts", (F.col("user_id") % 8).alias("machine_id"),
        F.lit(C.ROLLING_MOTOR_INFO).alias("topic"),
        F.concat(F.lit("isRollingStarted|"),
                 F.when(F.col("event_type") == "signup", "1").otherwise("0")).alias("payload"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vibration readings that are not motor messages."""
    return vibration(spark, sf_dir).where(F.col("key").isin(*READING_TYPES))


def vib_frames(spark: SparkSession, sf_dir: str, short_every: int = 50) -> DataFrame:
    """Binary 52-byte vibration frames ``seq, ts, machine_id, topic, payload``.

    Rows with ``seq % short_every = 7`` carry a cut 48-byte frame, so the
    decoder's quarantine path sees real input.
    """
    ev = _events(spark, sf_dir, "user_id")
    n_hex = F.when(F.col("seq") % short_every == 7, F.lit(96)).otherwise(F.lit(104))
    return ev.select(
        "seq", "ts", (F.col("user_id") % 8).alias("machine_id"),
        F.lit(C.VIBRATION).alias("topic"),
        F.unhex(F.substring(_hex_bytes("abcd", F.col("seq")), F.lit(1), n_hex)).alias("payload"))


def colour_frames(spark: SparkSession, sf_dir: str, n_bytes: int = 400) -> DataFrame:
    """Colour check frames: 8-byte id text, then ``n_bytes - 8`` md5 bytes."""
    ev = _events(spark, sf_dir, "user_id")
    n_md5 = (n_bytes - 8 + 15) // 16
    letters = "abcdefghijklmnopqrstuvwxy"[:n_md5]
    body = F.unhex(F.substring(_hex_bytes(letters, F.col("seq")), 1, 2 * (n_bytes - 8)))
    return ev.select(
        "seq", "ts", F.lit(C.COLOUR_MAT_CHECK).alias("topic"),
        F.concat(F.format_string("%08x", "user_id").cast("binary"), body).alias("payload"))


STATION_OF_TYPE = {"signup": "loading", "view": "rolling", "click": "rolling",
                   "purchase": "quality", "error": "unloading"}


def station_of(event_type: Column) -> Column:
    expr = None
    for t, s in STATION_OF_TYPE.items():
        expr = (F.when(event_type == t, s) if expr is None else expr.when(event_type == t, s))
    return expr


def sensor_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light-barrier bit strings per station: ``seq, ts, station, id, bits``."""
    ev = _events(spark, sf_dir, "user_id", "event_type")
    return ev.select(
        "seq", "ts", station_of(F.col("event_type")).alias("station"),
        F.format_string("%08x", "user_id").alias("id"),
        F.lpad(F.bin(F.col("user_id") % 64), 6, "0").alias("bits"))


def raw_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw colour-sensor pulse widths: ``seq, red, green, blue``."""
    ev = _events(spark, sf_dir, "user_id", "value", "k")
    return ev.select(
        "seq",
        (F.round(F.col("value") * 100).cast("bigint") % 1600).alias("red"),
        ((F.col("k") * 17) % 1500).cast("bigint").alias("green"),
        ((F.col("user_id") * 11) % 1400).alias("blue"))


def loop_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loop-time telemetry: ``seq, ts, station, topic, ms``."""
    ev = _events(spark, sf_dir, "event_type", "k")
    st = station_of(F.col("event_type"))
    return ev.select("seq", "ts", st.alias("station"),
                     F.concat(F.lit("/"), st, F.lit("/loopTime")).alias("topic"),
                     F.col("k").alias("ms"))


MOTOR_KEYS = ["isStarted", "direction", "speed",
              "isRollingStarted", "rollingDirection", "rollingSpeed"]


def motor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station motor reports ``key|value``: ``seq, ts, station, topic, payload``."""
    ev = _events(spark, sf_dir, "event_type", "k")
    st = station_of(F.col("event_type"))
    key_idx = F.col("k") % 6
    key = F.element_at(F.array(*[F.lit(k) for k in MOTOR_KEYS]), (key_idx + 1).cast("int"))
    val = (F.when(key_idx % 3 == 0, (F.col("k") % 2).cast("string"))
            .when(key_idx % 3 == 1, F.when(F.col("k") % 2 == 1, "l").otherwise("r"))
            .otherwise((F.col("k") + 100).cast("string")))
    return ev.select("seq", "ts", st.alias("station"),
                     F.concat(F.lit("/"), st, F.lit("/motorInfo")).alias("topic"),
                     F.concat(key, F.lit("|"), val).alias("payload"))


def material_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Controller input messages about materials: ``seq, ts, id, topic, payload``.

    signup -> loaded; view -> position; click -> rolled (k even) or roll query;
    purchase -> ready / colour check / unload query for k % 3 = 0 / 1 / 2;
    error -> final (k even) or a station warning.
    """
    ev = _events(spark, sf_dir, "user_id", "event_type", "k")
    mid = F.format_string("%08x", "user_id")
    k, et = F.col("k"), F.col("event_type")
    station = F.element_at(F.array(*[F.lit(s) for s in C.STATIONS]), ((k % 4) + 1).cast("int"))
    topic = (F.when(et == "signup", C.LOADING_MAT_LOADED)
             .when(et == "view", F.concat(F.lit("/"), station, F.lit("/MatPosition")))
             .when(et == "click", F.when(k % 2 == 0, C.ROLLING_MAT_AFTER_ROLL)
                   .otherwise(C.ROLLING_ROLL_QUERY))
             .when(et == "purchase", F.when(k % 3 == 0, C.QUALITY_MAT_READY_TO_QCHECK)
                   .when(k % 3 == 1, C.COLOUR_MAT_CHECK).otherwise(C.UNLOADING_MAT_QUERY))
             .otherwise(F.when(k % 2 == 0, C.UNLOADING_MAT_FINAL)
                        .otherwise(F.concat(F.lit("/"), station, F.lit("/warning")))))
    payload = (F.when(et == "view", F.concat(mid, F.lit("|"), (k * 630).cast("string")))
               .when((et == "error") & (k % 2 == 1), F.concat(F.lit("warning "), k.cast("string")))
               .otherwise(mid))
    return ev.select("seq", "ts", mid.alias("id"), topic.alias("topic"), payload.alias("payload"))


def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed material ids with roll thickness: the line's fixed ids plus
    every user id not divisible by 3 (one row per id)."""
    ev = table(spark, sf_dir, "events").select("user_id").where(F.col("user_id") % 3 != 0).distinct()
    derived = ev.select(F.format_string("%08x", "user_id").alias("id"), F.lit("50").alias("thickness"))
    fixed = spark.createDataFrame(C.ALLOW_LIST, "id string, thickness string")
    return derived.unionByName(fixed)


def _quality_of(flag: Column, status: Column) -> Column:
    return (F.when(flag == "A", C.GOOD).when(flag == "N", C.DEFECT1)
            .when((flag == "R") & (status == "F"), C.DEFECT2).otherwise(C.NO_LABEL))


def quality_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled colour records from lineitem:
    ``seq, ts, day, time_text, quality, datapoints``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time_text"),
        _quality_of(F.col("l_returnflag"), F.col("l_linestatus")).alias("quality"),
        F.concat_ws(",", F.col("l_quantity").cast("int"), F.col("l_partkey") % 256,
                    F.col("l_suppkey") % 256, F.col("l_linenumber")).alias("datapoints"),
    )


def series_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of several colour series: ``series, seq, ts, quality, datapoints``."""
    ev = _events(spark, sf_dir, "user_id", "event_type", "value", "k")
    q = F.element_at(F.array(*[F.lit(c) for c in C.CLASSES]), ((F.col("k") % 3) + 1).cast("int"))
    return ev.select(
        F.col("event_type").alias("series"), "seq", "ts", q.alias("quality"),
        F.concat_ws(",", F.col("k"), F.col("user_id") % 256,
                    F.round(F.col("value")).cast("bigint")).alias("datapoints"))


VECTOR_DIM = 64  # length of the vectors in ``embeddings``


def labelled_vectors(spark: SparkSession, sf_dir: str, holdout_mod: int = 5) -> DataFrame:
    """Embeddings as labelled colour vectors: ``vec_id, features, label, is_train``."""
    em = table(spark, sf_dir, "embeddings")
    lab = F.element_at(F.array(*[F.lit(c) for c in C.CLASSES]), ((F.col("label") % 3) + 1).cast("int"))
    return em.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"),
        lab.alias("label"), (F.col("vec_id") % holdout_mod != 0).alias("is_train"))
