"""Lookups and correlations of the line: allow-list routing, thickness
lookup, as-of motor state, unknown-material detection, position lookup.

Dimension sides that are fixed and tiny (the position table) are broadcast
explicitly. Sides derived from the data (the allow-list) are left to
adaptive execution, which broadcasts them only when their measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and keeps a shuffle join
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.functions.decode import last_one_index
from fabline.operators.ordered import asof_last, row_bucket


def position_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.POSITIONS, "station string, idx int, label int, coordinate int")


# --- J1 ---------------------------------------------------------------------
def allow_route(loads: DataFrame, allow: DataFrame, id_col: str = "id") -> DataFrame:
    """Each load gets ``F`` (id in the allow-list) or ``D`` and the command
    message ``id|F`` / ``id|D``."""
    a = allow.select(F.col("id").alias(id_col), F.lit(True).alias("__allowed"))
    out = loads.join(a, id_col, "left")
    dec = F.when(F.col("__allowed"), F.lit("F")).otherwise(F.lit("D"))
    return out.withColumns({"decision": dec,
                            "command": F.concat(F.col(id_col), F.lit("|"), dec)}).drop("__allowed")


# --- J2 ---------------------------------------------------------------------
def thickness_lookup(queries: DataFrame, known: DataFrame, allow: DataFrame,
                     id_col: str = "id") -> DataFrame:
    """Roll queries of known materials (forwarded before the query) get the
    reply ``id|thickness``."""
    k = known.select(F.col(id_col), F.col("first_forward_seq"), F.col("first_forward_ts"))
    q = queries.join(k, id_col, "inner").where(
        F.struct("ts", "seq") > F.struct("first_forward_ts", "first_forward_seq"))
    out = q.join(allow.select(F.col("id").alias(id_col), "thickness"), id_col, "inner")
    return out.withColumn("command", F.concat(F.col(id_col), F.lit("|"), F.col("thickness"))) \
        .drop("first_forward_seq", "first_forward_ts")


def first_forward(loads_routed: DataFrame, id_col: str = "id") -> DataFrame:
    """First forwarded load per material: ``id, first_forward_ts, first_forward_seq``."""
    f = loads_routed.where(F.col("decision") == "F")
    m = f.groupBy(id_col).agg(F.min(F.struct("ts", "seq")).alias("m"))
    return m.select(id_col, F.col("m.ts").alias("first_forward_ts"),
                    F.col("m.seq").alias("first_forward_seq"))


# --- J3 ---------------------------------------------------------------------
def asof_motor(readings: DataFrame, motor: DataFrame, key: str = "machine_id",
               state_col: str = "rolling") -> DataFrame:
    """Each reading gets the state of the last ``isRollingStarted`` message
    of its machine before it (``false`` before the first).

    Runs per machine and row bucket in parallel; the state entering a bucket
    comes from a carry table, so a busy machine is not one task. Readings
    with a null machine or time are kept.
    """
    state = (F.try_element_at(F.split(F.col("payload"), r"\|"), F.lit(2)) == "1")
    m = motor.where(F.col("payload").startswith("isRollingStarted")).select(
        key, "ts", "seq", state.alias("__state"), F.lit(False).alias("__is_reading"))
    r = readings.withColumns({"__state": F.lit(None).cast("boolean"),
                              "__is_reading": F.lit(True)})
    u = row_bucket(r.unionByName(m, allowMissingColumns=True), [key])
    u = u.withColumn("__later", ~F.col("__is_reading"))  # a message of the same place does not come before
    a = asof_last(u, [key], ["ts", "seq", "__later"], "__day", ["__state"])
    return (a.where("__is_reading")
            .withColumn(state_col, F.coalesce(F.col("__state_asof"), F.lit(False)))
            .drop("__state", "__state_asof", "__is_reading", "__later", "__day"))


# --- J4 ---------------------------------------------------------------------
def header_fields() -> dict[str, tuple[str, str, str]]:
    """Header field -> (station, report key, type): the four stations' motors and the rolling station's second one."""
    out = {}
    for s in C.STATIONS:
        out |= {f"{s}_started": (s, "isStarted", "int"), f"{s}_direction": (s, "direction", "string"), f"{s}_speed": (s, "speed", "int")}
    return out | {"roll_started": ("rolling", "isRollingStarted", "int"), "roll_direction": ("rolling", "rollingDirection", "string"),
                  "roll_speed": ("rolling", "rollingSpeed", "int")}


def asof_frame(frames: DataFrame, motor_info: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Each frame gets every field of its header: per motor the last reported
    state, direction and speed before it, and (with ``positions``: ``seq, ts,
    payload``) the last loading position as five digits.

    Reports are line-wide (no key), so the work is split by time only:
    buckets of bounded row count run in parallel with a carry table between
    them."""
    parts = F.split(F.col("payload"), r"\|")
    mk, mv = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    cols = {n: F.when((F.col("station") == s) & (mk == k), mv.try_cast(t)) for n, (s, k, t) in header_fields().items()}
    m = motor_info.select("ts", "seq", *[c.alias(n) for n, c in cols.items()],
                          F.lit(False).alias("__is_frame"))
    if positions is not None:
        m = m.unionByName(positions.select("ts", "seq", F.lpad(mv, 5, "0").alias("pos"), F.lit(False).alias("__is_frame")),
                          allowMissingColumns=True)
        cols["pos"] = None
    f = frames.withColumn("__is_frame", F.lit(True))
    u = row_bucket(f.unionByName(m, allowMissingColumns=True), [])
    u = u.withColumn("__later", ~F.col("__is_frame"))  # a report of the same place does not come before
    a = asof_last(u, [], ["ts", "seq", "__later"], "__day", list(cols), suffix="")
    return a.where("__is_frame").drop("__is_frame", "__later", "__day")


# --- J5 ---------------------------------------------------------------------
MATERIAL_EVENT_TOPICS = [C.ROLLING_ROLL_QUERY, C.ROLLING_MAT_AFTER_ROLL,
                         C.QUALITY_MAT_READY_TO_QCHECK, C.COLOUR_MAT_CHECK,
                         C.UNLOADING_MAT_QUERY, C.UNLOADING_MAT_FINAL,
                         C.ROLLING_MAT_POSITION, C.QUALITY_MAT_POSITION,
                         C.UNLOADING_MAT_POSITION]


def unknown_material(msgs: DataFrame, known: DataFrame, id_col: str = "id") -> DataFrame:
    """Messages about a material that was not forwarded before them.
    Position events of the loading station are exempt."""
    ev = msgs.where(F.col("topic").isin(*MATERIAL_EVENT_TOPICS))
    j = ev.join(known, id_col, "left")
    unknown = F.col("first_forward_ts").isNull() | (
        F.struct("ts", "seq") < F.struct("first_forward_ts", "first_forward_seq"))
    return j.where(unknown).drop("first_forward_ts", "first_forward_seq")


# --- J6 / P12 ---------------------------------------------------------------
def position_code(bits_df: DataFrame, positions: DataFrame, bits: str = "bits",
                  station: str = "station") -> DataFrame:
    """Highest-index active sensor -> label and coordinate; none -> ``-``."""
    b = bits_df.withColumn("idx", last_one_index(F.col(bits)))
    j = b.join(F.broadcast(positions.select(F.col("station").alias(station), "idx", "label",
                                            "coordinate")),
               [station, "idx"], "left")
    none = F.col("idx") == F.length(F.col(bits))
    return j.withColumns({
        "code": F.when(none, F.lit("-")).otherwise(F.col("label").cast("string")),
        "coordinate_text": F.when(none, F.lit("-")).otherwise(F.col("coordinate").cast("string")),
    })
