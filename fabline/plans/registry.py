"""Named queries: each callable takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole driver tables; ``ORACLE`` holds the DuckDB twin.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.functions import decode as D
from fabline.operators import aggs as A
from fabline.sources import adapters as AD
from fabline.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Settings every query relies on, applied to the caller's session: the
    wall clock is UTC (the tables hold naive timestamps). A checkpoint folder
    is asked for only by the operators that write to one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- A1 ---------------------------------------------------------------------
@register("daily_quality", O.with_(O.QUALITY_RECORDS) + """
SELECT strftime(day, '%Y-%m-%d') AS day,
       count(*) FILTER (WHERE quality = 'good') AS good,
       count(*) FILTER (WHERE quality = 'defect1') AS defect1,
       count(*) FILTER (WHERE quality = 'defect2') AS defect2
FROM quality_records GROUP BY day ORDER BY day""")
def q_daily_quality(spark, d):
    r = AD.quality_records(spark, d).withColumn("day", D.record_day(F.col("time_text")))
    return A.daily_quality(r)


def ntz(c):
    """Result timestamps as wall-clock (no zone) values."""
    return F.col(c).cast("timestamp_ntz").alias(c) if isinstance(c, str) else c.cast("timestamp_ntz")


from fabline.operators import filters as FL  # noqa: E402
from fabline.operators import joins as J  # noqa: E402
from fabline.operators.ordered import row_bucket, prev_row  # noqa: E402
from fabline.sources import files as FS  # noqa: E402
from fabline.sources import sinks as SK  # noqa: E402
from fabline.sources.messages import topic_source  # noqa: E402

EVQ = O.with_(O.EV, O.MATERIAL)


# --- S1 ---------------------------------------------------------------------
@register("topic_source", EVQ + """
SELECT topic, payload, ts, seq FROM material WHERE topic = '/loading/MatLoaded'""")
def q_topic_source(spark, d):
    m = AD.material_messages(spark, d)
    return topic_source(m, C.LOADING_MAT_LOADED).select("topic", "payload", ntz("ts"), "seq")


# --- S2 ---------------------------------------------------------------------
@register("ts_upsert", O.with_(O.EV, O.VIBRATION) + """
SELECT key AS measurement, (epoch_us(ts) // 1000) // 60000 * 60000 AS time_ms,
       arg_max(x, seq) AS x, arg_max(y, seq) AS y, arg_max(z, seq) AS z, count(*) AS n_writes
FROM vibration GROUP BY ALL""")
def q_ts_upsert(spark, d):
    v = AD.vibration(spark, d)
    return SK.ts_upsert(v, measurement="key", precision_ms=60_000)


# --- S3 / S4 / S10 ----------------------------------------------------------
SERIES_RN = O.with_(O.EV, O.SERIES_ROWS) + """, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts, seq) AS rn,
         count(*) OVER (PARTITION BY series) AS n FROM series_rows),
batches AS (
  SELECT series, seq, ts, quality, datapoints, rn, (rn - 1) // 50 AS batch_no
  FROM numbered WHERE (rn - 1) // 50 < n // 50)
"""


@register("export_batches", SERIES_RN + "SELECT series, batch_no, rn, seq, ts, quality, datapoints FROM batches")
def q_export_batches(spark, d):
    b = SK.export_batches(AD.series_rows(spark, d))
    return b.select("series", "batch_no", "rn", "seq", ntz("ts"), "quality", "datapoints")


def _export_lines(spark, d):
    b = SK.export_batches(AD.series_rows(spark, d))
    tt = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return b.select("series", "batch_no", "rn", "seq",
                    FS.delimited_line(tt, "quality", "datapoints").alias("line"))


@register("export_lines", SERIES_RN + """
SELECT series, batch_no, rn, seq,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || ';' || quality || ';' || datapoints || ';' AS line
FROM batches""")
def q_export_lines(spark, d):
    return _export_lines(spark, d)


@register("export_scan", SERIES_RN + """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || ';' || quality || ';' || datapoints || ';' AS line
FROM batches""")
def q_export_scan(spark, d):
    path = FS.new_folder(spark, "exports")
    # One folder per series; the batch number stays in the rows.
    FS.write_lines(_export_lines(spark, d), path, partition_by=["series"])
    return FS.export_scan(spark, path).select("line")


@register("series_purge", SERIES_RN + """
SELECT series, seq, ts, quality, datapoints FROM numbered WHERE (rn - 1) // 50 >= n // 50""")
def q_series_purge(spark, d):
    rows = AD.series_rows(spark, d)
    left = SK.series_purge(rows, SK.export_batches(rows))
    return left.select("series", "seq", ntz("ts"), "quality", "datapoints")


@register("series_count", O.with_(O.EV, O.SERIES_ROWS) + """
SELECT series, count(datapoints) AS n_points FROM series_rows GROUP BY series""")
def q_series_count(spark, d):
    return A.series_count(AD.series_rows(spark, d))


# --- S6 / S7 ----------------------------------------------------------------
def _dump_lines(spark, d):
    r = AD.quality_records(spark, d)
    digit = (F.when(F.col("quality") == C.GOOD, "0").when(F.col("quality") == C.DEFECT1, "1")
             .when(F.col("quality") == C.DEFECT2, "2").otherwise("9"))
    return r.select(F.concat(F.lit("'colour','"), F.col("seq").cast("string"), F.lit("','"), digit,
                             F.lit("','"), F.regexp_replace("datapoints", ",", "','"),
                             F.lit("'")).alias("line"))


DUMP_SQL = O.with_(O.QUALITY_RECORDS)


@register("labelled_dump", DUMP_SQL + """
SELECT cast(seq as varchar) AS id,
       CASE WHEN quality IN ('good', 'defect1', 'defect2') THEN quality ELSE '9' END AS label,
       datapoints FROM quality_records""")
def q_labelled_dump(spark, d):
    path = FS.new_folder(spark, "dumps")
    FS.write_lines(_dump_lines(spark, d), path)
    return FS.labelled_dump(spark.read.text(path).withColumnRenamed("value", "line"))


@register("dataset_land", DUMP_SQL + """
SELECT '''colour'',''' || cast(seq as varchar) || ''',''' ||
       CASE quality WHEN 'good' THEN '0' WHEN 'defect1' THEN '1' WHEN 'defect2' THEN '2' ELSE '9' END
       || ''',''' || replace(datapoints, ',', ''',''') || '''' AS line
FROM quality_records""")
def q_dataset_land(spark, d):
    src = FS.new_folder(spark, "collected")
    FS.write_lines(_dump_lines(spark, d), src)
    return FS.dataset_land(spark, src, FS.new_folder(spark, "landed"))


# --- A1 chain: S8 / S9 / A2 -------------------------------------------------
DAILY_SQL = O.with_(O.QUALITY_RECORDS) + """, daily AS (
SELECT strftime(day, '%Y-%m-%d') AS day,
       count(*) FILTER (WHERE quality = 'good') AS good,
       count(*) FILTER (WHERE quality = 'defect1') AS defect1,
       count(*) FILTER (WHERE quality = 'defect2') AS defect2
FROM quality_records GROUP BY day)
"""


def _daily(spark, d):
    r = AD.quality_records(spark, d).withColumn("day", D.record_day(F.col("time_text")))
    return A.daily_quality(r)


@register("stats_lines", DAILY_SQL + """
SELECT day || chr(9) || 'good=' || good || ', defect1=' || defect1 || ', defect2=' || defect2 AS line
FROM daily""")
def q_stats_lines(spark, d):
    path = FS.new_folder(spark, "stats")
    FS.write_lines(_daily(spark, d).select(FS.stats_line().alias("line")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("stats_parse", DAILY_SQL + """
SELECT sum(good)::BIGINT AS good, sum(defect1)::BIGINT AS defect1, sum(defect2)::BIGINT AS defect2,
       0::BIGINT AS n_bad_counters FROM daily""")
def q_stats_parse(spark, d):
    lines = q_stats_lines(spark, d)
    return FS.stats_parse(lines)


@register("train_ready", DAILY_SQL + """
SELECT sum(good)::BIGINT AS good, sum(defect1)::BIGINT AS defect1, sum(defect2)::BIGINT AS defect2,
       sum(good) >= 150 AND sum(defect1) >= 150 AND sum(defect2) >= 150 AS ready FROM daily""")
def q_train_ready(spark, d):
    return A.train_ready(_daily(spark, d))


# --- A8 ---------------------------------------------------------------------
@register("train_cap", SERIES_RN + """, files AS (
  SELECT series, batch_no, max(ts) AS file_ts,
         count(*) FILTER (WHERE quality = 'good') AS g,
         count(*) FILTER (WHERE quality = 'defect1') AS d1,
         count(*) FILTER (WHERE quality = 'defect2') AS d2
  FROM batches GROUP BY series, batch_no),
run AS (
  SELECT *, coalesce(sum(g) OVER w, 0) AS bg, coalesce(sum(d1) OVER w, 0) AS bd1,
         coalesce(sum(d2) OVER w, 0) AS bd2
  FROM files WINDOW w AS (ORDER BY file_ts, series, batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT b.series, b.batch_no, b.seq, b.quality AS label
FROM batches b JOIN run r USING (series, batch_no)
WHERE NOT (r.bg > 150 AND r.bd1 > 150 AND r.bd2 > 150)""")
def q_train_cap(spark, d):
    b = SK.export_batches(AD.series_rows(spark, d))
    one_file = Window.partitionBy("series", "batch_no")  # a batch of 50 rows
    recs = b.withColumn("file_ts", F.max("ts").over(one_file)).withColumnRenamed("quality", "label")
    kept = A.train_cap(recs, file_cols=("series", "batch_no"), file_order=("file_ts",))
    return kept.select("series", "batch_no", "seq", "label")


# --- F4 / P4 / P6 / P10 -----------------------------------------------------
@register("label_check", O.with_(O.QUALITY_RECORDS) + """
SELECT seq, quality FROM quality_records WHERE quality IN ('good', 'defect1', 'defect2')""")
def q_label_check(spark, d):
    r = AD.quality_records(spark, d)
    return r.where(FL.label_check(F.col("quality"))).select("seq", "quality")


@register("colour_train_decode", O.with_(O.QUALITY_RECORDS) + """
SELECT seq, quality, datapoints FROM quality_records""")
def q_colour_train_decode(spark, d):
    r = AD.quality_records(spark, d)
    digit = (F.when(F.col("quality") == C.GOOD, "0").when(F.col("quality") == C.DEFECT1, "1")
             .when(F.col("quality") == C.DEFECT2, "2").otherwise("x"))
    msgs = r.select("seq", F.concat(digit, F.lit(","), "datapoints").cast("binary").alias("payload"))
    return D.colour_train_decode(msgs).select("seq", "quality", "datapoints")


@register("feature_parse", O.with_(O.QUALITY_RECORDS) + """
SELECT seq, quality AS label, len(string_split(datapoints, ',')) AS n_features,
       list_sum(list_transform(string_split(datapoints, ','), lambda v: cast(v as double))) AS f_sum
FROM quality_records""")
def q_feature_parse(spark, d):
    r = AD.quality_records(spark, d)
    lines = r.select("seq", FS.delimited_line("time_text", "quality", "datapoints").alias("line"))
    p, _ = FL.split_rejects(D.feature_parse(lines))
    return p.select("seq", "label", F.size("features").cast("bigint").alias("n_features"),
                    F.aggregate("features", F.lit(0.0), lambda a, v: a + v).alias("f_sum"))


@register("record_day", O.with_(O.QUALITY_RECORDS) + """
SELECT seq, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S.%g') AS clock FROM quality_records""")
def q_record_day(spark, d):
    r = AD.quality_records(spark, d)
    return r.select("seq", D.record_day(F.col("time_text")).alias("day"), D.clock_text(F.col("ts")).alias("clock"))


# --- P1 ---------------------------------------------------------------------
@register("vib_text_decode", O.with_(O.EV, O.VIBRATION) + "SELECT seq, x, y, z FROM vibration")
def q_vib_text_decode(spark, d):
    good, _ = FL.split_rejects(D.vib_text_decode(AD.vibration_text(spark, d)))
    return good.select("seq", "x", "y", "z")


# --- P2 / P3 / F2 -----------------------------------------------------------
FRAMES_SQL = O.with_(O.EV, O.VIB_FRAMES, O.VIB_DECODED)


@register("vib_frame_decode", FRAMES_SQL + """
SELECT seq, location, sensor_id, array_to_string(motor_state, ',') AS motor_state,
       array_to_string(motor_direction, ',') AS motor_direction,
       array_to_string(motor_speed, ',') AS motor_speed, array_to_string(pos, ',') AS pos,
       array_to_string(raw, ',') AS raw
FROM vib_decoded""")
def q_vib_frame_decode(spark, d):
    good, _ = FL.split_rejects(D.vib_frame_decode(AD.vib_frames(spark, d)))
    return good.select("seq", "location", "sensor_id",
                       *[F.array_join(c, ",").alias(c) for c in
                         ("motor_state", "motor_direction", "motor_speed", "pos", "raw")])


@register("vib_frame_accel", FRAMES_SQL + f"""
SELECT seq, round({O.accel_axis(0)}, 9) AS x, round({O.accel_axis(1)}, 9) AS y,
       round({O.accel_axis(2, ' - 10.0::DOUBLE')}, 9) AS z
FROM vib_decoded""")
def q_vib_frame_accel(spark, d):
    good, _ = FL.split_rejects(D.vib_frame_decode(AD.vib_frames(spark, d)))
    a = D.vib_frame_accel(good)
    return a.select("seq", *[F.round(c, 9).alias(c) for c in ("x", "y", "z")])


@register("quarantine", O.with_(O.EV, O.VIB_FRAMES) + """
SELECT seq, 'short_frame' AS reject_reason FROM vib_frames WHERE length(hx) < 104""")
def q_quarantine(spark, d):
    return FL.quarantine(D.vib_frame_decode(AD.vib_frames(spark, d)))


@register("text_rejects", O.with_(O.EV, O.VIBRATION, O.QUALITY_RECORDS.replace("WITH ", "")) + """
SELECT 'vibration' AS kind, seq FROM vibration WHERE seq % 7 = 0
UNION ALL SELECT 'features', seq FROM quality_records WHERE seq % 4 = 0
UNION ALL SELECT 'pipe', seq FROM vibration WHERE seq % 3 = 0""")
def q_text_rejects(spark, d):
    """Rejects of the text decoders, each message of a fixed residue cut short or spoilt on the way."""
    v, r = AD.vibration_text(spark, d), AD.quality_records(spark, d)
    vib = D.vib_text_decode(v.withColumn("payload", F.when(F.col("seq") % 7 == 0, F.lit("1.0;x").cast("binary")).otherwise(F.col("payload"))))
    line = FS.delimited_line("time_text", "quality", F.when(F.col("seq") % 4 == 0, "1,b,3").otherwise(F.col("datapoints")))
    fea = D.feature_parse(r.select("seq", line.alias("line")))
    pipe = D.pipe_parse(v.select("seq", F.when(F.col("seq") % 3 == 0, "nobar").otherwise("id|1").cast("binary").alias("payload")))
    out = [FL.quarantine(x).select(F.lit(k).alias("kind"), "seq") for k, x in
           (("vibration", vib), ("features", fea), ("pipe", pipe))]
    return functools.reduce(DataFrame.unionByName, out)


# --- P5 ---------------------------------------------------------------------
@register("colour_frame_decode", O.with_(O.EV, O.COLOUR_FRAMES) + f"""
SELECT seq, material_id, 392 AS n_values,
       array_to_string(list_transform(range(0, 392), lambda i: {O.byte_sql('bh', 'i')}), ',') AS values_csv
FROM colour_frames""")
def q_colour_frame_decode(spark, d):
    f = D.colour_frame_decode(AD.colour_frames(spark, d, n_bytes=400))
    good, _ = FL.split_rejects(f)
    return good.select("seq", "material_id", F.size("values").alias("n_values"), "values_csv")


# --- P7 / P13 / A7 ----------------------------------------------------------
POS_SQL = EVQ + """, pos AS (
  SELECT seq, ts, split_part(payload, '|', 1) AS id, split_part(payload, '|', 2) AS value
  FROM material WHERE topic LIKE '%/MatPosition')
"""


def _positions(spark, d):
    m = AD.material_messages(spark, d)
    p = m.where(F.col("topic").endswith("/MatPosition"))
    good, _ = FL.split_rejects(D.pipe_parse(p))
    return good


@register("pipe_parse", POS_SQL + "SELECT seq, id, value FROM pos")
def q_pipe_parse(spark, d):
    return _positions(spark, d).select("seq", "id", "value")


@register("position_pad", POS_SQL + "SELECT seq, lpad(value, 5, '0') AS pos5 FROM pos")
def q_position_pad(spark, d):
    return _positions(spark, d).select("seq", D.position_pad(F.col("value")).alias("pos5"))


@register("material_latest", POS_SQL + """
SELECT id, arg_max(value, ts) AS position, max(ts) AS updated_at, count(*) AS n_updates
FROM pos GROUP BY id""")
def q_material_latest(spark, d):
    r = A.material_latest(_positions(spark, d))
    return r.select("id", "position", ntz("updated_at"), "n_updates")


# --- P8 ---------------------------------------------------------------------
@register("motor_info_pivot", O.with_(O.EV, O.MOTOR_INFO) + """, kv AS (
  SELECT station, ts, split_part(payload, '|', 1) AS key, split_part(payload, '|', 2) AS value FROM motor_info)
SELECT station,
  arg_max(value, ts) FILTER (WHERE key = 'isStarted') AS "isStarted",
  arg_max(value, ts) FILTER (WHERE key = 'direction') AS "direction",
  arg_max(value, ts) FILTER (WHERE key = 'speed') AS "speed",
  arg_max(value, ts) FILTER (WHERE key = 'isRollingStarted') AS "isRollingStarted",
  arg_max(value, ts) FILTER (WHERE key = 'rollingDirection') AS "rollingDirection",
  arg_max(value, ts) FILTER (WHERE key = 'rollingSpeed') AS "rollingSpeed"
FROM kv GROUP BY station""")
def q_motor_info_pivot(spark, d):
    mi = AD.motor_info(spark, d)
    kv = D.pipe_parse(mi, left="key", right="value")
    return (kv.groupBy("station").pivot("key", AD.MOTOR_KEYS)
            .agg(F.max_by("value", F.struct("ts", "seq"))))


# --- P9 ---------------------------------------------------------------------
@register("vib_amplitude", O.with_(O.EV, O.VIBRATION) + """, p AS (
  SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(z) OVER w AS pz
  FROM vibration WINDOW w AS (PARTITION BY machine_id ORDER BY ts, seq))
SELECT seq, machine_id, round((abs(x) + abs(y) + abs(z)) / 3.0, 9) AS level,
       round((abs(px - x) + abs(py - y) + abs(pz - z)) / 3.0, 9) AS change
FROM p""")
def q_vib_amplitude(spark, d):
    v = row_bucket(AD.vibration(spark, d), ["machine_id"])
    p = prev_row(v, ["machine_id"], ["ts", "seq"], "__day", ["x", "y", "z"])
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return p.select("seq", "machine_id",
                    F.round(D.amplitude(x, y, z), 9).alias("level"),
                    F.round(D.mean_abs_change(F.col("prev_x"), F.col("prev_y"), F.col("prev_z"), x, y, z),
                            9).alias("change"))


# --- P11 --------------------------------------------------------------------
@register("colour_rescale", O.with_(O.EV, O.RAW_COLOUR) + """
SELECT seq, (least(greatest(red, 100), 1300) - 100) * 255 // 1200 AS r8,
       (least(greatest(green, 190), 1300) - 190) * 255 // 1110 AS g8,
       (least(greatest(blue, 250), 1200) - 250) * 255 // 950 AS b8
FROM raw_colour""")
def q_colour_rescale(spark, d):
    return D.colour_rescale(AD.raw_colour(spark, d)).select("seq", "r8", "g8", "b8")


# --- P12 / J6 ---------------------------------------------------------------
BITS_SQL = O.with_(O.EV, O.SENSOR_BITS, O.POSITIONS) + """, bi AS (
  SELECT *, length(bits) - strpos(reverse(bits), '1') AS idx FROM sensor_bits)
"""


def _codes(spark, d):
    return J.position_code(AD.sensor_bits(spark, d), J.position_table(spark))


@register("position_code", BITS_SQL + """
SELECT seq, bi.station, bits, bi.idx,
       CASE WHEN bi.idx = length(bits) THEN '-' ELSE cast(p.label as varchar) END AS code,
       CASE WHEN bi.idx = length(bits) THEN '-' ELSE cast(p.coordinate as varchar) END AS coordinate_text
FROM bi LEFT JOIN positions p ON p.station = bi.station AND p.idx = bi.idx""")
def q_position_code(spark, d):
    return _codes(spark, d).select("seq", "station", "bits", F.col("idx").cast("bigint").alias("idx"), "code",
                                   "coordinate_text")


@register("position_lookup", BITS_SQL + """
SELECT seq, bi.station, bi.idx, p.label, p.coordinate
FROM bi JOIN positions p ON p.station = bi.station AND p.idx = bi.idx""")
def q_position_lookup(spark, d):
    return _codes(spark, d).where(F.col("label").isNotNull()).select(
        "seq", "station", F.col("idx").cast("bigint").alias("idx"), "label", "coordinate")


# --- F1 ---------------------------------------------------------------------
ROUTES = {
    C.TABLES_CONNECTION: "connection_log",
    C.LOADING_READY_TO_NEW_MAT: "heartbeat",
    C.LOADING_MAT_LOADED: "allow_route",
    C.LOADING_MAT_POSITION: "position_update",
    C.LOADING_MAT_DROPPED: "drop_log",
    C.LOADING_RFID_READ_PROBLEM: "warning_log",
    C.LOADING_WARNING: "warning_log",
    C.ROLLING_ROLL_QUERY: "thickness_lookup",
    C.ROLLING_MAT_POSITION: "position_update",
    C.ROLLING_WARNING: "warning_log",
    C.ROLLING_MAT_AFTER_ROLL: "mark_rolled",
    C.QUALITY_MAT_READY_TO_QCHECK: "ready_gate",
    C.QUALITY_MAT_POSITION: "position_update",
    C.QUALITY_WARNING: "warning_log",
    C.COLOUR_MAT_CHECK: "colour_check",
    C.COLOUR_WARNING: "warning_log",
    C.UNLOADING_MAT_QUERY: "unload_decision",
    C.UNLOADING_MAT_FINAL: "final",
    C.UNLOADING_MAT_POSITION: "position_update",
    C.UNLOADING_WARNING: "warning_log",
    C.ROLLING_MOTOR_INFO: "motor_state",
}
ROUTE_CASE = "CASE topic " + " ".join(f"WHEN '{t}' THEN '{s}'" for t, s in ROUTES.items()) + " END"
ROUTE_IN = ", ".join(f"'{t}'" for t in ROUTES)


@register("topic_route", O.with_(O.EV, O.MATERIAL, O.MOTOR) + f""", allm AS (
  SELECT seq, topic FROM material UNION ALL SELECT seq, topic FROM motor)
SELECT seq, topic, {ROUTE_CASE} AS stage FROM allm WHERE topic IN ({ROUTE_IN})""")
def q_topic_route(spark, d):
    m = AD.material_messages(spark, d).select("seq", "topic")
    mo = AD.motor_messages(spark, d).select("seq", "topic")
    return FL.topic_route(m.unionByName(mo), ROUTES)


# --- J3 / F3 ----------------------------------------------------------------
ASOF_SQL = O.with_(O.EV, O.VIBRATION, O.READINGS, O.MOTOR) + """, u AS (
  SELECT seq, ts, machine_id, NULL::BOOLEAN AS st, true AS is_r, x, y, z FROM readings
  UNION ALL
  SELECT seq, ts, machine_id, split_part(payload, '|', 2) = '1', false, NULL, NULL, NULL FROM motor),
asofr AS (
  SELECT seq, ts, machine_id, x, y, z, coalesce(last_value(st IGNORE NULLS) OVER (
      PARTITION BY machine_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS rolling
  FROM u QUALIFY is_r)
"""


def _asof(spark, d):
    return J.asof_motor(AD.readings(spark, d), AD.motor_messages(spark, d))


@register("asof_motor", ASOF_SQL + "SELECT seq, machine_id, rolling FROM asofr")
def q_asof_motor(spark, d):
    return _asof(spark, d).select("seq", "machine_id", "rolling")


@register("stall_filter", ASOF_SQL + """
SELECT seq, machine_id, rolling, round((abs(x) + abs(y) + abs(z)) / 3.0, 9) AS level,
       rolling AND (abs(x) + abs(y) + abs(z)) / 3.0 < 0.3 AS stall FROM asofr""")
def q_stall_filter(spark, d):
    a = _asof(spark, d)
    lvl = D.amplitude(F.col("x"), F.col("y"), F.col("z"))
    return a.select("seq", "machine_id", "rolling", F.round(lvl, 9).alias("level"),
                    FL.stall_filter(lvl, F.col("rolling")).alias("stall"))


# --- J4 ---------------------------------------------------------------------
def _asof_frame_sql():
    fields = J.header_fields()
    sel = [f"CASE WHEN station = '{s}' AND split_part(payload, '|', 1) = '{k}' THEN cast(split_part(payload, '|', 2) as "
           f"{'int' if t == 'int' else 'varchar'}) END AS {n}" for n, (s, k, t) in fields.items()]
    nulls = ", ".join(f"NULL::{'INT' if t == 'int' else 'VARCHAR'} AS {n}" for n, (_, _, t) in fields.items())
    lv = ", ".join(f"last_value({n} IGNORE NULLS) OVER w AS {n}" for n in [*fields, "pos"])
    return O.with_(O.EV, O.VIB_FRAMES, O.MOTOR_INFO, O.MATERIAL) + f""", u AS (
  SELECT seq, ts, true AS is_f, {nulls}, NULL::VARCHAR AS pos FROM vib_frames
  UNION ALL SELECT seq, ts, false, {", ".join(sel)}, NULL FROM motor_info
  UNION ALL SELECT seq, ts, false, {", ".join(["NULL"] * len(fields))}, lpad(split_part(payload, '|', 2), 5, '0')
  FROM material WHERE topic = '/loading/MatPosition')
SELECT seq, {lv} FROM u
WINDOW w AS (ORDER BY ts, seq, is_f DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
QUALIFY is_f"""


@register("asof_frame", _asof_frame_sql())
def q_asof_frame(spark, d):
    f = AD.vib_frames(spark, d).select("seq", "ts")
    pos = topic_source(AD.material_messages(spark, d), C.LOADING_MAT_POSITION).select("seq", "ts", D.text("payload").alias("payload"))
    a = J.asof_frame(f, AD.motor_info(spark, d), pos)
    return a.select("seq", *J.header_fields(), "pos")


# --- J1 / J2 / J5 / S11 -----------------------------------------------------
MAT_SQL = O.with_(O.EV, O.MATERIAL, O.ALLOW) + """, loads AS (
  SELECT m.seq, m.ts, m.id, CASE WHEN a.id IS NOT NULL THEN 'F' ELSE 'D' END AS decision
  FROM material m LEFT JOIN allow a ON a.id = m.id WHERE m.topic = '/loading/MatLoaded'),
known AS (
  SELECT id, arg_min(ts, (ts, seq)) AS fts, arg_min(seq, (ts, seq)) AS fseq FROM loads WHERE decision = 'F' GROUP BY id),
thick AS (
  SELECT q.seq, q.ts, q.id, a.thickness, q.id || '|' || a.thickness AS command
  FROM material q JOIN known k ON k.id = q.id JOIN allow a ON a.id = q.id
  WHERE q.topic = '/rolling/RollQuery' AND (q.ts, q.seq) > (k.fts, k.fseq))
"""


def _loads(spark, d):
    m = AD.material_messages(spark, d)
    loads = topic_source(m, C.LOADING_MAT_LOADED)
    return J.allow_route(loads, AD.allow_list(spark, d))


def _known(spark, d):
    return J.first_forward(_loads(spark, d))


def _thick(spark, d):
    m = AD.material_messages(spark, d)
    return J.thickness_lookup(topic_source(m, C.ROLLING_ROLL_QUERY), _known(spark, d),
                              AD.allow_list(spark, d))


@register("allow_route", MAT_SQL + "SELECT seq, id, decision, id || '|' || decision AS command FROM loads")
def q_allow_route(spark, d):
    return _loads(spark, d).select("seq", "id", "decision", "command")


@register("thickness_lookup", MAT_SQL + "SELECT seq, id, thickness, command FROM thick")
def q_thickness_lookup(spark, d):
    return _thick(spark, d).select("seq", "id", "thickness", "command")


@register("unknown_material", MAT_SQL + """
SELECT m.seq, m.id, m.topic FROM material m LEFT JOIN known k ON k.id = m.id
WHERE m.topic IN ('/rolling/RollQuery', '/rolling/MatAfterRoll', '/quality/MatReadyToQCheck',
                  '/colourSensor/MatCheck', '/unloading/MatQuery', '/unloading/MatFinal',
                  '/rolling/MatPosition', '/quality/MatPosition', '/unloading/MatPosition')
  AND (k.id IS NULL OR (m.ts, m.seq) < (k.fts, k.fseq))""")
def q_unknown_material(spark, d):
    u = J.unknown_material(AD.material_messages(spark, d), _known(spark, d))
    return u.select("seq", "id", "topic")


@register("command_out", MAT_SQL + """
SELECT '/loading/MatProcess' AS topic, id || '|' || decision AS payload, ts, seq FROM loads
UNION ALL SELECT '/rolling/RollThickness', command, ts, seq FROM thick""")
def q_command_out(spark, d):
    a = SK.command_out(_loads(spark, d), C.LOADING_MAT_PROCESS)
    b = SK.command_out(_thick(spark, d), C.ROLLING_ROLL_THICKNESS)
    return a.unionByName(b).select("topic", "payload", ntz("ts"), "seq")


# --- F6 ---------------------------------------------------------------------
@register("recent_range", O.with_(O.EV, O.VIBRATION) + """
SELECT seq, ts, x, y, z FROM vibration
WHERE ts >= (SELECT max(ts) FROM vibration) - INTERVAL 120 MINUTE ORDER BY ts""")
def q_recent_range(spark, d):
    r = FL.recent_range(AD.vibration(spark, d), minutes=120)
    return r.select("seq", ntz("ts"), "x", "y", "z").orderBy("ts")


# --- A4 ---------------------------------------------------------------------
@register("window_max_by", O.with_(O.EV, O.VIBRATION) + """, b AS (
  SELECT *, make_timestamp((epoch_us(ts) // 86400000000) * 86400000000) AS window_start FROM vibration)
SELECT key, window_start, window_start + INTERVAL 1 DAY AS window_end, seq, ts, x, y, z
FROM b QUALIFY row_number() OVER (PARTITION BY key, window_start ORDER BY ts DESC, seq) = 1""")
def q_window_max_by(spark, d):
    r = A.window_max_by(AD.vibration(spark, d), window="1 day")
    return r.select("key", ntz("window_start"), ntz("window_end"), "seq", ntz("ts"), "x", "y", "z")


# --- A9 / A10 / A11 ---------------------------------------------------------
@register("station_warnings", EVQ + """
SELECT split_part(topic, '/', 2) AS station, cast(ts as date) AS day, count(*) AS n_messages
FROM material WHERE topic IN ('/tables/connection', '/loading/rfidReadProblem', '/loading/warning',
  '/rolling/warning', '/quality/warning', '/colourSensor/warning', '/unloading/warning')
GROUP BY ALL""")
def q_station_warnings(spark, d):
    return A.station_warnings(AD.material_messages(spark, d))


@register("downsample_fill", O.with_(O.EV, O.VIBRATION) + """, b AS (
  SELECT (epoch_us(ts) // 600000000) * 600000000 AS bucket_us, x, y, z FROM vibration),
m AS (SELECT bucket_us, avg(x) AS ax, avg(y) AS ay, avg(z) AS az FROM b GROUP BY bucket_us),
g AS (SELECT unnest(generate_series(min(bucket_us), max(bucket_us), 600000000)) AS bucket_us FROM b)
SELECT make_timestamp(g.bucket_us) AS bucket_start, round(ax, 9) AS avg_x, round(ay, 9) AS avg_y,
       round(az, 9) AS avg_z
FROM g LEFT JOIN m USING (bucket_us)""")
def q_downsample_fill(spark, d):
    r = GP.downsample_fill(AD.vibration(spark, d))
    return r.select(ntz("bucket_start"), "avg_x", "avg_y", "avg_z")


@register("loop_time_stats", O.with_(O.EV, O.LOOP_TIME) + """
SELECT station, count(ms) AS n_reports, round(avg(ms), 6) AS avg_ms, max(ms) AS max_ms, min(ms) AS min_ms
FROM loop_time GROUP BY station""")
def q_loop_time_stats(spark, d):
    return A.loop_time_stats(AD.loop_time(spark, d))


# --- W1 / W2 / W3 / W4 / W5 -------------------------------------------------
from fabline.operators import anomaly as AN  # noqa: E402
from fabline.operators import gaps as GP  # noqa: E402
from fabline.operators import triggers as TR  # noqa: E402

# Readings are minutes apart in the driver tables, so the registered window
# queries use 1-day windows; the operators default to the line's 3 s.
DAY = "1 day"
TEST_LEVEL, TEST_CHANGE, TEST_COOLDOWN_S = 1.2, 0.6, 6 * 3600


@register("tumbling", O.with_(O.EV, O.VIBRATION) + """, b AS (
  SELECT *, make_timestamp((epoch_us(ts) // 86400000000) * 86400000000) AS window_start FROM vibration)
SELECT key, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n,
       min(ts) AS first_ts, max(ts) AS last_ts, round(avg(x), 9) AS avg_x, round(avg(y), 9) AS avg_y,
       round(avg(z), 9) AS avg_z
FROM b GROUP BY key, window_start""")
def q_tumbling(spark, d):
    t = TR.tumbling(AD.vibration(spark, d), window=DAY)
    return t.select("key", ntz("window_start"), ntz("window_end"), "n", ntz("first_ts"), ntz("last_ts"),
                    *[F.round(f"avg_{c}", 9).alias(f"avg_{c}") for c in "xyz"])


def delta_sql(level: float = 0.3, threshold: float = 0.6) -> str:
    lvl = "(abs(t.x) + abs(t.y) + abs(t.z)) / 3.0"
    chg = "(abs(r.ax - t.x) + abs(r.ay - t.y) + abs(r.az - t.z)) / 3.0"
    stall = f"(t.rolling AND {lvl} < {level})"
    return ASOF_SQL + f""", t0 AS (
  SELECT machine_id AS key, make_timestamp((epoch_us(ts) // 86400000000) * 86400000000) AS window_start,
         seq, ts, x, y, z, rolling FROM asofr),
t AS (
  SELECT *, row_number() OVER (PARTITION BY key, window_start ORDER BY ts, seq) AS rn,
         first_value(seq) OVER (PARTITION BY key, window_start, ts ORDER BY seq) AS e_seq
  FROM t0),
r AS (
  SELECT key, window_start, rn, x AS ax, y AS ay, z AS az, false AS fire,
         NULL::DOUBLE AS change, NULL::DOUBLE AS delta, false AS stall
  FROM t WHERE rn = 1
  UNION ALL
  SELECT key, window_start, rn,
         CASE WHEN delta > {threshold} THEN x ELSE ax END, CASE WHEN delta > {threshold} THEN y ELSE ay END,
         CASE WHEN delta > {threshold} THEN z ELSE az END, delta > {threshold}, change, delta, stall
  FROM (SELECT t.key, t.window_start, t.rn, t.x, t.y, t.z, r.ax, r.ay, r.az, {chg} AS change,
               {stall} AS stall, CASE WHEN {stall} THEN 1.0 ELSE {chg} END AS delta
        FROM r JOIN t ON t.key = r.key AND t.window_start = r.window_start AND t.rn = r.rn + 1) s),
fired AS (
  SELECT t.key, t.window_start, t.window_start + INTERVAL 1 DAY AS window_end, t.seq AS fire_seq,
         t.e_seq AS seq, t.ts, t.x, t.y, t.z, r.change, r.delta, r.stall, t.rolling
  FROM r JOIN t USING (key, window_start, rn) WHERE r.fire)
"""


def _fired(spark, d, level=C.VIBRATION_LIMIT):
    return TR.delta_trigger(_asof(spark, d), key="machine_id", window=DAY,
                            level_limit=level).withColumnRenamed("machine_id", "key")


@register("delta_trigger", delta_sql() + """
SELECT key, window_start, window_end, fire_seq, seq, ts, x, y, z, round(change, 9) AS change,
       round(delta, 9) AS delta, stall, rolling FROM fired""")
def q_delta_trigger(spark, d):
    f = _fired(spark, d)
    return f.select("key", ntz("window_start"), ntz("window_end"), "fire_seq", "seq", ntz("ts"),
                    "x", "y", "z", F.round("change", 9).alias("change"), F.round("delta", 9).alias("delta"),
                    "stall", "rolling")


@register("watermark_late", O.with_(O.EV, O.VIBRATION) + """
SELECT seq, ts, coalesce(ts < max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         false) AS is_late
FROM vibration""")
def q_watermark_late(spark, d):
    w = TR.watermark_late(AD.vibration(spark, d))
    return w.select("seq", ntz("ts"), "is_late")


STREAK_SQL = delta_sql(level=TEST_LEVEL) + f""", fb AS (
  SELECT *, rolling AND (abs(x) + abs(y) + abs(z)) / 3.0 < {TEST_LEVEL} AND change < {TEST_CHANGE} AS bad,
         row_number() OVER (PARTITION BY key ORDER BY ts, fire_seq) AS rn
  FROM fired)
"""


@register("anomaly_streak", STREAK_SQL + """, s AS (
  SELECT *, max(CASE WHEN NOT bad THEN rn END) OVER (PARTITION BY key ORDER BY ts, fire_seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lnb FROM fb)
SELECT key, fire_seq, bad, CASE WHEN bad THEN rn - coalesce(lnb, 0) ELSE 0 END AS streak,
       CASE WHEN bad THEN rn - coalesce(lnb, 0) ELSE 0 END > 1 AS alarm FROM s""")
def q_anomaly_streak(spark, d):
    s = AN.anomaly_streak(_fired(spark, d, TEST_LEVEL), level_limit=TEST_LEVEL, change_limit=TEST_CHANGE)
    return s.select("key", "fire_seq", "bad", "streak", "alarm")


@register("anomaly_cooldown", STREAK_SQL + f""", rr AS (
  SELECT key, rn, CASE WHEN bad THEN 1 ELSE 0 END AS cnt, NULL::BIGINT AS sup, false AS alarm FROM fb WHERE rn = 1
  UNION ALL
  SELECT key, rn, cnt2, CASE WHEN alarm2 THEN ts_us + {TEST_COOLDOWN_S * 1_000_000} ELSE sup END, alarm2
  FROM (SELECT fb.key, fb.rn, epoch_us(fb.ts) AS ts_us, rr.sup,
               CASE WHEN rr.sup IS NOT NULL AND epoch_us(fb.ts) < rr.sup THEN rr.cnt
                    WHEN fb.bad THEN rr.cnt + 1 ELSE 0 END AS cnt2,
               NOT coalesce(epoch_us(fb.ts) < rr.sup, false) AND fb.bad AND rr.cnt + 1 > 1 AS alarm2
        FROM rr JOIN fb ON fb.key = rr.key AND fb.rn = rr.rn + 1) s)
SELECT fb.key, fb.fire_seq AS seq, fb.ts AS alarm_ts,
       fb.ts + INTERVAL {TEST_COOLDOWN_S} SECOND AS restart_ts, rr.cnt::BIGINT AS streak
FROM rr JOIN fb USING (key, rn) WHERE rr.alarm""")
def q_anomaly_cooldown(spark, d):
    a = AN.anomaly_cooldown(_fired(spark, d, TEST_LEVEL), level_limit=TEST_LEVEL,
                            change_limit=TEST_CHANGE, cooldown_s=TEST_COOLDOWN_S)
    return a.select("key", "seq", ntz("alarm_ts"), ntz("restart_ts"), "streak")


COOLDOWN_SQL = ORACLE["anomaly_cooldown"]
ALARMS_CTE = COOLDOWN_SQL[:COOLDOWN_SQL.rindex("SELECT fb.key")]


@register("alarm_commands", ALARMS_CTE + f""", alarms AS (
  SELECT fb.fire_seq AS seq, fb.ts AS alarm_ts, fb.ts + INTERVAL {TEST_COOLDOWN_S} SECOND AS restart_ts
  FROM rr JOIN fb USING (key, rn) WHERE rr.alarm)
SELECT '/rolling/control' AS topic, p.payload, alarm_ts AS ts, seq FROM alarms, (VALUES ('z'), ('p')) p(payload)
UNION ALL
SELECT '/rolling/control', p.payload, restart_ts, seq FROM alarms, (VALUES ('m'), ('s')) p(payload)""")
def q_alarm_commands(spark, d):
    a = AN.anomaly_cooldown(_fired(spark, d, TEST_LEVEL), level_limit=TEST_LEVEL,
                            change_limit=TEST_CHANGE, cooldown_s=TEST_COOLDOWN_S)
    return AN.alarm_commands(a).select("topic", "payload", ntz("ts"), "seq")


# --- J7 / R1 / A5 / A6 ------------------------------------------------------
from fabline.operators import knn as KN  # noqa: E402

KNN_SQL = O.with_(O.LABELLED) + """, tr AS (SELECT * FROM labelled WHERE is_train),
qu AS (SELECT * FROM labelled WHERE NOT is_train),
nb AS (
  SELECT qu.vec_id AS q_id, tr.vec_id AS t_id, tr.label AS t_label,
         sqrt(list_sum(list_transform(list_zip(qu.features, tr.features), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist
  FROM qu, tr
  QUALIFY row_number() OVER (PARTITION BY qu.vec_id ORDER BY dist, tr.vec_id) <= 5),
nr AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, t_id) AS rank FROM nb),
votes AS (
  SELECT q.q_id, c.label, count(n.t_id) AS votes
  FROM (SELECT DISTINCT q_id FROM nb) q CROSS JOIN (VALUES ('good'), ('defect1'), ('defect2')) c(label)
  LEFT JOIN nb n ON n.q_id = q.q_id AND n.t_label = c.label GROUP BY ALL),
dec AS (
  SELECT q_id, (sum(votes) FILTER (WHERE label = 'good'))::BIGINT AS good,
         (sum(votes) FILTER (WHERE label = 'defect1'))::BIGINT AS defect1,
         (sum(votes) FILTER (WHERE label = 'defect2'))::BIGINT AS defect2
  FROM votes GROUP BY q_id)
"""


def _neigh(spark, d):
    lv = AD.labelled_vectors(spark, d)
    return KN.knn_neighbours(lv.where(~F.col("is_train")), lv.where("is_train"), AD.VECTOR_DIM)


@register("knn_neighbours", KNN_SQL + "SELECT q_id, t_id, t_label, round(dist, 9) AS dist FROM nb")
def q_knn_neighbours(spark, d):
    return _neigh(spark, d).select("q_id", "t_id", "t_label", F.round("dist", 9).alias("dist"))


@register("knn_topk", KNN_SQL + "SELECT q_id, rank, t_id, t_label FROM nr")
def q_knn_topk(spark, d):
    return _neigh(spark, d).select("q_id", "rank", "t_id", "t_label")


@register("knn_topk_cells", KNN_SQL + "SELECT q_id, rank, t_id, t_label FROM nr")
def q_knn_topk_cells(spark, d):
    """R1 as for a training set that is too large to send: by cells round pivots, pruned by their bounds."""
    lv = AD.labelled_vectors(spark, d)
    near = KN.knn_neighbours(lv.where(~F.col("is_train")), lv.where("is_train"), AD.VECTOR_DIM, broadcast_bytes=0, cell_rows=64)
    return near.select("q_id", "rank", "t_id", "t_label")


@register("knn_distribution", KNN_SQL + "SELECT q_id, label, votes, votes / 5.0 AS share FROM votes")
def q_knn_distribution(spark, d):
    return KN.knn_distribution(_neigh(spark, d))


@register("knn_decide", KNN_SQL + """
SELECT q_id, good, defect1, defect2,
       CASE WHEN defect1 >= defect2 AND defect1 >= good THEN 'defect1'
            WHEN defect2 >= defect1 AND defect2 >= good THEN 'defect2' ELSE 'good' END AS decision
FROM dec""")
def q_knn_decide(spark, d):
    return KN.knn_decide(KN.knn_distribution(_neigh(spark, d)))


@register("knn_unknown", KNN_SQL + """
SELECT q_id, CASE WHEN q_id % 10 = 0 THEN 'unknown'
       WHEN defect1 >= defect2 AND defect1 >= good THEN 'defect1'
       WHEN defect2 >= defect1 AND defect2 >= good THEN 'defect2' ELSE 'good' END AS decision
FROM dec""")
def q_knn_unknown(spark, d):
    """A decision for every query vector; those cut short on the way are ``unknown``."""
    lv = AD.labelled_vectors(spark, d)
    q = lv.where(~F.col("is_train")).withColumn("features", F.when(F.col("vec_id") % 10 == 0, F.slice("features", 1, 5)).otherwise(F.col("features")))
    near = KN.knn_neighbours(q, lv.where("is_train"), AD.VECTOR_DIM)
    return KN.knn_decide(KN.knn_distribution(near, q)).select("q_id", "decision")


# --- W6 / F5 / W8 / W9 ------------------------------------------------------
from fabline.operators import debounce as DB  # noqa: E402
from fabline.operators import lifecycle as LC  # noqa: E402
from fabline.session import ensure_checkpoint_dir  # noqa: E402
from fabline.sources.tables import table  # noqa: E402


def knn_sql(query_set: str) -> str:
    """kNN CTEs (``nb``, ``votes``, ``dec``) for the query vectors ``qu``."""
    return f""", tr AS (SELECT * FROM labelled WHERE is_train),
qu AS ({query_set}),
nb AS (
  SELECT qu.vec_id AS q_id, tr.vec_id AS t_id, tr.label AS t_label,
         sqrt(list_sum(list_transform(list_zip(qu.features, tr.features), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist
  FROM qu, tr
  QUALIFY row_number() OVER (PARTITION BY qu.vec_id ORDER BY dist, tr.vec_id) <= 5),
votes AS (
  SELECT q.q_id, c.label, count(n.t_id) AS votes
  FROM (SELECT DISTINCT q_id FROM nb) q CROSS JOIN (VALUES ('good'), ('defect1'), ('defect2')) c(label)
  LEFT JOIN nb n ON n.q_id = q.q_id AND n.t_label = c.label GROUP BY ALL),
dec AS (
  SELECT q_id, CASE WHEN d1 >= d2 AND d1 >= g THEN 'defect1' WHEN d2 >= d1 AND d2 >= g THEN 'defect2'
                    ELSE 'good' END AS decision
  FROM (SELECT q_id, sum(votes) FILTER (WHERE label = 'good') AS g,
               sum(votes) FILTER (WHERE label = 'defect1') AS d1,
               sum(votes) FILTER (WHERE label = 'defect2') AS d2 FROM votes GROUP BY q_id))
"""


def _check_predictions(spark, d):
    m = topic_source(AD.material_messages(spark, d), C.COLOUR_MAT_CHECK)
    n = table(spark, d, "embeddings").select(F.count(F.lit(1))).scalar()
    # Read twice: worked out of the events once.
    ensure_checkpoint_dir(spark)
    checks = m.select("seq", (F.col("seq") % n).alias("q_id")).checkpoint()
    lv = AD.labelled_vectors(spark, d)
    queries = lv.join(checks.select(F.col("q_id").alias("vec_id")), "vec_id", "left_semi")
    near = KN.knn_neighbours(queries, lv.where("is_train"), AD.VECTOR_DIM)
    dec = KN.knn_decide(KN.knn_distribution(near, queries))
    return checks.join(dec.select("q_id", F.col("decision").alias("prediction")), "q_id").drop("q_id")


def _lifecycle(spark, d):
    return LC.material_lifecycle(AD.material_messages(spark, d), AD.allow_list(spark, d),
                                 _check_predictions(spark, d))


LC_TOPICS = ", ".join(f"'{t}'" for t in LC.LIFECYCLE_TOPICS)
LIFECYCLE_SQL = O.with_(O.EV, O.MATERIAL, O.ALLOW, O.LABELLED) + knn_sql(
    "SELECT * FROM labelled WHERE vec_id IN (SELECT seq % (SELECT count(*) FROM embeddings) FROM material "
    "WHERE topic = '/colourSensor/MatCheck')") + f""", pred AS (
  SELECT m.seq, dec.decision AS prediction FROM material m
  JOIN dec ON dec.q_id = m.seq % (SELECT count(*) FROM embeddings) WHERE m.topic = '/colourSensor/MatCheck'),
al AS (SELECT id, max(thickness) AS thickness FROM allow GROUP BY id),
t AS (
  SELECT m.id, m.seq, m.topic, al.thickness AS thickness0, al.id IS NOT NULL AS allowed0, p.prediction,
         row_number() OVER (PARTITION BY m.id ORDER BY m.ts, m.seq) AS rn
  FROM material m LEFT JOIN al ON al.id = m.id LEFT JOIN pred p ON p.seq = m.seq
  WHERE m.topic IN ({LC_TOPICS})),
lc AS (
  SELECT DISTINCT id, 0::BIGINT AS rn, false AS known, allowed0 AS allowed, false AS rolled, false AS ready,
         NULL::VARCHAR AS quality, NULL::BIGINT AS seq, NULL::VARCHAR AS action, NULL::VARCHAR AS out_topic,
         NULL::VARCHAR AS out_payload
  FROM t WHERE rn = 1
  UNION ALL
  SELECT id, rn, known OR action = 'forward', CASE WHEN action = 'final' THEN false ELSE allowed END,
         rolled OR action = 'rolled', ready OR action = 'ready',
         CASE WHEN action = 'classified' AND prediction IS NOT NULL THEN prediction ELSE quality END,
         seq, action,
         CASE action WHEN 'forward' THEN '/loading/MatProcess' WHEN 'drop' THEN '/loading/MatProcess'
                     WHEN 'thickness' THEN '/rolling/RollThickness' WHEN 'ready' THEN '/colourSensor/MatReadyToQCheck'
                     WHEN 'classified' THEN '/quality/MatCheck' WHEN 'unload' THEN '/unloading/MatDrop' END,
         CASE action WHEN 'forward' THEN id || '|F' WHEN 'drop' THEN id || '|D'
                     WHEN 'thickness' THEN id || '|' || CASE WHEN allowed THEN thickness0 ELSE 'null' END
                     WHEN 'ready' THEN id WHEN 'classified' THEN id || '|0'
                     WHEN 'unload' THEN id || CASE WHEN quality = 'good' THEN '|0' ELSE '|1' END END
  FROM (
    SELECT t.id, t.rn, t.seq, t.thickness0, t.prediction, lc.known, lc.allowed, lc.rolled, lc.ready, lc.quality,
      CASE
        WHEN t.topic = '/loading/MatLoaded' THEN CASE WHEN lc.allowed THEN 'forward' ELSE 'drop' END
        WHEN t.topic LIKE '%/MatPosition' THEN CASE WHEN lc.known THEN 'position'
             WHEN t.topic = '/loading/MatPosition' THEN 'ignored' ELSE 'unknown_material' END
        WHEN t.topic = '/rolling/RollQuery' THEN CASE WHEN lc.known THEN 'thickness' ELSE 'unknown_material' END
        WHEN t.topic = '/rolling/MatAfterRoll' THEN CASE WHEN lc.known THEN 'rolled' ELSE 'unknown_material' END
        WHEN t.topic = '/quality/MatReadyToQCheck' THEN CASE WHEN lc.known AND lc.rolled THEN 'ready' ELSE 'not_ready' END
        WHEN t.topic = '/colourSensor/MatCheck' THEN CASE WHEN NOT lc.known THEN 'check_skipped'
             WHEN lc.ready THEN 'classified' ELSE 'not_ready' END
        WHEN t.topic = '/unloading/MatQuery' THEN CASE WHEN lc.known AND lc.quality IS NOT NULL THEN 'unload' ELSE 'no_answer' END
        WHEN t.topic = '/unloading/MatFinal' THEN CASE WHEN lc.known AND lc.quality IS NOT NULL THEN 'final' ELSE 'final_ignored' END
        ELSE 'log' END AS action
    FROM lc JOIN t ON t.id = lc.id AND t.rn = lc.rn + 1) s),
actions AS (SELECT id, seq, action, out_topic, out_payload, quality FROM lc WHERE rn > 0)
"""


@register("material_lifecycle", LIFECYCLE_SQL + "SELECT * FROM actions")
def q_material_lifecycle(spark, d):
    return _lifecycle(spark, d).select("id", "seq", "action", "out_topic", "out_payload", "quality")


@register("stage_gate", LIFECYCLE_SQL + """
SELECT id, seq, action, action IN ('ready', 'classified', 'unload') AS passed FROM actions
WHERE action IN ('ready', 'not_ready', 'classified', 'check_skipped', 'unload', 'no_answer')""")
def q_stage_gate(spark, d):
    return LC.stage_gate(_lifecycle(spark, d))


@register("one_time_id", O.with_(O.EV, O.MATERIAL, O.ALLOW) + """, lf AS (
  SELECT seq, ts, id, topic, coalesce(count(*) FILTER (WHERE topic = '/unloading/MatFinal') OVER (
      PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_final_before
  FROM material WHERE topic IN ('/loading/MatLoaded', '/unloading/MatFinal'))
SELECT lf.seq, lf.id, lf.n_final_before,
       CASE WHEN a.id IS NOT NULL AND lf.n_final_before = 0 THEN 'F' ELSE 'D' END AS decision
FROM lf LEFT JOIN (SELECT DISTINCT id FROM allow) a ON a.id = lf.id WHERE lf.topic = '/loading/MatLoaded'""")
def q_one_time_id(spark, d):
    o = LC.one_time_id(AD.material_messages(spark, d), AD.allow_list(spark, d))
    return o.select("seq", "id", "n_final_before", "decision")


@register("debounce_change", BITS_SQL + """, c AS (
  SELECT bi.seq, bi.ts, bi.station, bits,
         CASE WHEN bi.idx = length(bits) THEN '-' ELSE cast(p.label as varchar) END AS code,
         row_number() OVER (PARTITION BY bi.station ORDER BY bi.ts, bi.seq) AS rn
  FROM bi LEFT JOIN positions p ON p.station = bi.station AND p.idx = bi.idx),
db AS (
  SELECT DISTINCT station, 0::BIGINT AS rn, ''::VARCHAR AS lbits, NULL::BIGINT AS lpass, ''::VARCHAR AS lcode,
         NULL::BIGINT AS seq, NULL::VARCHAR AS bits, NULL::VARCHAR AS pub
  FROM c
  UNION ALL
  SELECT station, rn,
         CASE WHEN pass THEN bits ELSE lbits END, CASE WHEN pass THEN ts_us ELSE lpass END,
         CASE WHEN NOT pass THEN lcode WHEN code = '-' THEN 'ff' ELSE code END,
         seq, bits,
         CASE WHEN NOT pass THEN NULL WHEN code = '-' THEN '-' WHEN code <> lcode THEN code END
  FROM (SELECT c.station, c.rn, c.seq, c.bits, c.code, epoch_us(c.ts) AS ts_us, db.lbits, db.lpass, db.lcode,
               c.bits <> db.lbits AND (db.lpass IS NULL OR epoch_us(c.ts) - db.lpass > 200000) AS pass
        FROM db JOIN c ON c.station = db.station AND c.rn = db.rn + 1) s)
SELECT station, seq, bits, pub AS code FROM db WHERE pub IS NOT NULL""")
def q_debounce_change(spark, d):
    codes = _codes(spark, d).select("seq", "ts", "station", "bits", "code")
    return DB.debounce_change(codes).select("station", "seq", "bits", "code")


PUBLISH_SQL = BITS_SQL + """, c AS (
  SELECT bi.seq, bi.ts, bi.station, bits, CASE WHEN bi.seq % 5 = 0 THEN NULL ELSE substr(bi.id, 8, 1) END AS id,
         CASE WHEN bi.idx = length(bits) THEN '-' ELSE cast(p.label as varchar) END AS code,
         CASE WHEN bi.idx = length(bits) THEN '-' ELSE cast(p.coordinate as varchar) END AS coord,
         row_number() OVER (PARTITION BY bi.station ORDER BY bi.ts, bi.seq) AS rn
  FROM bi LEFT JOIN positions p ON p.station = bi.station AND p.idx = bi.idx),
db AS (
  SELECT DISTINCT station, 0::BIGINT AS rn, ''::VARCHAR AS lbits, NULL::BIGINT AS lpass, ''::VARCHAR AS lcode, NULL::VARCHAR AS lid,
         NULL::BIGINT AS seq, NULL::VARCHAR AS id, false AS isnew, NULL::VARCHAR AS pub FROM c
  UNION ALL
  SELECT station, rn, CASE WHEN pass THEN bits ELSE lbits END, CASE WHEN pass THEN ts_us ELSE lpass END,
         CASE WHEN NOT pass THEN lcode WHEN code = '-' AND isnew THEN lcode WHEN code = '-' THEN 'ff' ELSE code END,
         coalesce(id, lid), seq, id, isnew,
         CASE WHEN NOT pass THEN NULL WHEN code = '-' THEN CASE WHEN NOT isnew THEN '-' END WHEN code <> lcode THEN coord END
  FROM (SELECT s.*, id IS NOT NULL AND ((bits <> lbits AND (lpass IS NULL OR ts_us - lpass > 200000)) OR isnew) AS pass
        FROM (SELECT c.station, c.rn, c.seq, c.bits, c.code, c.coord, c.id, epoch_us(c.ts) AS ts_us, db.lbits, db.lpass, db.lcode, db.lid,
                     c.station = 'loading' AND c.id IS NOT NULL AND c.id IS DISTINCT FROM db.lid AS isnew
              FROM db JOIN c ON c.station = db.station AND c.rn = db.rn + 1) s) s)
SELECT station, seq, id || '|7560' AS payload, 0 AS place FROM db WHERE isnew
UNION ALL SELECT station, seq, id || '|' || pub, 1 FROM db WHERE pub IS NOT NULL"""


@register("position_publish", PUBLISH_SQL)
def q_position_publish(spark, d):
    codes = _codes(spark, d).select("seq", "ts", "station", "bits", "code", "coordinate_text",
                                    F.when(F.col("seq") % 5 != 0, F.substring("id", 8, 1)).alias("id"))
    return DB.position_publish(codes).select("station", "seq", "payload", "place")


# --- streaming forms (W2 stream, W7, S2 stream) ----------------------------
from fabline.operators.triggers import window_seconds  # noqa: E402
from fabline.sources import store as STORE  # noqa: E402
from fabline.streaming import gaps as GL  # noqa: E402
from fabline.streaming import handoff as HO  # noqa: E402
from fabline.streaming import stateful as SF  # noqa: E402
from fabline.streaming import stream as ST  # noqa: E402


SLICE = "5 days"


def _land(df: DataFrame, path: str, by: str = "ts", rows: int = 1_000_000, end: dict | None = None) -> tuple[str, int]:
    """Land rows as the stream's input files, one slice of time after the other; returns the slice length and the files of
    a slice.

    Slices are ``SLICE`` long whatever the table (six equal runs of numbers if ``by`` is a number); files hold at most
    about ``rows`` rows, in no order within a slice, so a delay of one slice covers them. Every slice has the same number of
    files, some without rows where it is short. Rows without a time come with the first slice. ``end`` lands one closing
    row, later than all others by two slices, that lets the watermark pass them. ``df`` is worked out once.
    """
    spark, staged = df.sparkSession, f"{path}-staged"
    df.write.parquet(staged)
    df = spark.read.schema(df.schema).parquet(staged)
    at = F.unix_micros("ts") if by == "ts" else F.col(by)
    lo, hi, n = df.select(F.min(at), F.max(at), F.count(F.lit(1))).first()
    if lo is None:
        lo = hi = 0
    length = int(window_seconds(SLICE) * 1_000_000) if by == "ts" else (hi - lo) // 6 + 1
    slices = (hi - lo) // length + 1
    files = max(1, -(-n // (slices * rows)))
    cut = df.withColumn("__slice", F.coalesce(F.floor((at - lo) / length), F.lit(0)))
    for i in range(slices):
        cut.where(F.col("__slice") == i).drop("__slice").repartition(files).write.mode("append").parquet(path)
        for _ in range((i + 1) * files - len(spark.read.schema(df.schema).parquet(path).inputFiles()) if files > 1 else 0):
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
    if end is not None:
        last = [F.lit(end.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name != "ts"]
        (spark.range(1).select(F.timestamp_micros(F.lit(hi + 2 * length)).alias("ts"), *last)
         .select(*df.columns).coalesce(1).write.mode("append").parquet(path))
    return f"{length // 1000 + 1} milliseconds", files


def _stream_in(spark, name: str, df: DataFrame, end: dict | None = None, by: str = "ts"):
    """(stream of ``df`` with one slice a micro-batch, delay, output folder, checkpoint folder)."""
    src, out, ck = ST.scratch_query_paths(spark, name)
    delay, files = _land(df, src, by=by, end=end)
    return ST.read_stream(spark, src, df.schema, max_files=files), delay, out, ck


def _stream_out(df: DataFrame, out: str, ck: str) -> DataFrame:
    ST.run_to_parquet(df, out, ck).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


@register("asof_motor_stream", ASOF_SQL + "SELECT seq, machine_id, rolling FROM asofr")
def q_asof_motor_stream(spark, d):
    # One topic stream carries both kinds of message, as on the line.
    r = AD.readings(spark, d).withColumn("payload", F.lit(None).cast("string"))
    u = r.unionByName(AD.motor_messages(spark, d).select("seq", "ts", "machine_id", D.text("payload").alias("payload")), allowMissingColumns=True)
    s, delay, out, ck = _stream_in(spark, "asof", u, end={})
    rs = ST.stream_asof_motor(s.where(F.col("payload").isNull()), s.where(F.col("payload").isNotNull()), delay)
    return _stream_out(rs, out, ck).select("seq", "machine_id", "rolling")


@register("delta_trigger_stream", ORACLE["delta_trigger"])
def q_delta_trigger_stream(spark, d):
    s, delay, out, ck = _stream_in(spark, "delta", _asof(spark, d), end={})
    r = _stream_out(SF.delta_trigger_live(s, delay, key="machine_id", window=DAY), out, ck)
    return r.select(F.col("machine_id").alias("key"), ntz("window_start"), ntz("window_end"), "fire_seq", "seq",
                    ntz("ts"), "x", "y", "z", F.round("change", 9).alias("change"),
                    F.round("delta", 9).alias("delta"), "stall", "rolling")


def _live_alarms(spark, d):
    s, delay, out, ck = _stream_in(spark, "alarms", _asof(spark, d), end={})
    return _stream_out(SF.alarms_live(s, delay, key="machine_id", window=DAY, level_limit=TEST_LEVEL, change_limit=TEST_CHANGE,
                                      cooldown_s=TEST_COOLDOWN_S).withColumnRenamed("machine_id", "key"), out, ck)


@register("anomaly_cooldown_stream", ORACLE["anomaly_cooldown"])
def q_anomaly_cooldown_stream(spark, d):
    return _live_alarms(spark, d).where("event = 'stop'").select("key", "seq", ntz("alarm_ts"), ntz("restart_ts"), "streak")


@register("alarm_commands_stream", ORACLE["alarm_commands"])
def q_alarm_commands_stream(spark, d):
    """STOP with the alarm, START by a timer at the restart time."""
    return SF.live_commands(_live_alarms(spark, d)).select("topic", "payload", ntz("ts"), "seq")


NULL_SERIES = O.with_(O.EV, O.SERIES_ROWS.replace("event_type AS series", "CASE WHEN event_type <> 'signup' THEN event_type END AS series")) + SERIES_RN.split(O.SERIES_ROWS)[1].strip()


def _null_series(spark, d):
    """Series rows, one of the series without a name."""
    return AD.series_rows(spark, d).withColumn("series", F.when(F.col("series") != "signup", F.col("series")))


@register("export_batches_stream", NULL_SERIES + "SELECT series, batch_no, rn, seq, ts, quality, datapoints FROM batches")
def q_export_batches_stream(spark, d):
    """Batches leave a running stream as soon as they are full."""
    s, delay, out, ck = _stream_in(spark, "exports", _null_series(spark, d), end={"series": "end of input"})
    live = SF.export_live(s, delay)
    SF.write_micro_batches(live, out, ck).awaitTermination()
    return spark.read.schema(live.schema).parquet(out).select("series", "batch_no", "rn", "seq", ntz("ts"), "quality", "datapoints")


@register("series_purge_store", NULL_SERIES + "SELECT series, seq, ts, quality, datapoints FROM numbered WHERE (rn - 1) // 50 >= n // 50")
def q_series_purge_store(spark, d):
    """What a stored series table holds after its full batches are exported, committed and purged."""
    store = FS.new_folder(spark, "series-store")
    STORE.append_points(_null_series(spark, d), store)
    STORE.export_and_purge(spark, store)
    return STORE.points(spark, store).select("series", "seq", ntz("ts"), "quality", "datapoints")


@register("watermark_late_stream", ORACLE["watermark_late"])
def q_watermark_late_stream(spark, d):
    """On-time and late rows of a stream in two tables, put together again."""
    v = AD.vibration(spark, d)
    s, _, out, ck = _stream_in(spark, "late", v, by="seq")
    SF.split_late(s, out, ck).awaitTermination()
    parts = [spark.read.schema(v.schema).parquet(f"{out}/{name}").withColumn("is_late", F.lit(name == "late")) for name in ("on_time", "late")]
    return parts[0].unionByName(parts[1]).select("seq", ntz("ts"), "is_late")


@register("ts_upsert_stream", O.with_(O.EV, O.VIBRATION) + """
SELECT CASE WHEN key = 'error' THEN '007' WHEN key = 'signup' THEN NULL ELSE key END AS measurement,
       epoch_us(ts) // 1000 AS time_ms, arg_max(x, seq) AS x, arg_max(y, seq) AS y, arg_max(z, seq) AS z
FROM vibration GROUP BY ALL""")
def q_ts_upsert_stream(spark, d):
    """The store merged batch by batch, with a measurement that looks like a number and a null one, points written twice."""
    v = AD.vibration(spark, d).select(
        F.when(F.col("key") == "error", "007").when(F.col("key") != "signup", F.col("key")).alias("measurement"), "ts", "seq", "x", "y", "z")
    s, _, out, ck = _stream_in(spark, "store", v.unionByName(v.where("seq % 3 = 0").withColumn("seq", F.col("seq") - 1)))
    ST.upsert_stream(s, out, ck).awaitTermination()
    schema = "measurement string, ts timestamp, seq bigint, x double, y double, z double, day date"
    return spark.read.schema(schema).parquet(out).select("measurement", SK.point_time("ts").alias("time_ms"), "x", "y", "z")


@register("topic_source_stream", ORACLE["topic_source"])
def q_topic_source_stream(spark, d):
    m, _, out, ck = _stream_in(spark, "topics", AD.material_messages(spark, d))
    s = topic_source(m, C.LOADING_MAT_LOADED)
    return _stream_out(s.select("topic", "payload", "ts", "seq"), out, ck).select("topic", "payload", ntz("ts"), "seq")


LIFE_COLS = ["id", "seq", "action", "out_topic", "out_payload", "quality"]


def _lifecycle_out(df: DataFrame, out: str, ck: str) -> DataFrame:
    with SF.state_partitions(df.sparkSession, SF.ID_PARTITIONS):
        return _stream_out(df, out, ck).where("id IS NOT NULL").select(*LIFE_COLS)


@register("material_lifecycle_stream", ORACLE["material_lifecycle"])
def q_material_lifecycle_stream(spark, d):
    """The stream starts from the allow-list as its state table."""
    s, delay, out, ck = _stream_in(spark, "lifecycle", AD.material_messages(spark, d), end={"topic": C.LOADING_MAT_LOADED})
    # Static sides of a long-running stream are materialised once.
    preds = _check_predictions(spark, d).checkpoint()
    state = LC.lifecycle_state(AD.allow_list(spark, d)).checkpoint()
    return _lifecycle_out(SF.lifecycle_live(s, state, delay, preds), out, ck)


@register("material_lifecycle_resume", ORACLE["material_lifecycle"])
def q_material_lifecycle_resume(spark, d):
    """The first messages by the batch operator, the others by a stream that starts from the state the batch has left."""
    msgs, allow = AD.material_messages(spark, d), AD.allow_list(spark, d).checkpoint()
    preds = _check_predictions(spark, d).checkpoint()
    half = F.timestamp_micros(F.floor((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2).cast("bigint"))
    at = msgs.select(half).scalar()
    early = msgs.where(F.col("ts") <= at).checkpoint()
    actions = LC.material_lifecycle(early, allow, preds).select(*LIFE_COLS).checkpoint()
    state = LC.lifecycle_state(allow, actions, early).checkpoint()
    s, delay, out, ck = _stream_in(spark, "resume", msgs.where(F.col("ts") > at), end={"topic": C.LOADING_MAT_LOADED})
    return actions.unionByName(_lifecycle_out(SF.lifecycle_live(s, state, delay, preds), out, ck))


@register("daily_quality_stream", DAILY_SQL + "SELECT day, good, defect1, defect2 FROM daily")
def q_daily_quality_stream(spark, d):
    r = AD.quality_records(spark, d).withColumn("day", D.record_day(F.col("time_text"))).select("seq", "ts", "day", "quality")
    s, _, out, ck = _stream_in(spark, "daily", r, by="seq")
    SF.daily_quality_live(s, out, ck).awaitTermination()
    return spark.read.schema(SF.DAILY).parquet(out).select("day", "good", "defect1", "defect2")


@register("recent_range_store", O.with_(O.EV, O.VIBRATION) + """
SELECT seq, ts, x, y, z FROM vibration WHERE ts >= (SELECT max(ts) FROM vibration) - INTERVAL 120 MINUTE""")
def q_recent_range_store(spark, d):
    """The recent range out of a store partitioned by series and day, reading its last days only."""
    path = FS.new_folder(spark, "vibration-store")
    v = AD.vibration(spark, d).select("seq", "ts", "x", "y", "z", "key", F.to_date("ts").alias("day"))
    v.write.partitionBy("key", "day").parquet(path)
    schema = "seq bigint, ts timestamp, x double, y double, z double, key string, day date"
    return FL.recent_from_store(spark, path, schema, minutes=120).select("seq", ntz("ts"), "x", "y", "z")


@register("downsample_fill_stream", O.with_(O.EV, O.VIBRATION) + """, b AS (
  SELECT key, (epoch_us(ts) // 600000000) * 600000000 AS bucket_us, x, y, z FROM vibration),
m AS (SELECT key, bucket_us, avg(x) AS ax, avg(y) AS ay, avg(z) AS az FROM b GROUP BY ALL),
g AS (SELECT key, unnest(generate_series(min(bucket_us), (SELECT max(bucket_us) FROM b), 600000000)) AS bucket_us FROM b GROUP BY key)
SELECT g.key, make_timestamp(g.bucket_us) AS bucket_start, round(ax, 9) AS avg_x, round(ay, 9) AS avg_y, round(az, 9) AS avg_z
FROM g LEFT JOIN m ON m.key IS NOT DISTINCT FROM g.key AND m.bucket_us = g.bucket_us""")
def q_downsample_fill_stream(spark, d):
    """Per key, empty buckets by timers; up to the last bucket of the table, a live stream goes on."""
    v = AD.vibration(spark, d).select("key", "ts", "seq", "x", "y", "z")
    s, delay, out, ck = _stream_in(spark, "downsample", v, end={"key": "end of input"})
    live = _stream_out(GL.downsample_live(s, delay, "key"), out, ck).where("key IS DISTINCT FROM 'end of input'")
    last = v.select(F.timestamp_micros(GP.bucket_start(F.max("ts"), 600)).alias("last"))
    return live.where(F.col("bucket_start") <= last.scalar()).select("key", ntz("bucket_start"), "avg_x", "avg_y", "avg_z")


HANDOFF_SETS = 30  # small enough for the smallest table to be ready in mid-stream


@register("readiness_handoff_stream", O.with_(O.LABELLED) + f""", nth AS (
  SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM labelled WHERE is_train),
sw AS (SELECT CASE WHEN count(*) = 3 THEN max(vec_id) END AS version FROM nth WHERE n = {HANDOFF_SETS}),
tr AS (SELECT * FROM labelled, sw WHERE is_train AND vec_id <= version),
qu AS (SELECT * FROM labelled, sw WHERE NOT is_train AND vec_id > version),
nb AS (
  SELECT qu.vec_id AS q_id, tr.label AS t_label
  FROM qu, tr
  QUALIFY row_number() OVER (PARTITION BY qu.vec_id ORDER BY
    sqrt(list_sum(list_transform(list_zip(qu.features, tr.features), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), tr.vec_id) <= 5),
votes AS (SELECT q_id, count(*) FILTER (WHERE t_label = 'good') AS good, count(*) FILTER (WHERE t_label = 'defect1') AS defect1,
                 count(*) FILTER (WHERE t_label = 'defect2') AS defect2 FROM nb GROUP BY q_id)
SELECT vec_id AS seq, good, defect1, defect2,
       CASE WHEN good IS NULL THEN 'unknown' WHEN defect1 >= defect2 AND defect1 >= good THEN 'defect1'
            WHEN defect2 >= defect1 AND defect2 >= good THEN 'defect2' ELSE 'good' END AS decision,
       CASE WHEN good IS NOT NULL THEN version END AS version
FROM labelled CROSS JOIN sw LEFT JOIN votes ON q_id = vec_id WHERE NOT is_train""")
def q_readiness_handoff_stream(spark, d):
    """Records and checks in one stream: unknown up to the switch row, then decisions of the training set handed over there."""
    m = AD.labelled_vectors(spark, d).select(F.col("vec_id").alias("seq"), "features", "label", (~F.col("is_train")).alias("is_check"))
    s, _, out, ck = _stream_in(spark, "handoff", m, by="seq")
    HO.classify_live(s, out, ck, AD.VECTOR_DIM, HANDOFF_SETS).awaitTermination()
    return HO.decisions(spark, out)
