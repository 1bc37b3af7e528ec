"""DuckDB SQL twins of the adapters and queries (the correctness oracle).

Each ``*_CTE`` equals the Spark adapter of the same name in
``fabline.sources.adapters``; queries are built as ``WITH <ctes> SELECT``.
"""

from __future__ import annotations

K = "cast(json_extract_string(props, '$.k') as int)"

EV = f"""ev AS (
  SELECT event_id AS seq, ts, user_id, event_type, value, {K} AS k FROM events)"""

VIBRATION = """vibration AS (
  SELECT seq, ts, event_type AS key, user_id % 8 AS machine_id,
         (cast(round(value * 100) as bigint) % 2000) / 1000.0 AS x,
         (k % 40) / 20.0 AS y, (user_id % 40) / 20.0 AS z
  FROM ev)"""

READINGS = """readings AS (
  SELECT * FROM vibration WHERE key IN ('view', 'click', 'purchase'))"""

MOTOR = """motor AS (
  SELECT seq, ts, user_id % 8 AS machine_id, '/rolling/motorInfo' AS topic,
         'isRollingStarted|' || CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS payload
  FROM ev WHERE event_type IN ('signup', 'error'))"""

STATION = """CASE event_type WHEN 'signup' THEN 'loading' WHEN 'view' THEN 'rolling'
       WHEN 'click' THEN 'rolling' WHEN 'purchase' THEN 'quality' WHEN 'error' THEN 'unloading' END"""

SENSOR_BITS = f"""sensor_bits AS (
  SELECT seq, ts, {STATION} AS station, printf('%08x', user_id) AS id,
         lpad(bin(user_id % 64), 6, '0') AS bits
  FROM ev)"""

RAW_COLOUR = """raw_colour AS (
  SELECT seq, cast(round(value * 100) as bigint) % 1600 AS red,
         cast((k * 17) % 1500 as bigint) AS green, (user_id * 11) % 1400 AS blue
  FROM ev)"""

LOOP_TIME = f"""loop_time AS (
  SELECT seq, ts, {STATION} AS station, '/' || {STATION} || '/loopTime' AS topic, k AS ms
  FROM ev)"""

MOTOR_INFO = f"""motor_info AS (
  SELECT seq, ts, {STATION} AS station, '/' || {STATION} || '/motorInfo' AS topic,
         (['isStarted', 'direction', 'speed', 'isRollingStarted', 'rollingDirection', 'rollingSpeed'])[k % 6 + 1]
         || '|' || CASE WHEN (k % 6) % 3 = 0 THEN cast(k % 2 as varchar)
                        WHEN (k % 6) % 3 = 1 THEN CASE WHEN k % 2 = 1 THEN 'l' ELSE 'r' END
                        ELSE cast(k + 100 as varchar) END AS payload
  FROM ev)"""

MATERIAL = """material AS (
  SELECT seq, ts, printf('%08x', user_id) AS id,
    CASE WHEN event_type = 'signup' THEN '/loading/MatLoaded'
         WHEN event_type = 'view' THEN '/' || (['loading', 'rolling', 'quality', 'unloading'])[k % 4 + 1] || '/MatPosition'
         WHEN event_type = 'click' THEN CASE WHEN k % 2 = 0 THEN '/rolling/MatAfterRoll' ELSE '/rolling/RollQuery' END
         WHEN event_type = 'purchase' THEN CASE WHEN k % 3 = 0 THEN '/quality/MatReadyToQCheck'
                                                WHEN k % 3 = 1 THEN '/colourSensor/MatCheck'
                                                ELSE '/unloading/MatQuery' END
         ELSE CASE WHEN k % 2 = 0 THEN '/unloading/MatFinal'
                   ELSE '/' || (['loading', 'rolling', 'quality', 'unloading'])[k % 4 + 1] || '/warning' END
    END AS topic,
    CASE WHEN event_type = 'view' THEN printf('%08x', user_id) || '|' || cast(k * 630 as varchar)
         WHEN event_type = 'error' AND k % 2 = 1 THEN 'warning ' || cast(k as varchar)
         ELSE printf('%08x', user_id) END AS payload
  FROM ev)"""

ALLOW = """allow AS (
  SELECT DISTINCT printf('%08x', user_id) AS id, '50' AS thickness FROM events WHERE user_id % 3 <> 0
  UNION
  SELECT * FROM (VALUES ('80795adb', '50'), ('d0715adb', '50'), ('40e35bdb', '50'), ('d0655adb', '50'),
                        ('e02f5ddb', '50'), ('e0195adb', '50'), ('801e5adb', '50')) t(id, thickness))"""

QUALITY_RECORDS = """quality_records AS (
  SELECT l_orderkey * 10 + l_linenumber AS seq, l_shipdate AS ts, cast(l_shipdate as date) AS day,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS time_text,
         CASE WHEN l_returnflag = 'A' THEN 'good' WHEN l_returnflag = 'N' THEN 'defect1'
              WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'defect2' ELSE 'none' END AS quality,
         concat_ws(',', cast(l_quantity as int), l_partkey % 256, l_suppkey % 256, l_linenumber) AS datapoints
  FROM lineitem)"""

SERIES_ROWS = """series_rows AS (
  SELECT event_type AS series, seq, ts, (['good', 'defect1', 'defect2'])[k % 3 + 1] AS quality,
         concat_ws(',', k, user_id % 256, cast(round(value) as bigint)) AS datapoints
  FROM ev)"""

LABELLED = """labelled AS (
  SELECT vec_id, cast(embedding as double[]) AS features,
         (['good', 'defect1', 'defect2'])[label % 3 + 1] AS label, vec_id % 5 <> 0 AS is_train
  FROM embeddings)"""

POSITIONS = """positions AS (
  SELECT * FROM (VALUES
    ('loading', 0, 4, 3780), ('loading', 1, 5, 5040), ('loading', 2, 10, 10080),
    ('loading', 3, 11, 11340), ('loading', 4, 13, 13230), ('loading', 5, 16, 15750),
    ('rolling', 0, 18, 17640), ('rolling', 1, 20, 19530), ('rolling', 2, 21, 21420),
    ('rolling', 3, 23, 23310), ('rolling', 4, 26, 26460), ('rolling', 5, 28, 27720),
    ('rolling', 6, 30, 29610), ('rolling', 7, 32, 31500),
    ('quality', 0, 33, 33390), ('quality', 1, 36, 35910), ('quality', 2, 38, 37800),
    ('quality', 3, 42, 41580), ('quality', 4, 43, 43470), ('quality', 5, 46, 45990),
    ('quality', 6, 48, 47880),
    ('unloading', 0, 50, 50400), ('unloading', 1, 52, 52290), ('unloading', 2, 54, 54180),
    ('unloading', 3, 57, 56700), ('unloading', 4, 59, 58590), ('unloading', 5, 60, 60480)
  ) t(station, idx, label, coordinate))"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def md5_cat(letters: str) -> str:
    return " || ".join(f"md5('{c}' || seq)" for c in letters)


def byte_sql(hx: str, i: str) -> str:
    return f"('0x' || substr({hx}, 2 * ({i}) + 1, 2))::INT"


def int16_sql(hx: str, i: str) -> str:
    u = f"('0x' || substr({hx}, 2 * ({i}) + 1, 4))::INT"
    return f"(CASE WHEN {u} >= 32768 THEN {u} - 65536 ELSE {u} END)"


VIB_FRAMES = f"""vib_frames AS (
  SELECT seq, ts, user_id % 8 AS machine_id,
         upper(substr({md5_cat('abcd')}, 1, CASE WHEN seq % 50 = 7 THEN 96 ELSE 104 END)) AS hx
  FROM ev)"""

VIB_DECODED = f"""vib_decoded AS (
  SELECT seq, ts, machine_id,
         {byte_sql('hx', '0')} AS location, {byte_sql('hx', '1')} AS sensor_id,
         list_transform(range(2, 7), lambda i: {byte_sql('hx', 'i')}) AS motor_state,
         list_transform(range(7, 12), lambda i: {byte_sql('hx', 'i')}) AS motor_direction,
         list_transform(range(12, 17), lambda i: {byte_sql('hx', 'i')}) AS motor_speed,
         list_concat(list_transform(range(17, 21), lambda i: {byte_sql('hx', 'i')} - 48),
                     [CASE WHEN {byte_sql('hx', '21')} = 45 THEN 0 ELSE {byte_sql('hx', '21')} - 48 END]) AS pos,
         list_transform(range(0, 15), lambda j: {int16_sql('hx', '22 + 2 * j')}) AS raw
  FROM vib_frames WHERE length(hx) = 104)"""


def grav(r: str) -> str:
    return f"(9.813::DOUBLE * 4.0::DOUBLE * (({r})::DOUBLE / 64000.0::DOUBLE))"


def accel_axis(axis: int, shift: str = "") -> str:
    terms = [grav(f"raw[{s * 3 + axis + 1}]") + shift for s in range(5)]
    return "(" + " + ".join(f"({t})" for t in terms) + ") / 5.0::DOUBLE"


COLOUR_FRAMES = f"""colour_frames AS (
  SELECT seq, printf('%08x', user_id) AS material_id,
         upper(substr({md5_cat('abcdefghijklmnopqrstuvwxy')}, 1, 784)) AS bh
  FROM ev)"""
