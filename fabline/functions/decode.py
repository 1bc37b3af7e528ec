"""Decoders for the line's message payloads (text and binary frames).

All decoding is built from JVM-side column functions (``split``, ``hex``,
``conv``, ``transform``), so it stays inside whole-stage code generation.
Every decoder returns typed columns plus a ``reject_reason`` column; rows
with a reason go to the quarantine table (see ``quarantine``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabline.functions import codes as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(payload: str | Column) -> Column:
    """UTF-8 text of a binary payload (strings pass through)."""
    return _c(payload).cast("string")


def byte_array(payload: str | Column) -> Column:
    """Unsigned bytes of a binary payload as ``array<int>``, in one linear
    pass: Latin-1 maps each byte to one char, ``split`` yields the chars and
    ``ascii`` their codes."""
    return F.transform(F.split(F.decode(_c(payload), "ISO-8859-1"), ""), lambda ch: F.ascii(ch))


def byte_at(arr: Column, i) -> Column:
    """Unsigned byte ``i`` (0-based; int or Column) of a byte array."""
    idx = (F.lit(i) if isinstance(i, int) else i) + 1
    return F.try_element_at(arr, idx.cast("int"))


def int16_at(arr: Column, i) -> Column:
    """Signed big-endian int16 starting at byte ``i`` of a byte array."""
    u = byte_at(arr, i) * 256 + byte_at(arr, (F.lit(i) if isinstance(i, int) else i) + 1)
    return F.when(u >= 32768, u - 65536).otherwise(u)


# --- P1 ---------------------------------------------------------------------
def vib_text_decode(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``x;y;z`` text -> doubles ``x, y, z``; bad text gets a reject reason."""
    parts = F.split(text(payload), ";")
    out = df.withColumns({
        "x": F.try_element_at(parts, F.lit(1)).try_cast("double"),
        "y": F.try_element_at(parts, F.lit(2)).try_cast("double"),
        "z": F.try_element_at(parts, F.lit(3)).try_cast("double"),
    })
    return out.withColumn("reject_reason", F.when(
        F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull(), F.lit("bad_xyz")))


# --- P2 ---------------------------------------------------------------------
FRAME_BYTES = 52


def vib_frame_decode(df: DataFrame, payload: str = "payload") -> DataFrame:
    """52-byte frame -> header fields and 15 signed int16 samples ``raw``.

    Position digits are ``byte - 48``; the last position byte ``-`` (45)
    reads as 0. Frames shorter than 52 bytes are rejected.
    """
    hx = byte_array(payload)
    rng = lambda a, n: F.transform(F.sequence(F.lit(a), F.lit(a + n - 1)), lambda i: byte_at(hx, i))
    out = df.withColumn("__b", hx)
    hx = F.col("__b")
    pos4 = byte_at(hx, 21)
    out = out.withColumns({
        "location": byte_at(hx, 0),
        "sensor_id": byte_at(hx, 1),
        "motor_state": rng(2, 5),
        "motor_direction": rng(7, 5),
        "motor_speed": rng(12, 5),
        "pos": F.concat(
            F.transform(F.sequence(F.lit(17), F.lit(20)), lambda i: byte_at(hx, i) - 48),
            F.array(F.when(pos4 == 45, F.lit(0)).otherwise(pos4 - 48))),
        "raw": F.transform(F.sequence(F.lit(0), F.lit(14)), lambda j: int16_at(hx, j * 2 + 22)),
    })
    return out.drop("__b").withColumn("reject_reason", F.when(
        F.octet_length(_c(payload)) < FRAME_BYTES, F.lit("short_frame")))


# --- P3 ---------------------------------------------------------------------
def gravity(raw: Column) -> Column:
    """Raw LIS3DH sample -> m/s^2."""
    return F.lit(C.G_CONST) * F.lit(float(C.LSB_VAL)) * (raw.cast("double") / F.lit(float(C.LSB16_TO_KILO_LSB10)))


def vib_frame_accel(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Mean acceleration of the 5 (x, y, z) samples; z is shifted by -10."""
    r = F.col(raw)

    def mean_axis(axis: int, shift: float = 0.0) -> Column:
        vals = F.transform(F.sequence(F.lit(0), F.lit(4)),
                           lambda s: gravity(F.try_element_at(r, s * 3 + axis + 1)) - F.lit(shift))
        return F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + v) / F.lit(5.0)

    return df.withColumns({"x": mean_axis(0), "y": mean_axis(1), "z": mean_axis(2, C.Z_OFFSET)})


# --- P4 ---------------------------------------------------------------------
def colour_train_decode(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``c,v1,v2,...`` with class digit c -> ``quality`` and ``datapoints`` text."""
    t = text(payload)
    q = (F.when(t.startswith("0"), C.GOOD).when(t.startswith("1"), C.DEFECT1)
         .when(t.startswith("2"), C.DEFECT2).otherwise(C.NO_LABEL))
    return df.withColumns({"quality": q, "datapoints": F.substring(t, 3, 1 << 30)})


# --- P5 ---------------------------------------------------------------------
def colour_frame_decode(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Colour check frame -> ``material_id`` (first 8 bytes) and the
    remaining bytes as unsigned ints ``values`` and ``values_csv``."""
    p = _c(payload)
    n = F.octet_length(p) - 8
    vals = F.slice(byte_array(p), 9, F.greatest(n, F.lit(1)))
    out = df.withColumns({
        "material_id": F.substring(p, 1, 8).cast("string"),
        "values": F.when(n > 0, vals).otherwise(F.array().cast("array<int>")),
    })
    return out.withColumns({
        "values_csv": F.array_join(F.col("values"), ","),
        "reject_reason": F.when(n <= 0, F.lit("short_frame")),
    })


# --- P6 ---------------------------------------------------------------------
def feature_parse(df: DataFrame, line: str = "line", labelled: bool = True) -> DataFrame:
    """Export line ``time;quality;v1,v2,...;`` -> ``label`` and double
    ``features``; unlabelled lines ``time;v1,...`` get label ``unknown``."""
    rest = F.expr(f"substring({line}, instr({line}, ';') + 1)")
    if labelled:
        parts = F.split(rest, ";")
        label = F.try_element_at(parts, F.lit(1))
        vec_txt = F.try_element_at(parts, F.lit(2))
    else:
        label = F.lit(C.UNKNOWN_LABEL)
        vec_txt = rest
    feats = F.transform(F.split(vec_txt, ","), lambda v: v.try_cast("double"))
    out = df.withColumns({"label": label, "features": feats})
    bad = (F.col("features").isNull() | F.exists("features", lambda v: v.isNull())
           | F.col("label").isNull())
    return out.withColumn("reject_reason", F.when(bad, F.lit("bad_vector")))


# --- P7 ---------------------------------------------------------------------
def pipe_parse(df: DataFrame, payload: str = "payload", left: str = "id",
               right: str = "value") -> DataFrame:
    """``a|b`` -> two string columns; missing right part is rejected."""
    parts = F.split(text(payload), r"\|")
    out = df.withColumns({left: F.try_element_at(parts, F.lit(1)),
                          right: F.try_element_at(parts, F.lit(2))})
    return out.withColumn("reject_reason", F.when(F.col(right).isNull(), F.lit("no_pipe")))


# --- P9 ---------------------------------------------------------------------
def amplitude(x: Column, y: Column, z: Column) -> Column:
    """Vibration level ``(|x|+|y|+|z|)/3``."""
    return (F.abs(x) + F.abs(y) + F.abs(z)) / F.lit(3.0)


def mean_abs_change(ax: Column, ay: Column, az: Column, bx: Column, by: Column, bz: Column) -> Column:
    """Mean absolute per-axis difference of two readings."""
    return (F.abs(ax - bx) + F.abs(ay - by) + F.abs(az - bz)) / F.lit(3.0)


# --- P10 --------------------------------------------------------------------
def record_day(time_text: Column) -> Column:
    """Day text before ``T`` of an ISO time text; null when there is no ``T``."""
    return F.when(F.instr(time_text, "T") > 0, F.substring_index(time_text, "T", 1))


def receive_stamp(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Stamp rows with the receive time (the line stamps messages on
    arrival, not with device time)."""
    return df.withColumn(ts, F.current_timestamp())


def clock_text(ts: Column) -> Column:
    """``HH:mm:ss.SSS`` rendering of a timestamp."""
    return F.date_format(ts, "HH:mm:ss.SSS")


# --- P11 --------------------------------------------------------------------
def rescale(v: Column, lo: int, hi: int) -> Column:
    """Clamp to [lo, hi], then integer linear map to 0..255."""
    cl = F.least(F.greatest(v.cast("bigint"), F.lit(lo)), F.lit(hi))
    return F.floor((cl - F.lit(lo)) * F.lit(255) / F.lit(hi - lo)).cast("bigint")


def colour_rescale(df: DataFrame, red: str = "red", green: str = "green", blue: str = "blue") -> DataFrame:
    return df.withColumns({
        "r8": rescale(F.col(red), *C.RED_RANGE),
        "g8": rescale(F.col(green), *C.GREEN_RANGE),
        "b8": rescale(F.col(blue), *C.BLUE_RANGE),
    })


# --- P12 / P13 --------------------------------------------------------------
def last_one_index(bits: Column) -> Column:
    """0-based index of the last ``1`` in a bit string; ``length`` when none."""
    return F.length(bits) - F.locate("1", F.reverse(bits))


def position_pad(value: Column, width: int = 5) -> Column:
    """Left-pad a coordinate text with ``0`` to ``width`` chars (``-`` stays last)."""
    return F.lpad(value, width, "0")
