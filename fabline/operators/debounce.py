"""Debounced position change stream (W9).

Per station, in time order: a light-barrier bit string passes when it
differs from the last passed one and more than ``debounce_ms`` passed since
the last pass. A passing string whose position code differs from the last
published code is published; a passing string with no active sensor
publishes ``-``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.fold import FoldSpec, run_fold

NONE_CODE = "-"


def debounce_spec(debounce_us: int) -> FoldSpec:
    def step(state, r):
        last_bits, last_pass, last_code = state
        if r.bits == last_bits or (last_pass is not None and r.ts_us - last_pass <= debounce_us):
            return state, None
        if r.code != NONE_CODE:
            if r.code != last_code:
                return [r.bits, r.ts_us, r.code], [(r.seq, r.bits, r.code)]
            return [r.bits, r.ts_us, last_code], None
        return [r.bits, r.ts_us, "ff"], [(r.seq, r.bits, NONE_CODE)]

    return FoldSpec(lambda: ["", None, ""], step, ["seq", "ts_us", "bits", "code"],
                    "seq long, bits string, code string")


def debounce_change(codes: DataFrame, key: str = "station", debounce_ms: int = C.DEBOUNCE_MS,
                    segment_rows: int = 2_000_000) -> DataFrame:
    """Published position changes per ``key``: ``key, seq, bits, code``.
    Input needs ``seq, ts, bits, code`` (``code`` from ``position_code``)."""
    b = codes.withColumn("ts_us", F.unix_micros("ts"))
    return run_fold(b, [key], ["ts_us", "seq"], debounce_spec(debounce_ms * 1000),
                    segment_rows=segment_rows)


def publish_spec(debounce_us: int, first_read: str) -> FoldSpec:
    def step(state, r):
        last_bits, last_pass, last_code, last_id = state
        if not isinstance(r.id, str) or not r.id:   # nothing is published without a material
            return state, None
        new = r.first_read and r.id != last_id
        out = [(r.seq, f"{r.id}|{first_read}", 0)] if new else []
        moved = r.bits != last_bits and (last_pass is None or r.ts_us - last_pass > debounce_us)
        if not (moved or new):
            return [last_bits, last_pass, last_code, r.id], None
        if r.code != NONE_CODE:
            if r.code != last_code:
                out.append((r.seq, f"{r.id}|{r.coordinate_text}", 1))
            last_code = r.code
        elif not new:
            out.append((r.seq, f"{r.id}|{NONE_CODE}", 1))
            last_code = "ff"
        return [r.bits, r.ts_us, last_code, r.id], out

    return FoldSpec(lambda: ["", None, "", None], step, ["seq", "ts_us", "bits", "code", "coordinate_text", "id", "first_read"],
                    "seq long, payload string, place int")


def position_publish(codes: DataFrame, key: str = "station", debounce_ms: int = C.DEBOUNCE_MS,
                     first_read: int = C.FIRST_READ_COORDINATE, segment_rows: int = 2_000_000) -> DataFrame:
    """Position messages ``id|coordinate`` per ``key``: ``key, seq, payload,
    place`` (``place`` orders the messages of one row).

    Nothing passes without a material id. At the loading station a new id
    first reports ``first_read`` and its first position passes undebounced;
    an empty barrier on that first pass is not reported."""
    b = codes.withColumns({"ts_us": F.unix_micros("ts"), "first_read": F.coalesce(F.col(key) == C.STATIONS[0], F.lit(False))})
    return run_fold(b, [key], ["ts_us", "seq"], publish_spec(debounce_ms * 1000, str(first_read)), segment_rows=segment_rows)
