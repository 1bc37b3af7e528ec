"""Removal of every byte that a repeated string of ``length`` bytes covers, by hash-compared suffix sorting.

All windows of ``length`` bytes of all texts would be too many to sort together, so they are first dealt out by an
anchor: the ``gram``-byte string inside a window with the smallest hash. Equal windows have equal anchors at equal
offsets, consecutive windows mostly share theirs, and a run of windows with one anchor string travels as one row. Runs whose anchor string occurs once are unique. Runs that are equal as a whole are repeats as
a whole. Only where runs with one anchor string differ are their bytes fetched and their windows sorted as suffixes:
a merge sort that compares two suffixes by the length of their common extension, found by binary search over prefix
polynomial hashes; neighbours that agree for ``length`` bytes are verified byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, few_rows, with_row_id

LENGTH = 200
GRAM = 100
PIECE = 1 << 18  # bytes hashed at once; longer texts go in pieces that overlap by a window
LONGEST = 128  # windows a run has at most, so rows bound what a task holds
GROUP = 1024  # differing runs of one anchor string that meet in one task; larger groups compare window by window
_rng = np.random.default_rng(20240229)
BYTES = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the (odd) bases and of their inverses modulo 2**64."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        n = max(n, PIECE + 2 * LENGTH)
        _POWERS[:] = [tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, dtype=np.uint64)]))
                            for x in (b, pow(b, -1, 1 << 64))) for b in BASES]
    return _POWERS


class PrefixHashes:
    """Hashes of any stretch of ``data`` from prefix sums; equal stretches have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray, which: int = 0):
        power, self.inverse = _powers(len(data) + 1)[which]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[which][data] * power[:len(data)])])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive values."""
    n, span = len(x) - width + 1, 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


def runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows that share an anchor string, in texts laid end to end: (first window, windows, whether the
    anchor string occurs more than once in it, anchor hash, hash of the run's bytes). ``ends`` are the texts' ends."""
    width = length - gram + 1
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),) + (np.zeros(0, np.uint64),) * 2
    h, h2 = PrefixHashes(data, 0), PrefixHashes(data, 1)
    at = np.arange(len(data) - gram + 1)
    grams = mix(h(at, at + gram))
    low = window_min(grams, width)
    starts = np.concatenate([[0], ends[:-1]])
    limit = np.maximum(ends - length + 1, starts)  # windows of a text: starts .. limit
    fits = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(fits, starts, 1)
    np.add.at(fits, limit, -1)
    fits = np.cumsum(fits)[:len(low)].astype(bool)
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (low[1:] != low[:-1])
    new[starts[(starts < limit) & (starts < len(new))]] = True
    first = np.flatnonzero(new)
    stop = np.minimum(np.append(first[1:], len(data))[:len(first)], limit[np.searchsorted(ends, first, side="right")])
    parts = -(-(stop - first) // LONGEST)  # periodic text has one anchor string throughout
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first, stop = np.repeat(first, parts) + inner * LONGEST, np.repeat(stop, parts)
    stop = np.minimum(stop, first + LONGEST)
    offset = np.concatenate([np.zeros(0, np.int64), *(
        (grams[f[:, None] + np.arange(width)] == low[f][:, None]).argmax(axis=1) for f in np.split(first, range(4096, len(first), 4096)))])
    # Does the anchor string occur again inside the run? Only then can its own windows repeat.
    edge = np.zeros(width - 1, np.uint64)
    anchors = np.flatnonzero(grams == ~window_min(~np.concatenate([edge, low, edge]), width))
    order = np.lexsort((anchors, grams[anchors]))
    again = np.full(len(anchors), len(data))
    same = np.flatnonzero(grams[anchors[order]][1:] == grams[anchors[order]][:-1])
    again[order[same]] = anchors[order[same + 1]]
    twice = again[np.searchsorted(anchors, first + offset)] < stop + width - 1
    count = stop - first
    whole = mix(h2(first, stop + length - 1) + count.astype(np.uint64) * np.uint64(BASES[0]) + offset.astype(np.uint64) * np.uint64(BASES[1]))
    return first, count, twice, low[first], whole


def pieces(texts: list[bytes]):
    """(row index, offset in its text, bytes) in groups of about ``PIECE`` bytes."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - LENGTH + 1), PIECE):
            part = t[lo:lo + PIECE + LENGTH - 1]
            if size and size + len(part) > PIECE + LENGTH:
                yield group
                group, size = [], 0
            group.append((i, lo, part))
            size += len(part)
    if group:
        yield group


def common_extension(h: PrefixHashes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the suffixes at a and b share, up to ``length``: binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), length, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) // 2
        same = h(a, a + mid) == h(b, b + mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)


def suffix_sort(data: np.ndarray, at: np.ndarray, cls: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sort suffixes ``at`` within their classes by their first ``length`` bytes.

    Returns the order and, for each place, whether the suffix equals the one before it in its class. Bottom-up merge
    sort of all classes at once: a suffix's place in the sibling run is found by binary search whose comparisons
    cost the logarithm of ``length``. ``data`` must reach ``length`` bytes beyond every suffix.
    """
    h = PrefixHashes(data)
    order = np.argsort(cls, kind="stable")
    at, cls = at[order], cls[order]
    start = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]]) if len(cls) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(cls)])
    base, total = np.repeat(start, size), np.repeat(size, size)  # class of each place
    padded = np.append(data, np.uint8(0))
    step = 1
    while step < (size.max() if len(size) else 0):
        move = np.flatnonzero(total > step)  # classes that are not sorted yet
        rel = move - base[move]
        block = rel // step
        right = block % 2 == 1
        sib_lo = base[move] + np.where(right, block - 1, block + 1) * step
        end = base[move] + total[move]
        sib_hi = np.minimum(sib_lo + step, end)
        lo, hi = np.minimum(sib_lo, end), np.maximum(sib_hi, np.minimum(sib_lo, end))
        first = lo.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            a, b = at[move[open_]], at[mid]
            ext = common_extension(h, a, b, length)
            tie = ext >= length
            x, y = padded[a + np.minimum(ext, length - 1)], padded[b + np.minimum(ext, length - 1)]
            # Equal suffixes of the left run come before those of the right one.
            after = np.where(tie, right[open_], y < x)
            lo[open_] = np.where(after, mid + 1, lo[open_])
            hi[open_] = np.where(after, hi[open_], mid)
        own = rel % step
        pair = base[move] + (block // 2) * 2 * step
        to = pair + own + (lo - first)
        new_at, new_order = at.copy(), order.copy()
        new_at[to], new_order[to] = at[move], order[move]
        at, order = new_at, new_order
        step *= 2
    equal = np.zeros(len(at), dtype=bool)
    near = np.flatnonzero(np.r_[False, cls[1:] == cls[:-1]]) if len(cls) else np.zeros(0, np.int64)
    near = near[h(at[near], at[near] + length) == h(at[near - 1], at[near - 1] + length)]
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    for lo in range(0, len(near), 1 << 14):  # collisions are settled by the bytes themselves
        part = near[lo:lo + (1 << 14)]
        equal[part] = (view[at[part]] == view[at[part - 1]]).all(axis=1)
    return order, equal


def repeated_windows(kh: np.ndarray, segments: list[bytes], count: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """For runs (distinct within an anchor string): (run index, window in the run) of windows that another run, or
    another place of the same run, has. Windows can only be equal if their anchor lies equally far in."""
    data = np.frombuffer(b"".join(segments), dtype=np.uint8)
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(segments)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = np.arange(len(data) - gram + 1)
    anchors = np.flatnonzero(mix(PrefixHashes(data)(at, at + gram)) == np.repeat(kh, sizes)[:len(at)])
    place = base[owner] + inner
    left = anchors[np.searchsorted(anchors, place)] - place
    group = np.unique(kh, return_inverse=True)[1]
    order, equal = suffix_sort(data, place, group[owner] * (length + 1) + left, length)
    twin = equal.copy()
    twin[:-1] |= equal[1:]
    hit = order[twin]
    return owner[hit], inner[hit]


def _spans(owner: np.ndarray, inner: np.ndarray):
    """Maximal runs of consecutive windows: (owner, first, last)."""
    order = np.lexsort((inner, owner))
    owner, inner = owner[order], inner[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)] if len(owner) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner))[:len(first)] - 1
    return owner[first], inner[first], inner[last]


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _find_runs(batches):
    for batch in few_rows(batches):
        rows = batch.column(0).to_numpy()
        texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
        for group in pieces(texts):
            data = np.frombuffer(b"".join(p for _, _, p in group), dtype=np.uint8)
            ends = np.cumsum([len(p) for _, _, p in group])
            first, count, twice, kh, fh = runs(data, ends[np.diff(np.r_[0, ends]) > 0])
            at = np.searchsorted(ends, first, side="right")
            row = rows[np.array([i for i, _, _ in group], dtype=np.int64)[at]]
            start = np.array([lo for _, lo, _ in group], dtype=np.int64)[at] + first - (np.r_[0, ends[:-1]])[at]
            yield pa.RecordBatch.from_arrays([_as_long(x) for x in (kh, fh, row, start, 2 * count + twice)], ["kh", "fh", "row", "start", "shape"])


RUN = "kh bigint, fh bigint, row bigint, start bigint, shape bigint"
SEGMENT = "kh bigint, many boolean, copies bigint, row bigint, start bigint, shape bigint, bytes binary"


def _cut_segments(batches):
    """Bytes of the wanted runs of each text."""
    for batch in few_rows(batches):
        out = [[] for _ in range(7)]
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            raw = text.encode()
            for w in wanted:
                part = raw[w["start"]:w["start"] + (w["shape"] >> 1) + LENGTH - 1]
                for col, v in zip(out, (w["kh"], w["many"], w["copies"], w["row"], w["start"], w["shape"], part)):
                    col.append(v)
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)],
                                         ["kh", "many", "copies", "row", "start", "shape", "bytes"])


def _sorted_groups(batches):
    """Spans (row, start, stop) of repeated windows; rows of an anchor string are consecutive."""
    held = None
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = pa.Table.from_batches([batch.slice(lo, 4096)])
            t = part if held is None else pa.concat_tables([held, part])
            kh = t.column("kh").to_numpy()
            last = int(np.searchsorted(kh, kh[-1])) if len(kh) else 0
            held = t.slice(last)
            if last:
                yield _sort_table(t.slice(0, last))
    if held is not None and held.num_rows:
        yield _sort_table(held)


def _sort_table(t: pa.Table) -> pa.RecordBatch:
    shape = t.column("shape").to_numpy()
    owner, inner = repeated_windows(t.column("kh").to_numpy().view(np.uint64), t.column("bytes").to_pylist(), shape >> 1)
    owner, first, last = _spans(owner, inner)
    once = t.column("copies").to_numpy()[owner] == 1  # whole repeats have their spans already
    owner, first, last = owner[once], first[once], last[once]
    row, start = t.column("row").to_numpy()[owner], t.column("start").to_numpy()[owner]
    return pa.RecordBatch.from_arrays([_as_long(x) for x in (row, start + first, start + last + LENGTH)], ["row", "start", "stop"])


def _each_window(batches):
    """Every window of the runs of very large groups, with two independent hashes."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            t = batch.slice(lo, 2048)
            segments = t.column("bytes").to_pylist()
            data = np.frombuffer(b"".join(segments), dtype=np.uint8)
            base = np.concatenate([[0], np.cumsum([len(s) for s in segments])[:-1]]).astype(np.int64)
            count = t.column("shape").to_numpy() >> 1
            owner = np.repeat(np.arange(len(segments)), count)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            at = base[owner] + inner
            a, b = (mix(PrefixHashes(data, i)(at, at + LENGTH)) for i in (0, 1))
            cols = (a, b, t.column("row").to_numpy()[owner], t.column("start").to_numpy()[owner] + inner, t.column("copies").to_numpy()[owner])
            yield pa.RecordBatch.from_arrays([_as_long(x) for x in cols], ["a", "b", "row", "start", "copies"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Spans (row, start, stop) in bytes that cover all repeated windows; they may touch and overlap.

    ``texts`` has row (unique) and text. A text shorter than a window has none.
    """
    found = texts.select("row", "text").mapInArrow(_find_runs, RUN)
    twice = (F.col("shape") % 2).cast("bigint")
    often = found.groupBy("kh").agg(F.sum(1 + twice).alias("n")).where("n > 1").select("kh")
    known = cut(found.join(often, "kh", "left_semi"))
    distinct = known.groupBy("kh", "fh").agg(F.count("*").alias("copies"), F.min(F.struct("row", "start", "shape")).alias("first"))
    differ = (distinct.groupBy("kh").agg(F.count("*").alias("kinds"), F.max(F.when(F.col("copies") == 1, F.col("first.shape") % 2)).alias("twice"))
              .where("kinds > 1 OR twice = 1").select("kh", "kinds"))
    whole = (known.join(distinct.where("copies > 1").select("kh", "fh"), ["kh", "fh"], "left_semi")
             .select("row", "start", (F.col("start") + F.shiftright("shape", 1) + LENGTH - 1).alias("stop")))
    wanted = (distinct.join(differ, "kh").select("kh", (F.col("kinds") > GROUP).alias("many"), "copies", "first.*")
              .groupBy(F.col("row").alias("of")).agg(F.collect_list(F.struct("kh", "many", "copies", "row", "start", "shape")).alias("wanted")))
    segments = texts.join(wanted, F.col("row") == F.col("of")).drop("of").mapInArrow(_cut_segments, SEGMENT)
    few = segments.where("NOT many").repartition("kh").sortWithinPartitions("kh").mapInArrow(_sorted_groups, "row bigint, start bigint, stop bigint")
    windows = segments.where("many").mapInArrow(_each_window, "a bigint, b bigint, row bigint, start bigint, copies bigint")
    repeated = windows.groupBy("a", "b").agg(F.sum("copies").alias("n")).where("n > 1").select("a", "b")
    single = (windows.where("copies = 1").join(repeated, ["a", "b"], "left_semi")
              .select("row", "start", (F.col("start") + LENGTH).alias("stop")))
    return whole.unionByName(few).unionByName(single)


def removed(starts, stops) -> list[tuple[int, int]]:
    """Maximal removed runs from spans in any order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, stops)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in gone:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _with_spans(texts: DataFrame) -> DataFrame:
    """``texts`` (row, text, ...) with the lists starts and stops of its spans (null where it has none)."""
    spans = repeated_spans(texts).groupBy(F.col("row").alias("of")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    return texts.join(spans, F.col("row") == F.col("of"), "left").drop("of")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, kept (the remaining bytes).

    A null text counts as empty. Null ids and repeated rows are kept as rows of their own, so a repeated row's
    text repeats. Strings are judged on the input texts; matches never cross rows.
    """
    rows = _with_spans(with_row_id(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "row"))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_kept

    def run(batches):
        for batch in few_rows(batches):
            out = [[] for _ in names]
            for text, starts, stops in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "stops"))):
                raw = (text or "").encode()
                gone = removed(starts, stops) if starts else []
                left = _kept(raw, gone)
                for col, v in zip(out, (len(raw), sum(b - a for a, b in gone), len(gone), hashlib.sha256(left).hexdigest(), left)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(v, t) for v, t in zip(out, types)]], ["id", *names])

    shape = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_kept
    return rows.mapInArrow(run, shape).withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of its texts, all columns kept.

    A character that loses part of its bytes goes with them. Rows that lose all but blanks are left out; null
    and empty texts stay as they are.
    """
    at = docs.columns.index(text_col)
    names = docs.columns
    other = [f"c{i}" for i in range(len(docs.columns))]
    texts = with_row_id(docs.toDF(*other).withColumnRenamed(other[at], "text"), "row")
    rows = _with_spans(texts)

    def run(batches):
        for batch in few_rows(batches):
            kept = []
            for text, starts, stops in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "stops"))):
                kept.append(_kept(text.encode(), removed(starts, stops)).decode("utf-8", "ignore") if starts else text)
            stay = pa.array([not s or bool(k.strip()) for s, k in zip(batch.column("starts").to_pylist(), kept)], pa.bool_())
            cols = [pa.array(kept, pa.string()) if i == at else batch.column(c) for i, c in enumerate(other)]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(stay)

    return rows.mapInArrow(run, docs.schema)
