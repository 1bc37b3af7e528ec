"""Substring dedup on paragraphs: MinHash banding, exact Jaccard, components.

Paragraphs are of two kinds. Lines of ``SHINGLE`` words or more are compared by their five-word shingles: bands tuned
for high recall bring likely pairs together, the exact Jaccard similarity decides, and components form the classes.
Shorter lines have no shingle and form a class when their words are equal.
Passages that sit inside longer text have no line of their own; for them every text also yields blocks of ``LEAST``
words that begin at content-chosen places (the smallest shingle hash of any ``WINDOW`` in a row), so any run of
``WINDOW + LEAST - 1`` = 24 words has a whole block in every text that holds it. Blocks form a class when they are equal.
Two passages of 49 words or more at a Jaccard similarity of 0.8 share such a run: of m shingles each misses at most m / 9,
a break costs four at least, so the longest of the runs left holds 20 shingles; near copies inside longer text are found too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, few_rows, stored, with_row_id
from .simhash import settle
from .suffix import PrefixHashes, _powers, mix, window_min
from .token_count import slices

SHINGLE = 5
LEAST = 16
WINDOW = 9
BANDS, ROWS = 6, 2  # 1 - (1 - 0.8 ** 2) ** 6 = 0.998 of pairs at similarity 0.8 meet
SIMILAR = 0.8
COLUMNS = 4096  # shingles of one bucket compared at once
HOT, SALTS = 200, 32  # a key of over 1 / HOT of the rows (so fewer than HOT keys) is dealt to SALTS parts
CHUNK = 256  # lines of one bucket that meet in one task; larger buckets go as pairs of chunks
BASE = np.uint64(0x9E3779B97F4A7C15)
FACTORS = np.random.default_rng(77).integers(0, 1 << 63, (BANDS * ROWS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Blanks and the lower case of A-Z, by byte.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PIECE = 1 << 20


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words data[start:end], a bounded stretch of text at a time."""
    out = [np.zeros(0, np.uint64)]
    for lo in range(0, len(data), PIECE):
        a, b = np.searchsorted(start, [lo, lo + PIECE])
        if a < b:
            h = PrefixHashes(data[start[a]:end[b - 1]])
            out.append(mix(h(start[a:b] - start[a], end[a:b] - start[a])))
    return np.concatenate(out)


class Words:
    """The words of some texts end to end: value hashes, text and line ends, hashes of any stretch."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() + b"\n" for t in texts]
        data = LOWER[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        blank = BLANK[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))  # word starts and ends in turn
        start, end = edge[::2], edge[1::2]
        value = word_hashes(data, start, end)
        self.text_ends = np.searchsorted(start, np.cumsum([len(t) for t in raw])).astype(np.int64)
        ends = np.unique(np.searchsorted(start, np.flatnonzero(data == 10)))
        self.line_ends = ends[ends > 0].astype(np.int64)
        n = len(value)
        power, self.inverse = _powers(n + 1)[0]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n])])
        at = np.arange(max(0, n - SHINGLE + 1))
        self.grams = mix(self.hash(at, at + SHINGLE))

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.prefix[b] - self.prefix[a]) * self.inverse[a]

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.text_ends, at, side="right")

    def in_text(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, place in it) of word places."""
        text = self.text_of(at)
        return text, at - np.r_[0, self.text_ends[:-1]][text]

    def blocks(self) -> np.ndarray:
        """First words of the blocks."""
        if len(self.grams) < WINDOW:
            return np.zeros(0, np.int64)
        low = np.uint64((1 << 24) - 1)
        place = np.arange(len(self.grams), dtype=np.uint64)
        first = (window_min((self.grams & ~low) | (place & low), WINDOW) & low).astype(np.int64)
        at = np.arange(len(first))
        first += at & ~np.int64(low)
        first += np.where(first < at, int(low) + 1, 0)
        inside = self.text_of(at) == self.text_of(np.minimum(at + WINDOW + SHINGLE - 2, self.text_ends[-1] - 1))
        first = np.unique(first[inside])
        fits = first + LEAST <= self.text_ends[self.text_of(first)]
        return first[fits]

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, end) of the lines."""
        return (np.r_[0, self.line_ends[:-1]] if len(self.line_ends) else self.line_ends), self.line_ends

    def bands(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Band keys (lines, BANDS) of the lines' shingle sets; every line has a shingle."""
        if not len(start):
            return np.zeros((0, BANDS), np.uint64)
        edges = np.column_stack([start, end - SHINGLE + 1]).ravel()
        if edges[-1] == len(self.grams):
            edges = edges[:-1]
        least = [np.minimum.reduceat(mix(self.grams * a + b), edges)[::2] for a, b in FACTORS]
        return np.column_stack([mix(least[2 * i] * BASE + least[2 * i + 1]) for i in range(BANDS)])


def _groups(batch):
    rows, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
    known = [i for i, t in enumerate(texts) if t]
    for a, b in slices([len(texts[i]) for i in known], 1 << 20):
        some = known[a:b]
        yield rows[np.array(some, np.int64)], Words([texts[i] for i in some])


def _long(x):
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _paragraphs(batches):
    """Lines, with their words and bands, and blocks, without, from one pass over the texts."""
    names = ["h", "row", "start", "words", "bands"]
    for batch in few_rows(batches):
        for rows, w in _groups(batch):
            start, end = w.lines()
            text, place = w.in_text(start)
            long = end - start >= SHINGLE
            ends = np.r_[0, np.cumsum(long)] * BANDS
            keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _long(w.bands(start[long], end[long]).ravel()))
            yield pa.RecordBatch.from_arrays([_long(w.hash(start, end)), _long(rows[text]), pa.array(place, pa.int32()), pa.array(end - start, pa.int32()), keys], names)
            at = w.blocks()
            text, place = w.in_text(at)
            none = pa.nulls(len(at), pa.int32()), pa.nulls(len(at), keys.type)
            yield pa.RecordBatch.from_arrays([_long(w.hash(at, at + LEAST)), _long(rows[text]), pa.array(place, pa.int32()), *none], names)


def _line_shingles(batches):
    """The set of shingle hashes (32 bits each, sorted) of the lines at ``places`` of each text."""
    for batch in few_rows(batches):
        number = pa.array(np.arange(batch.num_rows), pa.int64())
        for some, w in _groups(pa.RecordBatch.from_arrays([number, batch.column(0)], ["at", "text"])):
            places = batch.column(1).take(pa.array(some))
            start = np.repeat(np.r_[0, w.text_ends[:-1]], places.value_lengths().to_numpy())
            start += places.flatten().field("start").to_numpy()
            end = start + places.flatten().field("words").to_numpy()
            short = (w.grams >> np.uint64(32)).astype("<u4")
            sets = [np.unique(short[a:b - SHINGLE + 1]).tobytes() for a, b in zip(start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([_long(w.hash(start, end)), pa.array(sets, pa.binary())], ["h", "shingles"])


def jaccard_links(sets: list[np.ndarray], similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) that span what exact Jaccard similarity of at least ``similar`` connects among the sets."""
    n = len(sets)
    size = np.array(list(map(len, sets)))
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = seen[code] > 1  # a shingle of one line alone is in no intersection
    order = np.argsort(code[shared], kind="stable")
    code, owner = code[shared][order], owner[shared][order]
    both = np.zeros((n, n), dtype=np.float32)
    at = np.cumsum(np.r_[0, code[1:] != code[:-1]]) if len(code) else code
    columns = int(at[-1]) + 1 if len(at) else 0
    for lo in range(0, columns, COLUMNS):
        a, b = np.searchsorted(at, [lo, lo + COLUMNS])
        table = np.zeros((n, min(COLUMNS, columns - lo)), dtype=np.float32)
        table[owner[a:b], at[a:b] - lo] = 1
        both += table @ table.T
    i, j = np.nonzero(np.triu(both >= similar * (size[:, None] + size[None, :] - both) - 1e-6, 1))
    root = settle(np.arange(n), i, j)
    far = np.flatnonzero(root != np.arange(n))
    return far, root[far]


def _verify(batches):
    """Links (a, b) between the lines of each bucket; a bucket's rows are consecutive."""
    def links(t):
        h = t.column("h").to_numpy()
        sets = [np.frombuffer(s, dtype="<u4") for s in t.column("shingles").to_pylist()]
        i, j = jaccard_links(sets)
        return pa.RecordBatch.from_arrays([pa.array(h[i], pa.int64()), pa.array(h[j], pa.int64())], ["a", "b"])

    held = None
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = pa.Table.from_batches([batch.slice(lo, 4096)])
            t = part if held is None else pa.concat_tables([held, part])
            keys = [t.column(c).to_numpy() for c in ("t", "key", "c", "d")]
            new = np.zeros(t.num_rows, dtype=bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            edges = [0, *np.flatnonzero(new).tolist()]
            for a, b in zip(edges, edges[1:]):
                yield links(t.slice(a, b - a))
            held = t.slice(edges[-1])
    if held is not None and held.num_rows:
        yield links(held)


def line_links(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """Links (a, b) of similar lines among ``lines`` (h, row, start, words, bands) of ``texts``; equal lines share h.

    Of lines that meet others the first of each h is looked up in its text; the texts go once to these places."""
    banded = lines.select("h", F.posexplode("bands").alias("t", "key"))
    met = banded.groupBy("t", "key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select("t", "key")
    found = cut(banded.join(met, ["t", "key"], "left_semi").distinct())
    member = {c: F.bit_xor(F.xxhash64("h", F.lit(i))) for i, c in enumerate("xy")}
    buckets = found.groupBy("t", "key").agg(F.count(F.lit(1)).alias("count"), *[v.alias(c) for c, v in member.items()])
    # Near copies meet in most bands: buckets of the same lines (by 128 bits) are compared once.
    once = buckets.groupBy("count", "x", "y").agg(F.min(F.struct("t", "key")).alias("b")).select("b.t", "b.key", "count")
    pairs = cut(found.join(once, ["t", "key"]))
    wanted = pairs.select("h").distinct()
    first = lines.join(wanted, "h", "left_semi").groupBy("h").agg(F.min(F.struct("row", "start", "words")).alias("p"))
    places = first.groupBy("p.row").agg(F.collect_list(F.struct("p.start", "p.words")).alias("places"))  # some of a text's lines
    sets = (texts.select("row", "text").join(places.hint("merge"), "row").select("text", "places")
            .mapInArrow(_line_shingles, "h bigint, shingles binary"))
    n = F.ceil(F.col("count") / CHUNK).cast("int")
    sent = (pairs.withColumn("mine", F.pmod(F.xxhash64("h"), n).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .select("h", "t", "key", F.least("mine", "other").alias("c"), F.greatest("mine", "other").alias("d")))
    key = ["t", "key", "c", "d"]
    return sent.join(sets, "h").repartition(*key).sortWithinPartitions(*key).mapInArrow(_verify, "a bigint, b bigint").distinct()


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], total: int, spread: str = "row") -> DataFrame:
    """``left`` joined with ``right``, one row a key with ``n``, the key's rows in ``left`` of ``total``. Keys of over
    1 / ``HOT`` of the rows, fewer than ``HOT`` and so sent to every task, are dealt by ``spread`` to several parts."""
    hot = F.col("n") > max(total // HOT, 1000)
    flags = F.broadcast(right.where(hot).select(*keys, F.lit(True).alias("__hot")))
    part = F.when(F.col("__hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    dealt = left.join(flags, keys, "left").withColumn("__part", part).drop("__hot")
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(right.withColumn("__part", F.explode(parts)).drop("n"), [*keys, "__part"]).drop("__part")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph whose class occurs more than once, in one row of ``docs`` or in several: id, kind (line or
    block), start and words (place and length in words), component (class), first_doc, removed.

    Of each class the first paragraph (by id, nulls last, then place) stays and all others count as removed. Words are
    lower-cased (A-Z) runs without blanks. Blocks of one row that overlap, as in periodic text, are no repeat of each
    other. Null and empty texts have no paragraphs; repeated rows repeat all of theirs. A text without line breaks is
    one line however long it is: its whole shingle set is compared, a bounded number of shingles at a time.
    """
    texts = with_row_id(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "row")
    only = texts.select("row", "text")
    ids = texts.select(F.col("row").alias("of"), "id")
    both = stored(only.mapInArrow(_paragraphs, "h bigint, row bigint, start int, words int, bands array<bigint>"))
    blocks, lines = both.where("words is null").select("h", "row", "start"), both.where("words is not null")
    often = cut(blocks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = (join_spread(blocks, often, ["h"], met)
             .select("row", "start", F.lit(LEAST).alias("words"), F.lit("block").alias("kind"), F.col("h").alias("component")))
    distinct = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    roots = components(line_links(texts, lines))
    classed = distinct.join(roots, distinct["h"] == roots["node"], "left").select("h", "n", F.coalesce("root", "h").alias("root"))
    spread = classed.groupBy("root").agg(F.sum("n").alias("all")).where("all > 1").select("root")
    kept = cut(classed.join(spread, "root", "left_semi").select("h", "n", F.col("root").alias("component")))
    found = stored(found.unionByName(join_spread(lines.drop("bands"), kept, ["h"], lines.count())
                                  .select("row", "start", "words", F.lit("line").alias("kind"), "component"))
                .join(ids, F.col("row") == F.col("of")).drop("of"))
    place = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("row").alias("r"), F.col("start").alias("s"))
    apart = (F.col("kind") == "line") | (F.min("row") < F.max("row")) | (F.max("start") - F.min("start") >= LEAST)
    first = (found.groupBy("kind", "component").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), apart.alias("apart"))
             .where("apart").drop("apart"))
    return join_spread(found, first, ["kind", "component"], found.count()).select(
        F.col("id").alias(id_col), "kind", "start", "words", "component", F.col("first.i").alias("first_doc"),
        (~((F.col("row") == F.col("first.r")) & (F.col("start") == F.col("first.s")))).alias("removed"))
