"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at few differing bits.

Two fingerprints that differ in at most ``max_bits`` of 64 bits agree wholly on some ``blocks - max_bits`` of
``blocks`` blocks, so every link lies inside a bucket of fingerprints with one masked pattern. A bucket's
fingerprints are sorted by Gray rank into a hierarchical index whose upper nodes hold the bits that all members
share; whole groups are pruned by the differences gathered on the way down. Tasks return a spanning forest
of what they linked, never pairs within a group; the forests join into components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, few_rows, fresh, with_row_id
from .token_count import slices

SEED = 42
FANOUT = 16
CHUNK = 4096  # fingerprints of one bucket that meet in one task; larger buckets go as pairs of chunks


def fingerprints(texts: list[str | None], shingle: int = 3) -> np.ndarray:
    """Fingerprints (unsigned) of whole texts: bit i is set if set in over half of the shingles' XXH64.

    A-Z is lower-cased, words are runs without blanks (space, tab to carriage return). Fewer than ``shingle``
    words make one shingle; no words (and null) give zero.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float32)
    for a, b in slices([len(t or "") for t in texts], 1 << 20):
        for lo in range(a, b, 256):
            block = texts[lo:min(lo + 256, b)]
            hashes, n = [], []
            for t in block:
                words = t.encode().lower().split() if t else []
                parts = list(zip(*(words[i:] for i in range(shingle)))) or ([words] if words else [])
                n.append(len(parts))
                hashes.extend([digest(p, SEED) for p in map(b" ".join, parts)])
            count = np.array(n, dtype=np.int64)
            byte = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            owner = np.repeat(np.arange(len(block)), count)
            slot = (owner[:, None] * 8 + np.arange(8)) * 256 + byte
            seen = np.bincount(slot.ravel(), minlength=len(block) * 2048).reshape(-1, 256).astype(np.float32)
            on = (seen @ bits).reshape(len(block), 64) * 2 > count[:, None]
            out[lo:lo + len(block)] = np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code word in the reflected Gray order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """Fingerprints in Gray order under nodes that hold the bits shared by all members below.

    ``levels[0]`` are the fingerprints; a node of a higher level covers ``FANOUT`` nodes of the one below and
    keeps the mask and pattern of the bits on which all agree, without those its own parent already holds.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        full = np.full(len(codes), ~np.uint64(0))
        levels = [(full, self.codes)]
        while len(levels[-1][0]) > FANOUT:
            mask, pattern = levels[-1]
            starts = np.arange(0, len(mask), FANOUT)
            head = np.repeat(pattern[starts], np.diff(np.r_[starts, len(mask)]))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ head), starts)
            levels.append((shared, pattern[starts] & shared))
        own = []
        for i, (mask, pattern) in enumerate(levels):
            above = np.uint64(0) if i + 1 == len(levels) else np.repeat(levels[i + 1][0], FANOUT)[:len(mask)]
            own.append((mask & ~above, pattern))
        self.levels = own

    def within(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) index pairs that differ in at most ``limit`` bits."""
        top = len(self.levels[-1][0])
        q = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        gathered = np.zeros(len(q), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[level]
            gathered = gathered + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = gathered <= limit
            q, node, gathered = q[near], node[near], gathered[near]
            if level:
                below = len(self.levels[level - 1][0])
                q, gathered = np.repeat(q, FANOUT), np.repeat(gathered, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                inside = node < below
                q, node, gathered = q[inside], node[inside], gathered[inside]
        return q, node


def settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least label reachable over links (a, b), by repeated minima and jumps."""
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = np.minimum(label, label[label])
        if (label == before).all():
            return label


def local_links(codes: np.ndarray, group: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (code, code) of the distinct codes of each group; rows of a group are consecutive."""
    n = len(codes)
    label = np.arange(n)
    size = np.bincount(group)[group] if n else np.zeros(0, dtype=np.int64)
    small = np.flatnonzero(size <= FANOUT)
    a, b = [], []
    for s in range(1, FANOUT):  # small groups: shifted comparison of all groups at once
        i, j = small[:-s], small[s:]
        hit = (group[i] == group[j]) & (np.bitwise_count(codes[i] ^ codes[j]) <= limit)
        a.append(i[hit])
        b.append(j[hit])
    label = settle(label, np.concatenate(a), np.concatenate(b)) if n else label
    for g in np.unique(group[size > FANOUT]):
        at = np.flatnonzero(group == g) if len(small) else np.arange(np.searchsorted(group, g), np.searchsorted(group, g, "right"))
        index = GrayIndex(codes[at])
        own = np.arange(len(at))
        for lo in range(0, len(at), 256):
            q, m = index.within(index.codes[lo:lo + 256], limit)
            own = settle(own, q + lo, m)
        order = np.argsort(gray_rank(codes[at]), kind="stable")
        label[at[order]] = at[order][own]
    far = label != np.arange(n)
    return codes[far], codes[label[far]]


def links(codes: DataFrame, max_bits: int = 3, blocks: int = 4) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) at most ``max_bits`` apart.

    More ``blocks`` make more, finer buckets: choose 6 or 7 for billions of fingerprints.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - max_bits):
        m = sum(((1 << (cuts[c + 1] - cuts[c])) - 1) << cuts[c] for c in chosen)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    keyed = codes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
                                                   for i, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.v")
    sizes = keyed.groupBy("t", "v").count().where("count > 1")
    n = F.ceil(F.col("count") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), n).cast("int")
    # A large bucket goes as pairs of chunks, each fingerprint to the pairs that its chunk is in.
    sent = (keyed.join(sizes, ["t", "v"]).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .select("fp", "t", "v", F.least("mine", "other").alias("c"), F.greatest("mine", "other").alias("d")))

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = [t.column(c).to_numpy() for c in ("t", "v", "c", "d")]
            new = np.zeros(t.num_rows, dtype=bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0
            group = np.cumsum(new)
            held = t.slice(last)
            if last:
                yield _linked(t.column("fp").to_numpy()[:last], group[:last], max_bits)
        if held is not None and held.num_rows:
            yield _linked(held.column("fp").to_numpy(), np.zeros(held.num_rows, dtype=np.int64), max_bits)

    key = ["t", "v", "c", "d"]
    return sent.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a bigint, b bigint").distinct()


def _linked(fp: np.ndarray, group: np.ndarray, limit: int) -> pa.RecordBatch:
    a, b = local_links(fp.view(np.uint64) if fp.dtype == np.int64 else fp.astype(np.int64).view(np.uint64), group, limit)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64), pa.int64()), pa.array(b.view(np.int64), pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, blocks: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", carry: list | None = None) -> DataFrame:
    """One row per input row: id, (columns ``carry``), fp, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id that is reachable over links (null only if all ids there are null).
    Null and empty texts share fingerprint zero and so one component. Repeated rows stay.
    """
    extra = carry or []
    rows = docs.select(F.col(id_col).alias("id"), *extra, F.col(text_col).alias("text"))
    names = rows.columns[:-1]
    shape = rows.select(*names).schema.add("fp", "long")

    def run(batches):
        for batch in few_rows(batches):
            fp = fingerprints(batch.column(len(names)).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp, pa.int64())], names=[*names, "fp"])

    found = cut(rows.mapInArrow(run, shape))
    codes = cut(found.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(codes.select("fp"), max_bits, blocks))
    rooted = codes.join(roots, codes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_code = rooted.join(least, "root").select("fp", "component_id", "root")
    return (found.join(of_code, "fp")
            .select(*[c for c in names], "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")
            .withColumnRenamed("id", id_col))


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id (nulls last), all columns."""
    rid = fresh(docs, "row_in_docs")
    rows = with_row_id(docs, rid)
    found = near_duplicates(rows, shingle, max_bits, id_col=id_col, text_col=text_col, carry=[F.col(rid).alias("row")])
    first = F.min(F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("row").alias("r")))
    stay = found.groupBy("root").agg(first.alias("f")).select(F.col("f.r").alias(rid))
    return rows.join(stay, rid, "left_semi").select(*docs.columns)
