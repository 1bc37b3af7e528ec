"""Best-fit decreasing packing of tokenised documents into fixed-size sequences.

Documents are tokenised in tasks and cut into pieces. All a packing needs to know of the pieces is how many
there are of each length, at most ``size`` counts, so the packing itself is planned once on that histogram:
lengths are taken in decreasing order and each goes to the tightest open bin, found in logarithmic time with
a segment tree over remaining capacities. Equal pieces are placed as runs, so the plan's size depends on
``size`` alone. Pieces then find their place by their rank among the pieces of their length, a distributed
prefix count. The result is the packing that best-fit decreasing gives for all pieces at once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, few_rows, give_back
from .text_ids import TextIds
from .token_count import slices

BUCKETS = 256


def pieces(docs: DataFrame, tokenizer_file: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text", rank_file: str | None = None) -> DataFrame:
    """Tokenise each document, append ``end_id``, and cut those longer than ``size`` into ``size``-token pieces.

    Only the first piece may be shorter. Rows: id, piece, start, length, ids_crc32. A null text is empty: one
    piece that holds ``end_id`` alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        ids_of = TextIds(tokenizer_file, rank_file)
        for batch in few_rows(batches, 500):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(list(map(len, texts)), 1 << 22):
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(a, b):
                    raw = ids_of.of(texts[i]).tobytes() + tail
                    n = len(raw) // 4
                    at, k = 0, 0
                    while at < n:
                        upto = at + ((n - at - 1) % size + 1)
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(upto - at)
                        crc.append(zlib.crc32(raw[4 * at:4 * upto]))
                        at, k = upto, k + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])
        del ids_of  # workers outlive the task
        give_back()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


class CapacityTree:
    """Segment tree over remaining capacities 0..size: finds the least capacity >= need that has an open bin."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        i = capacity + self.leaves
        while i:
            self.open[i] += bins
            i //= 2

    def tightest(self, need: int) -> int | None:
        i = need + self.leaves
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:  # the next capacities lie in the sibling on the right
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on the histogram length -> pieces.

    Returns runs (length, first rank, pieces, first bin, pieces per bin, offset of the first in its bin): the
    pieces of that length with ranks first, first + 1, ... fill bins first, first + 1, ..., so many in each.
    """
    tree = CapacityTree(size)
    bins: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> runs (first bin, bins)
    runs, next_bin = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                each = size // length
                room, first, n = size, next_bin, -(-left // each)
                next_bin += n
            else:
                first, n = bins[room].pop()
                tree.add(room, -n)
            each = room // length
            full = min(n, left // each)
            for at, count, take in ((first, full, each), (first + full, min(n - full, 1), left - full * each)):
                take = min(take, each)
                if not count or not take:
                    continue
                runs.append((length, rank, count * take, at, take, size - room))
                rank += count * take
                left -= count * take
                if rest := room - take * length:
                    bins.setdefault(rest, []).append((at, count))
                    tree.add(rest, count)
                full = max(full, at - first + count)
            if n > full:  # bins of this run that no piece needed
                bins.setdefault(room, []).append((first + full, n - full))
                tree.add(room, n - full)
    return runs


def pack(parts: DataFrame, size: int = 1024) -> DataFrame:
    """Add sequence_id and offset to rows of ``pieces``: best-fit decreasing over all rows, gapless from 0.

    ``parts`` is cut into the shared folder first, since its histogram and its rows are both needed.
    """
    spark = parts.sparkSession
    parts = cut(parts.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "start", "ids_crc32"), F.lit(BUCKETS)).cast("int")))
    # Rank among the pieces of a length: rank within (length, bucket) plus the buckets before.
    per = parts.groupBy("length", "bucket").count()
    before = per.select("length", "bucket", (F.sum("count").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `size` rows
    runs = spark.createDataFrame(plan(counts, size), "length bigint, first bigint, n bigint, bin bigint, each bigint, base bigint")
    ranked = (parts.withColumn("place", F.row_number().over(
        Window.partitionBy("length", "bucket").orderBy("id", "piece", "start", "ids_crc32")) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("place") + F.coalesce("before", F.lit(0))))
    # Runs of a length cover its ranks without gaps: find a row's run by range.
    by_length = runs.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "n", "bin", "each", "base"))).alias("runs"))
    run = F.filter("runs", lambda r: (F.col("rank") >= r["first"]) & (F.col("rank") < r["first"] + r["n"]))[0]
    return (ranked.join(by_length, "length").withColumn("run", run)
            .withColumn("i", F.col("rank") - F.col("run.first"))
            .select("id", "piece", "start", "length", "ids_crc32",
                    (F.col("run.bin") + F.floor(F.col("i") / F.col("run.each"))).cast("bigint").alias("sequence_id"),
                    (F.col("run.base") + (F.col("i") % F.col("run.each")) * F.col("length")).cast("bigint").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_file: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", rank_file: str | None = None) -> DataFrame:
    """Tokenise, cut and pack; one row per piece. Null ids and repeated rows are packed like any other."""
    return pack(pieces(docs, tokenizer_file, size, end_id, id_col, text_col, rank_file), size).withColumnRenamed("id", id_col)
