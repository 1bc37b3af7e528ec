"""Packing of tokenised documents by minimum bin slack.

Documents are tokenised in tasks; every full window of a long one is a sequence of its own, so what is left to pack
is one remainder per document, shorter than a window. The packing is planned once on the histogram of the remainders'
lengths: the longest length left opens a window, and a subset-sum dynamic program over bitsets (bit ``s`` is set if
some multiset of the remaining lengths, as often as they are left, sums to ``s``) finds the multiset that fills the
window closest to its capacity; its counts are read back from the bitsets. A multiset is used for as many windows as
the lengths allow, so the plan's size depends on the window alone, not on the documents.

Where no multiset fills a window, pieces of the longest length are cut at the powers of two of their length and the
DP is asked again: tokenising has noted a checksum for each such part, so no text is read twice. The last tokens that
fill no window are cut alike and laid out in sequences of power-of-two length, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, few_rows, give_back, with_row_id
from .text_ids import TextIds

SENT_RUNS = 200_000  # runs of a plan (72 bytes each) that are sent to every task
PART_BITS = 33  # monotonically_increasing_id: partition number above, place in it below


def halves(length: int) -> list[tuple[int, int]]:
    """(start, length) of the parts a piece may be cut into: the powers of two of its length, longest first."""
    out, at = [], 0
    for bit in range(length.bit_length() - 1, -1, -1):
        if length >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pieces(docs: DataFrame, tokenizer_file: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text", rank_file: str | None = None) -> DataFrame:
    """Tokenise each document, append ``end_id`` and cut it into full windows and one shorter remainder.

    Rows: id, doc_tokens, start, length, ids_crc32, parts (the remainder's checksums at ``halves``; null for full
    windows). A null text is empty: a remainder that holds ``end_id`` alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        ids_of = TextIds(tokenizer_file, rank_file)
        for batch in few_rows(batches, 500):
            row, tokens, start, length, crc, parts = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(ids_of.of(text or ""), np.array([end_id], "<u4")).astype("<u4")
                raw = memoryview(ids.tobytes())
                for at in range(0, len(ids), size):
                    n = min(size, len(ids) - at)
                    row.append(i)
                    tokens.append(len(ids))
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * at:4 * (at + n)]))
                    parts.append(None if n == size else [zlib.crc32(raw[4 * (at + a):4 * (at + a + k)]) for a, k in halves(n)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(tokens, pa.int64()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                ["id", "doc_tokens", "start", "length", "ids_crc32", "parts"])
        del ids_of  # workers outlive the task
        give_back()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, doc_tokens bigint, start bigint, length bigint, ids_crc32 bigint, parts array<bigint>")


def best_fill(left: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, each at most as often as it is left, whose sum is closest to ``capacity`` and not above.

    Bitset DP over the lengths, longest first; it stops at the first length that makes the sum exact, so short lengths
    are kept for later. Backtracking takes each length as seldom as the sum allows.
    """
    mask = (1 << capacity + 1) - 1
    reach, steps = [1], []
    for length in sorted((n for n, k in left.items() if k and n <= capacity), reverse=True):
        bits, rest, chunk = reach[-1], min(left[length], capacity // length), 1
        while rest:
            take = min(chunk, rest)
            bits |= bits << take * length & mask
            rest, chunk = rest - take, 2 * chunk
        steps.append(length)
        reach.append(bits)
        if bits >> capacity & 1:
            break
    at, used = reach[-1].bit_length() - 1, {}
    for length, before in zip(reversed(steps), reversed(reach[:-1])):
        k = 0
        while not before >> at & 1:
            at, k = at - length, k + 1
        if k:
            used[length] = k
    return used


class Plan:
    """Pieces left to place, by length, and the runs placed so far.

    A run is (origin length, inner start, length, first rank, n, first sequence, pieces a sequence, phase, offset of the
    first in its sequence): of the pieces with that origin length and ranks first, first + 1, ... the part at inner start
    is the (phase + 0)th, (phase + 1)th, ... of the run's pieces, so many to a sequence.
    """

    def __init__(self, counts: dict[int, int], size: int):
        self.size, self.sequences, self.runs = size, 0, []
        self.left = defaultdict(int, {n: k for n, k in counts.items() if k})
        self.stock = defaultdict(deque)  # length -> (origin, inner start, first rank, n)
        for n, k in self.left.items():
            self.stock[n].append((n, 0, 0, k))

    def take(self, length: int, n: int):
        """``n`` pieces of a length, as runs of their stock."""
        self.left[length] -= n
        while n:
            origin, inner, first, k = self.stock[length].popleft()
            got = min(k, n)
            if k > got:
                self.stock[length].appendleft((origin, inner, first + got, k - got))
            yield origin, inner, first, got
            n -= got

    def fill(self, used: dict[int, int], windows: int) -> None:
        """So many sequences with the same lengths in each."""
        base = 0
        for length in sorted(used, reverse=True):
            each, phase = used[length], 0
            for origin, inner, first, n in self.take(length, each * windows):
                self.runs.append((origin, inner, length, first, n, self.sequences, each, phase, base))
                phase += n
            base += each * length
        self.sequences += windows

    def split(self, length: int, n: int) -> None:
        """Cut ``n`` pieces of a length at its powers of two."""
        for origin, inner, first, k in list(self.take(length, n)):
            for at, part in halves(length):
                self.stock[part].append((origin, inner + at, first, k))
                self.left[part] += k

    def lengths(self) -> list[int]:
        return sorted((n for n, k in self.left.items() if k), reverse=True)


def plan(counts: dict[int, int], size: int) -> tuple[list[tuple[int, ...]], int]:
    """(runs, number of sequences) for a histogram length -> pieces, lengths under ``size``."""
    p = Plan(counts, size)
    while sum(n * k for n, k in p.left.items()) >= size:
        longest = p.lengths()[0]
        p.left[longest] -= 1
        used = best_fill(p.left, size - longest)
        p.left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        if sum(n * k for n, k in used.items()) == size:
            p.fill(used, min(p.left[n] // k for n, k in used.items()))
        else:  # powers of two always fill a window, so a length that is none is left
            uneven = next(n for n in p.lengths() if n & (n - 1))
            p.split(uneven, max(1, p.left[uneven] // 8))
    rest = sum(n * k for n, k in p.left.items())
    if rest & (rest - 1):
        for n in p.lengths():
            if n & (n - 1):
                p.split(n, p.left[n])
    for _, room in halves(rest):
        used = defaultdict(int)
        for n in p.lengths():
            used[n] = min(p.left[n], room // n)
            room -= used[n] * n
        p.fill({n: k for n, k in used.items() if k}, 1)
    return p.runs, p.sequences


def pack(parts: DataFrame, size: int = 1024) -> DataFrame:
    """Place the rows of ``pieces``: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``parts`` is cut into the shared folder first: its histogram and its rows are both needed. A remainder's rank among
    those of its length is its rank in its stored partition plus the counts of the partitions before.
    """
    spark = parts.sparkSession
    parts = with_row_id(cut(parts), "row").withColumn("in", F.shiftright("row", PART_BITS))
    short = parts.where(F.col("length") < size)
    per = cut(short.groupBy("length", "in").count())
    before = per.select(F.col("length").alias("of"), F.col("in").alias("at"), F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # under `size` rows
    runs, sequences = plan(counts, size)
    names = ["origin", "inner", "long", "first", "n", "sequence", "each", "phase", "base"]
    placed = spark.createDataFrame(runs, ", ".join(f"{c} bigint" for c in names))
    # Which of the checksums at `halves` a part has: the powers of two before its inner start are counted.
    index = placed.withColumn("part", F.when(F.col("long") < F.col("origin"), F.bit_count("inner") + 1))
    runs_of = index.groupBy(F.col("origin").alias("size_of")).agg(F.collect_list(F.struct("inner", "long", "first", "n", "sequence", "each", "phase", "base", "part")).alias("runs"))
    ranked = (short.withColumn("rank", F.row_number().over(Window.partitionBy("length", "in").orderBy("row")) - 1)
              .join(before, (F.col("length") == F.col("of")) & (F.col("in") == F.col("at")))
              .withColumn("rank", F.col("rank") + F.col("before")))
    # The plan's size follows the window, not the documents; a plan too large to send meets the rows by length.
    met = ranked.join(F.broadcast(runs_of) if len(runs) <= SENT_RUNS else runs_of, F.col("length") == F.col("size_of"))
    mine = F.filter("runs", lambda r: (F.col("rank") >= r["first"]) & (F.col("rank") < r["first"] + r["n"]))
    met = met.withColumn("run", F.explode(mine)).withColumn("i", F.col("rank") - F.col("run.first") + F.col("run.phase"))
    short = met.select(
        "id", (F.col("start") + F.col("run.inner")).alias("start"), F.col("run.long").alias("length"),
        F.coalesce(F.element_at("parts", F.col("run.part").cast("int")), F.col("ids_crc32")).alias("ids_crc32"), "doc_tokens",
        (F.col("run.sequence") + F.floor(F.col("i") / F.col("run.each"))).cast("bigint").alias("sequence_id"),
        (F.col("run.base") + (F.col("i") % F.col("run.each")) * F.col("run.long")).cast("bigint").alias("offset"))
    full = parts.where(F.col("length") == size).select(
        "id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") + F.lit(sequences)).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    return full.unionByName(short)


def pack_documents(docs: DataFrame, tokenizer_file: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", rank_file: str | None = None) -> DataFrame:
    """Tokenise and pack; one row per piece. ``size`` is a power of two.

    Null texts are packed as their end id alone, null ids and repeated rows like any other; documents of equal length
    are placed in the order they are stored in. No documents give no rows. Other columns are not read.
    """
    return pack(pieces(docs, tokenizer_file, size, end_id, id_col, text_col, rank_file), size).withColumnRenamed("id", id_col)
