"""Vector tables dealt into shards, and query blocks sent to every shard, for the two searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """Not null and without null or non-finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def meet(queries: DataFrame, rows: DataFrame, block: int, shard: int, least: int) -> tuple[DataFrame, int]:
    """Every block of at most about ``block`` queries with every shard of about ``shard`` rows, and their number.

    Both sides have (row, vec, ...) and get is_query, block, shard and place, the pair's number; rows go once to each query block, queries once
    to each shard, so no pair of rows is ever a row. At least ``least`` shards are made.
    """
    shards, blocks = max(least, -(-rows.count() // shard)), max(1, -(-queries.count() // block))
    to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.withColumn("is_query", F.lit(True)).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("shard", to(shards))
    r = rows.withColumn("is_query", F.lit(False)).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).withColumn("block", to(blocks))
    met = q.unionByName(r, allowMissingColumns=True)
    return met.withColumn("place", F.col("block").cast("bigint") * shards + F.col("shard")), shards * blocks


def search_groups(parts: DataFrame, groups: int, schema: str, build, search) -> DataFrame:
    """Run ``search(build(rows), queries)`` for each (dims, block, shard) of ``meet``.

    A group's rows arrive before its queries; they are gathered (a shard is bounded) and indexed once, and the
    queries stream past in batches. ``search`` returns a table of ``schema``.
    """
    key = ["dims", "block", "shard"]

    def run(batches):
        at, rows, index = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in key)))
            query = batch.column("is_query").to_pylist()
            lo = 0
            for hi in range(1, len(keys) + 1):
                if hi < len(keys) and keys[hi] == keys[lo] and query[hi] == query[lo]:
                    continue
                part = batch.slice(lo, hi - lo)
                if keys[lo] != at:
                    at, rows, index = keys[lo], [], None
                if not query[lo]:
                    rows.append(part)
                elif rows or index is not None:
                    if index is None:
                        index, rows = build(pa.Table.from_batches(rows)), []
                    yield from search(index, pa.Table.from_batches([part])).to_batches()
                lo = hi

    tasks = min(groups, 20_000)  # dealt by number: no two groups share a task while there are tasks enough
    dealt = parts.withColumn("place", F.pmod("place", F.lit(tasks)).cast("int")).repartitionById(tasks, F.col("place"))
    return dealt.sortWithinPartitions(*key, "is_query").mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """A list column whose lists are equally long, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)
