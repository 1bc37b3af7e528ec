"""Helpers shared by the operators: shared folder, stable row ids, columns, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def ensure_shared(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable: the cluster's ``spark.checkpoint.dir``, else (local master only) a scratch folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="fabline-llm-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there (survives lost executors)."""
    ensure_shared(df.sparkSession)
    return df.checkpoint(eager=True)


def _cut_plain(df: DataFrame) -> DataFrame:
    """``cut`` without the size estimate of ``df``'s plan. A checkpoint keeps that estimate, and joins multiply it, so in
    a loop of joins it doubles its digits each time until planning stands still."""
    stored = cut(df)
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(stored._jdf.toJavaRDD(), stored._jdf.schema()), spark)


def stored(df: DataFrame) -> DataFrame:
    """``cut`` as a parquet table in the shared checkpoint folder: compressed, for wide or long tables."""
    spark = df.sparkSession
    ensure_shared(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (column names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Number the rows by (input partition, place in it).

    The numbers are the same each time the plan runs as long as ``df`` is a stored table (its splits
    depend on the files and settings alone); derived frames must be written or cut first.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def few_rows(batches, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so a task holds few whole texts as Python objects at once.

    Workers serve many tasks: memory that a task has freed goes back to the system at its end.
    """
    try:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                yield batch.slice(lo, rows)
    finally:
        give_back()


def give_back() -> None:
    """Memory that a task has freed goes back to the system; the worker lives on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ascii_lower(col):
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node reachable.

    Each round every node picks its smallest neighbour, whatever its own number. Only two nodes that pick each other
    form a ring (by the order of links as (smaller, larger), no longer ring can close), so the picks are trees of two
    nodes at least; pointer jumping brings each to its root and the links between roots are the next round's. A round
    at least halves the nodes that have links, however they are numbered, so there are at most log2(nodes) rounds,
    each over fewer links. All are joins and partial minima on tables cut into the shared folder, so neither a
    component nor a hub's links ever meet in one task.
    """
    both = _cut_plain(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .where("a <> b").distinct())
    rounds = []
    while not rounds or not both.isEmpty():
        up = _roots(_cut_plain(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))))
        rounds.append(up)
        both = _cut_plain(both.join(up.select(F.col("node").alias("a"), F.col("up").alias("c")), "a")
                   .join(up.select(F.col("node").alias("b"), F.col("up").alias("d")), "b")
                   .where("c <> d").select(F.col("c").alias("a"), F.col("d").alias("b")).distinct())
    labels = rounds.pop()
    while rounds:  # a root that has no links left in the next round stays
        last = labels.select(F.col("node").alias("up"), F.col("up").alias("top"))
        labels = _cut_plain(rounds.pop().join(last, "up", "left").select("node", F.coalesce("top", "up").alias("up")))
    least = labels.groupBy("up").agg(F.min("node").alias("root"))
    return _cut_plain(labels.join(least, "up").select("node", "root"))


def _roots(up: DataFrame) -> DataFrame:
    """(node, up) with ``up`` the tree's root: of two nodes that point at each other the smaller one."""
    while True:
        over = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        after = _cut_plain(up.join(over, "up").select(
            "node", F.when(F.col("top") == F.col("node"), F.least("node", "up")).otherwise(F.col("top")).alias("up"), F.col("up").alias("old")))
        up = after.select("node", "up")
        if after.where("up <> old").isEmpty():
            return up
