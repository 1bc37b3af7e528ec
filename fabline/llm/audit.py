"""What the filters of a chain take from each other, counted by incremental retraction over a stream of files.

All files of the table run through Structured Streaming as available-now micro-batches. Filters that look at one text
alone give a document a mask of failure bits. The filter that looks at the whole table (a text that a smaller id
has too) depends on rows that may still come, so a text's smallest id so far and the rows that hold it are kept as
keyed state. A micro-batch counts each of its rows under its mask as far as is known; where a smaller id arrives for
a text seen before, the rows that held the smallest one are taken back from their part's counters (negative counts)
and counted again with the bit set. After the last file the counters are what one pass over the whole table would
give, whatever the order of files and their cut into batches.

State and counter changes are tables in the shared folder, one folder a micro-batch, written over when a batch
is run again; a batch reads only folders of the batches before it. So a restarted query neither loses nor doubles a
row. Texts stay in the task that reads them; a text with a third of all copies is one row a task before any shuffle by text.

The counters have at most 32 masks a part, so all orders of the filters are evaluated on them, not on documents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, ensure_shared, few_rows

FILTERS = "ABCDE"
COPY = 16  # bit of filter E
BATCHES = 4
SPREAD = 8  # parts that a document id's rows are dealt to when they meet the labels
SYMBOLS = np.frombuffer(b"#$%&*|", np.uint8)
MEASURED = "id bigint, part string, mask int, key binary"
HELD = "key binary, id bigint, part string, good boolean, toxic boolean, mask int, n bigint"
CHANGES = "part string, mask int, good boolean, toxic boolean, n bigint"


def mask_of(raw: bytes) -> int:
    """Failure bits of filters A-D for one text in UTF-8 (bit 0 is A)."""
    words = raw.split()  # bytes: exactly the blanks \x20 and \x09-\x0D
    data = np.frombuffer(raw, np.uint8)
    points = int(((data & 0xC0) != 0x80).sum())
    upper = int(((data >= 65) & (data <= 90)).sum())
    symbol = any(bytes([s]) in raw for s in SYMBOLS)
    return (len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1 | (100 * upper > 10 * points) << 2 | symbol << 3


def measure(batches):
    """(id, part, mask, SHA-256 of the text) of rows (id, part, text); a null text is empty."""
    for batch in few_rows(batches, 2000):
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([mask_of(t) for t in texts], pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], ["id", "part", "mask", "key"])


def label_flags(labels: DataFrame) -> DataFrame:
    """(id, good, toxic) once per labelled id; of several rows any quality or toxic 1 counts. Rows without an id go."""
    return labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))


def _labelled(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """Rows with the labels of their id; an id with very many rows meets its label in ``SPREAD`` places.

    Labels grow with the documents, and Spark takes them for as small as their files and for one row an id, so it would gather
    all ``SPREAD`` in the driver and send them to every task: the join is told to shuffle both sides.
    """
    many = flags.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))).hint("merge")
    out = rows.withColumn("place", F.pmod(F.xxhash64("key", "part"), F.lit(SPREAD)).cast("int")).join(many, ["id", "place"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}).drop("place")


def settle(rows: DataFrame, held: DataFrame | None) -> DataFrame:
    """One micro-batch: its rows and the state before it give rows (HELD..., kind).

    kind ``held`` is a row of the new state (rows that hold their text's smallest id), ``change`` a change of a
    counter, negative where earlier rows are taken back. A null id is no smaller than any and none is smaller than it.
    """
    same = rows.groupBy("key", "id", "part", "good", "toxic", "mask").agg(F.count(F.lit(1)).alias("n"))
    has_id = F.col("id").isNotNull()
    known = same.groupBy("key", "part", "good", "toxic", "mask").agg(
        F.min(F.when(has_id, F.struct("id", "n"))).alias("least"), F.sum(F.when(has_id, F.col("n")).otherwise(0)).alias("total"),
        F.sum(F.when(has_id, 0).otherwise(F.col("n"))).alias("unnamed"))
    new = known.select("key", "least.id", "part", "good", "toxic", "mask", "least.n", "total", "unnamed")
    old = F.lit(None).cast("bigint")
    events = new.withColumn("fresh", F.lit(True))
    if held is not None:
        events = events.unionByName(held.withColumns({"total": F.lit(0).cast("bigint"), "unnamed": F.lit(0).cast("bigint"), "fresh": F.lit(False)}))
        old = F.min(F.when(~F.col("fresh"), F.col("id"))).over(Window.partitionBy("key"))
    events = events.withColumns({"least": F.min("id").over(Window.partitionBy("key")), "old": old})
    first = F.col("id") == F.col("least")
    late = F.col("mask").bitwiseOR(F.lit(COPY))

    def change(mask, n):
        return F.struct(F.lit("change").alias("kind"), mask.alias("mask"), n.cast("bigint").alias("n"))

    none = F.array().cast("array<struct<kind:string,mask:int,n:bigint>>")
    arrived = F.concat(
        F.when(first, F.array(F.struct(F.lit("held").alias("kind"), "mask", "n"), change(F.col("mask"), F.col("n"))))
        .when(has_id, F.array(change(late, F.col("n")))).otherwise(none),
        F.when(F.col("unnamed") > 0, F.array(change(F.col("mask"), F.col("unnamed")))).otherwise(none),
        F.when(F.col("total") > F.col("n"), F.array(change(late, F.col("total") - F.col("n")))).otherwise(none))
    taken_back = F.when((F.col("id") == F.col("old")) & (F.col("least") < F.col("old")),
                        F.array(change(F.col("mask"), -F.col("n")), change(late, F.col("n")))).otherwise(none)
    out = events.withColumn("e", F.explode(F.when(F.col("fresh"), arrived).otherwise(taken_back)))
    return out.select("key", "id", "part", "good", "toxic", "e.mask", "e.n", "e.kind")


def counters(stream: DataFrame, labels: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """Run the stream to the end of its files; (part, mask, good, toxic, n) over all rows so far.

    ``folder`` lies in the shared folder and holds the query's progress, state and changes; started again with the
    same folder the query goes on where it stopped, also with files that have come since.
    """
    spark = stream.sparkSession
    flags = cut(label_flags(labels))

    def earlier(kind: str, schema: str, batch: int, session: SparkSession) -> DataFrame | None:
        if batch == 0:
            return None
        return session.read.schema(schema).parquet(*[f"{folder}/{kind}/{b}" for b in range(batch)])

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                            F.col(text_col).alias("text")).mapInArrow(measure, MEASURED)
        out = cut(settle(_labelled(rows, flags), earlier("held", HELD, number, session)))
        out.where("kind = 'held'").drop("kind").write.mode("overwrite").parquet(f"{folder}/held/{number}")
        (out.where("kind = 'change'").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(f"{folder}/changes/{number}"))

    query = (stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    done = _last_batch(spark, f"{folder}/changes")
    if done < 0:
        return spark.createDataFrame([], CHANGES)
    changes = spark.read.schema(CHANGES).parquet(*[f"{folder}/changes/{b}" for b in range(done + 1)])
    return changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _last_batch(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return max((int(s.getPath().getName()) for s in fs.listStatus(path)), default=-1) if fs.exists(path) else -1


def orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order of the filters on counters (part, mask, good, toxic, n): a row per part, order and step.

    A step's numbers depend on its filter and the set of those before it alone, so the counters are summed once per
    part, filter and set (80 of them) and the orders only look them up. A filter removes a document first in
    ``k!/k`` of the orders of the ``k`` filters it fails, which gives the sum over all orders directly.
    """
    spark = counts.sparkSession
    size = len(filters)
    sets = [(f, before) for f in range(size) for before in range(1 << size) if not before >> f & 1]
    looks = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(b).alias("before"), F.lit(1 << f).alias("bit")) for f, b in sets])
    steps = [("".join(filters[i] for i in p), k + 1, p[k], sum(1 << i for i in p[:k])) for p in permutations(range(size)) for k in range(size)]
    # A fixed table, one row per order and step.
    each = spark.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    passed = F.col("mask").bitwiseAND(F.col("before")) == 0
    removed = fails & passed
    share = F.element_at(F.array(*[F.lit(factorial(size) // k) for k in range(1, size + 1)]), F.greatest(F.bit_count("mask"), F.lit(1)))

    def count(cond, value=None):
        return F.coalesce(F.sum(F.when(cond, F.col("n") if value is None else value)), F.lit(0)).cast("bigint")

    found = (counts.withColumn("look", F.explode(looks)).select("part", "mask", "good", "toxic", "n", "look.*")
             .groupBy("part", "filter", "before").agg(
                 count(passed & ~fails).alias("kept"), count(removed).alias("removed"), count(fails & ~passed).alias("redundant"),
                 count(F.col("mask") == F.col("bit")).alias("unique_fails"), count(removed & F.col("good")).alias("good_lost"),
                 count(removed & F.col("toxic")).alias("toxic_lost"), count(fails, F.col("n") * share).alias("shapley")))
    return found.join(F.broadcast(each), ["filter", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES, folder: str | None = None) -> DataFrame:
    """The audit of the documents stored below ``path``, in about ``batches`` micro-batches whatever their number of files.

    Filters: A under 100 words, B fewer than 80 % different words, C over 10 % capitals, D a symbol of ``#$%&*|``, E a copy
    of a smaller id's text. A null text is empty, a null lang the part ``''``; null ids are never copies (E) and repeated rows
    count one by one (rows with one id and text are no copies of each other). No documents give no rows. Columns that are not
    named are not read.
    """
    ensure_shared(spark)
    folder = folder or f"{spark.sparkContext.getCheckpointDir()}/audit-{uuid.uuid4().hex}"
    stored = spark.read.parquet(path)
    files = max(1, -(-len(stored.inputFiles()) // batches))
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", files).parquet(_listable(spark, path))
    return orders(counters(stream, labels, folder))


def _listable(spark: SparkSession, path: str) -> str:
    """A path that a file stream takes: a folder, or a pattern that fits the one file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    one = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
    return f"{path[:-1]}[{path[-1]}]" if one else path


def _oracle(filters: Sequence[str] = FILTERS) -> str:
    letters = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(filters))
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
       (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
       + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
       + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < w.doc_id, false)::INT AS mask
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
f(name, bit) AS (VALUES {letters}),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order
      FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, k AS step, (SELECT bit FROM f WHERE name = filter_order[k]) AS bit,
       coalesce((SELECT sum(bit) FROM f WHERE contains(filter_order[1:k - 1], name)), 0)::INT AS before
      FROM o, range(1, 6) r(k)),
r AS (SELECT part, filter_order, step::INT AS step, any_value(bit) AS bit,
       coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
       coalesce(sum(n) FILTER (good AND mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
       coalesce(sum(n) FILTER (toxic AND mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM r"""


ORACLE = _oracle()
