"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key. Documents are sorted by key within their source: the key's first hex
digits cut a source into ranges, the ranges' word counts are summed by prefix, and the prefix of a document is
that of its range plus a running sum inside it. A source's budget takes whole epochs first; the rest is taken
in key order and cut at the exact word. Ranges are uniform because the key is a hash, so a source that holds a
third of all rows is spread over as many tasks as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, fresh

RANGE_DIGITS = 3  # 16**3 ranges a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(id_: Column) -> Column:
    return F.md5(F.coalesce(id_.cast("string"), F.lit("")).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Targets of sources from rows (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. A target stops
    at ``cap`` times its source's size and the excess is shared anew by weight until none is above: the fill
    level that this ends at follows from one pass over the sources by size / weight.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    rows = (sizes.withColumn("weight", weight.cast("bigint")).withColumn("most", cap * F.col("source_size"))
            .withColumn("ratio", F.col("most") / F.col("weight"))
            .withColumn("words", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
            .withColumn("most_before", F.coalesce(F.sum("most").over(by_ratio), F.lit(0)))
            .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))))
    # Full if its limit lies under the level at which it and all larger ratios would share what is left.
    full = F.col("most") * (F.col("weights") - F.col("weight_before")) < F.col("weight") * (F.col("words") - F.col("most_before"))
    rows = rows.withColumn("full", full)
    left = F.col("words") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0))
    open_weight = F.col("weights") - F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(everything), F.lit(0))
    share = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        (F.col("weight") * left).cast("double") / open_weight.cast("double"))
    return rows.select("source", "source_size", share.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of every document: id, source, key, size, source_size, target, taken.

    ``taken`` counts words with repeats; over a source it sums to the whole part of the target. Null texts
    have size 0; a null source is a source of its own; null ids share one key; repeated rows are taken one
    by one. Other columns are not read.
    """
    rows = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
               .withColumn("key", random_key(F.col("id")))
               .withColumn("range", F.substring("key", 1, RANGE_DIGITS)))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    goal = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    before = ranges.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(
        F.sum("words").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("range_before"))
    budget = before.join(goal, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(budget, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))))
    words = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("range_before") - F.col("inside")))
    return placed.select(F.col("id").alias(id_col), "source", "key", "size", "source_size", "target",
                         (epochs * F.col("size") + last).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, all columns kept.

    A document's copies follow from its source's epochs and the last key taken, so texts stay where they are
    and only one row per source meets them. The one document that the cut falls into counts as taken if at
    least half of it is; documents without words are never drawn.
    """
    rows = mix(docs, weights, cap, id_col, text_col, source_col)
    whole = F.floor(F.when(F.col("source_size") > 0, F.floor("target") / F.col("source_size")).otherwise(0))
    part = F.col("taken") - whole * F.col("size")
    cuts = (rows.where("size > 0").groupBy("source").agg(
        F.first(whole).alias("epochs"), F.max(F.when(2 * part >= F.col("size"), F.col("key"))).alias("last_key")))
    s, e, k, n = (fresh(docs, c) for c in ("mix_source", "mix_epochs", "mix_last", "mix_copy"))
    cuts = cuts.select(F.col("source").alias(s), F.col("epochs").alias(e), F.col("last_key").alias(k))
    copies = F.when(word_count(docs[text_col]) > 0, F.col(e) + F.when(random_key(docs[id_col]) <= F.col(k), 1).otherwise(0)).otherwise(0)
    return (docs.join(cuts, docs[source_col].eqNullSafe(F.col(s)))
            .withColumn(n, copies.cast("int")).where(F.col(n) > 0)
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS w, 3 * source_size AS c FROM s0),
s2 AS (SELECT *, sum(source_size) OVER ()::BIGINT AS t, sum(w) OVER ()::BIGINT AS tw,
              coalesce(sum(c) OVER b, 0)::BIGINT AS pc, coalesce(sum(w) OVER b, 0)::BIGINT AS pw
       FROM s1 WINDOW b AS (ORDER BY c / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, c * (tw - pw) < w * (t - pc) AS f FROM s2),
s4 AS (SELECT source, source_size, CASE WHEN f THEN c::DOUBLE ELSE
              (w * (t - coalesce(sum(c) FILTER (f) OVER (), 0)))::DOUBLE / (tw - coalesce(sum(w) FILTER (f) OVER (), 0))::DOUBLE END AS target FROM s3),
p AS (SELECT d.*, s4.source_size, s4.target, floor(s4.target)::BIGINT AS b,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN b // source_size ELSE 0 END AS n FROM p)
SELECT doc_id, size, source_size, target, (n * size + greatest(0, least(size, b - n * source_size - before)))::BIGINT AS taken FROM e
"""
