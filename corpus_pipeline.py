"""The corpus pipeline: language ID, SimHash near-duplicates, suffix-array dedup, mixing, packing.

Each stage takes what the one before kept, written as Parquet and read again, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabline.llm import langid, mixing, packing, simhash, suffix
from fabline.llm.common import ensure_shared, fresh

MIN_SCORE = 0.35  # calibrated probability under which a document's language counts as not recognised


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or with no likely language go."""
    lang, score = fresh(docs, "lang_found"), fresh(docs, "lang_score")
    found = langid.predict(docs, langid.train(docs), (lang, score))
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that also start elsewhere; n_chars follows the text."""
    out = suffix.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  rank_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates), ("suffix_dedup", repeats),
          ("source_mix", mixture), ("best_fit_packing", packed)]
#: No SQL form: language ID, SimHash and tokenisation are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's result is written to the shared folder and read again."""
    ensure_shared(spark)
    at = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}_{name}")
        docs = spark.read.parquet(f"{at}/{k}_{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
