"""The registered queries: each operator on its whole table, and its DuckDB twin where SQL can express it."""

from __future__ import annotations

import public_tokenizers

from . import audit, hnsw, langid, merkle, mixing, packing, paragraphs, simhash, slack, suffix, token_count, topk, urls
from .common import table

SIZE = 1024


def op4_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_token_count(spark, sf_dir):
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_best_fit(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SIZE, 2,
                                  rank_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_suffix_dedup(spark, sf_dir):
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op2_hnsw(spark, sf_dir):
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op3_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_paragraph_dedup(spark, sf_dir):
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"))


def op10_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    return audit.filter_audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


def op12_merkle(spark, sf_dir):
    return merkle.document_manifest(table(spark, sf_dir, "documents")).drop("path")


def op13_bin_slack(spark, sf_dir):
    return slack.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SIZE, 0,
                                rank_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_hnsw": op2_hnsw,
    "op3_mix": op3_mix,
    "op4_url_filter": op4_url_filter,
    "op5_simhash": op5_simhash,
    "op6_token_count": op6_token_count,
    "op7_exact_topk": op7_exact_topk,
    "op8_best_fit": op8_best_fit,
    "op9_paragraph_dedup": op9_paragraph_dedup,
    "op10_language_id": op10_language_id,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle": op12_merkle,
    "op13_bin_slack": op13_bin_slack,
}
ORACLE: dict[str, str] = {"op3_mix": mixing.ORACLE, "op4_url_filter": urls.oracle(), "op7_exact_topk": topk.ORACLE,
                          "op11_filter_audit": audit.ORACLE, "op12_merkle": merkle.ORACLE}
