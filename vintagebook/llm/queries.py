"""Registered queries of the corpus operators, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, jaccard, lexical, licenses, lm_score, merkle, packing, quality,
               sharding, substring_dedup, topk, url_filter)
from .common import ascii_lower, table


def op1_min_bin_slack_packing(spark, d):
    """Every document's pieces in sequences of 4096 ids."""
    out = packing.pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def op2_url_filter(spark, d):
    """Every page's verdict, by rules and link-graph propagation."""
    out = url_filter.filter_urls(table(spark, d, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op3_lattice_lm_score(spark, d):
    """Every document's probability over all segmentations of its words."""
    return lm_score.score_documents(table(spark, d, "documents"),
                                    public_tokenizers.path("piece_bpe_32k.model"))


def op4_license_scan(spark, d):
    """Every document's licence sentences and licences."""
    out = licenses.scan_licenses(table(spark, d, "documents"))
    return out.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                      F.array_join("licenses", ",").alias("licenses"))


def op5_hash_tree_sharding(spark, d):
    """Every document's shard of 16 (and of 17), by the hash tree."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, d, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    tree = sharding.even_tree(16)
    out = sharding.with_slots(
        sharding.assign_shards(rows, F.col("doc_id"), tree, sharding.grow(tree)))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")


def op6_sentence_span_dedup(spark, d):
    """Every document without the passages it repeats from another one."""
    out = substring_dedup.remove_repeats(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_removed")


def op7_quality_rules(spark, d):
    """Every document's counts and verdict."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = quality.judge(docs, table(spark, d, "labels"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def op8_template_decontamination(spark, d):
    """Every document's benchmark items."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = decontaminate.mark_contaminated(docs, table(spark, d, "benchmark"))
    return out.select("doc_id", "contaminated", "n_items", "item_id", "coverage")


def op9_chat_format(spark, d):
    """Every conversation (and -7) formatted, read back from the output."""
    extra = "</s>[INST] ok [/INST]"
    said = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-7, 0, "user", extra), (-7, 1, "assistant", extra)],
                              "conv_id long, turn long, role string, text string"))
    windows = chat_format.format_chats(said, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                       public_tokenizers.PATTERN)
    return chat_format.read_back(windows)


def op10_parity_sketch_join(spark, d):
    """Every document's shingles and component of near duplicates."""
    out = jaccard.similar_documents(table(spark, d, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op11_nested_interval_manifest(spark, d):
    """Every document's leaf, roots and proof, checked after tampering."""
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    out = merkle.verified(merkle.manifest(table(spark, d, "documents"), tampered=hit,
                                          altered={"text": ascii_lower(F.col("text"))}))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_columnar_top_k(spark, d):
    """The 20 nearest rows of every twentieth vector."""
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), topk.whole_numbers(F.col("embedding"), 64).alias("v"))
    return topk.top_k(rows, F.col("id") % 20 == 0, 20)


def op13_pipelined_search(spark, d):
    """The 50 best documents of every benchmark item."""
    return lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark"), 50)


QUERIES = {f.__name__: f for f in (
    op1_min_bin_slack_packing, op2_url_filter, op3_lattice_lm_score, op4_license_scan,
    op5_hash_tree_sharding, op6_sentence_span_dedup, op7_quality_rules,
    op8_template_decontamination, op9_chat_format, op10_parity_sketch_join,
    op11_nested_interval_manifest, op12_columnar_top_k, op13_pipelined_search)}
ORACLES = {"op4_license_scan": licenses.oracle_sql(),
           "op11_nested_interval_manifest": merkle.oracle_sql(),
           "op12_columnar_top_k": topk.oracle_sql(), "op13_pipelined_search": lexical.oracle_sql()}
