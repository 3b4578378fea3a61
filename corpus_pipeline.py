"""A training-data pipeline over ``documents``: quality rules, near duplicates,
repeated passages, benchmark items, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns
of ``documents``.  A stage first drops the intermediate tables of the stage
before it, whose result has been written by then.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagebook.llm import decontaminate, jaccard, packing, quality, substring_dedup
from vintagebook.llm.common import materialize, release, remove, table
from vintagebook.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counting rules and the likelihood ratio keep."""
    release(spark)
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id
    (a row with an id before one without, then by a hash of the text; of rows
    equal in both, any one).  All rows without words stay."""
    release(spark)
    groups = jaccard.similar_documents(docs).filter("component is not null")
    who = F.struct(F.col("doc_id").isNull().alias("_without"), "doc_id", "mark")
    rows = groups.groupBy("component", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(rows.groupBy("component").agg(F.min(who).alias("_best")), "component").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "n", (who == F.col("_best")).alias("_stays"))
    rows = materialize(rows.filter("n > 1 or not _stays"), "pipeline-copies")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_mark"))
    alone = docs.join(rows.select("_id", "_mark"), same, "left_anti")
    again = docs.join(rows.filter("_stays").select("_id", "_mark"), same, "left_semi")
    return alone.unionByName(again.dropDuplicates(["doc_id", "text"]))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a document of
    which nothing is left goes, one that was empty before stays."""
    release(spark)
    out = substring_dedup.remove_repeats(docs)
    left = (F.col("n_removed") == 0) | (F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.filter(left).withColumn("n_chars", size).select(*docs.columns)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    release(spark)
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    hit = found.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 4096 ids, with the ids."""
    release(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_items),
    ("packing", packed),
]
# Hashes, tokenizers and graph components cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result reads the last one's table.  A
    stage's table is removed when the next one's is written."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            remove(spark, f"{base}/{i - 1}")
    release(spark)
    return docs
