"""From raw documents to packed training sequences, one operator per stage.

Every stage takes all that its predecessor kept. The first four return the columns of
``documents``; the last returns one row per piece of a sequence, with its token ids.

* quality: documents that the compression classifier scores below 0.3 go.
* near_dedup: of documents linked by a similarity of 0.8 or more on five-word shingles, the one with
  the smallest id stays. Different texts of one id are documents of their own, equal ones are
  one. Rows without an id stay.
* decontamination: spans that repeat benchmark items are cut out of the texts; a document
  that consists of them for more than half goes.
* secret_removal: secrets in the texts become a mark; every document stays.
* packing: the rest is tokenized and packed.

A stage bounds the session's batches for good, as its caller reads and writes what it returns; ``run`` lifts the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronscope.llm import decontam, neardup, packing, quality, secret_scan
from patronscope.llm.common import bound_batches, free, small_batches, stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    model = quality.train(docs, quality.learnable(table(spark, sf_dir, "labels")))
    return quality.score(docs, model).where(F.col("score") >= quality.ACCEPT).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    own, mark, row_no = free(docs, "own_id"), free(docs, "text_hash"), free(docs, "row_no")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    further = further_texts(marked.select(F.col("doc_id"), F.col(mark).alias("mark"))).select(
        F.col("doc_id"), F.col("mark").alias(mark), F.col("own").alias(own)
    )
    # ids of further texts are above all others, so the first text of the smallest id stays
    rows = marked.join(stored(further, "further-texts"), ["doc_id", mark], "left")
    rows = rows.withColumn(own, F.coalesce(own, F.col("doc_id").cast("long"))).drop(mark)
    ids = rows.select(F.col(own).alias("doc_id"), "text")
    found = neardup.near_duplicates(ids, width=5, similarity=0.8)
    first = found.where("kept and doc_id is not null").select(F.col("doc_id").alias(own))
    # the join has brought rows of one id together already
    same_id = W.partitionBy(own).orderBy(F.xxhash64("text"))
    kept = rows.join(first, own, "left_semi").withColumn(row_no, F.row_number().over(same_id))
    kept = kept.where(F.col(row_no) == 1).select(docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))


def further_texts(marked: DataFrame) -> DataFrame:
    """``doc_id, mark, own`` of texts of an id but for one; ``own`` is an id from 2 ** 62 on.

    Only ids and hashes of texts move, combined before the shuffle.
    """
    low = marked.groupBy("doc_id").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    low = low.where("low < high").select("doc_id", "low")
    further = marked.join(low, "doc_id").where("mark > low").select("doc_id", "mark").distinct()
    own = F.xxhash64("doc_id", "mark").bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    return further.withColumn("own", own)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_removal", secret_removal),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the packing; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
