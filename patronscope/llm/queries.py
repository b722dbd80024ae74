"""The queries ``op1_`` to ``op13_``; the SQL that checks them is in ``queries_sql``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.llm import (
    align,
    ann,
    decontam,
    html_extract,
    langid,
    neardup,
    packing,
    phrases,
    quality,
    secret_scan,
    sketch_join,
    substring,
    warc,
)
from patronscope.llm.common import table
from patronscope.llm.queries_sql import oracle_sql
from patronscope.operators.durable import fresh_path

__all__ = ["oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.record_digests(warc.read_chunks(spark, path, with_data=False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()).select("text", "lang"))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.learnable(table(spark, sf_dir, "labels")))
    found = quality.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= quality.ACCEPT).cast("int")
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.spans(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("longest_match")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch_join.similar(table(spark, sf_dir, "documents"), width=4, similarity=0.85)
    return found.select("doc_id", "n_shingles", "component_id")


def queries() -> dict[str, Query]:
    own = [
        op1_warc_chunks,
        op2_language_id,
        op3_nearest_neighbours,
        op4_quality,
        op5_near_duplicates,
        op6_substring_dedup,
        op7_secret_scan,
        op8_packing,
        op9_decontamination,
        op10_html_extraction,
        op11_token_alignment,
        op12_phrase_collocations,
        op13_parity_sketch_join,
    ]
    return {q.__name__: q for q in own}
