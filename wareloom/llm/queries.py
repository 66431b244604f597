"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wareloom.llm import sql
from wareloom.session import local_rows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.url_filters import PAGE_RULES, judge_urls

    rules = local_rows(spark, PAGE_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.language_id import identify

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.decontaminate import decontaminate

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, _table(spark, sf_dir, "benchmark")).drop("text")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.near_dup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.embedding_dedup import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.mixing import mix

    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).drop("source")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.warc import archive

    return archive(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.quality import classify

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.alignment import align

    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = lambda g: F.when(g == "", "").otherwise(F.sha2(g.cast("binary"), 256))
    return align(docs, groups=digest).withColumnRenamed("groups", "groups_sha256")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.license_scan import scan

    return scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareloom.llm.hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(vectors, F.col("id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_source_mixing": op8_source_mixing,
    "op9_warc": op9_warc,
    "op10_quality_crf": op10_quality_crf,
    "op11_token_alignment": op11_token_alignment,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": sql.OP1,
    "op3_decontamination": sql.OP3,
    "op4_minhash_near_dedup": sql.OP4,
    "op5_embedding_near_dedup": sql.OP5,
    "op6_line_dedup": sql.OP6,
    "op8_source_mixing": sql.OP8,
    "op9_warc": sql.OP9,
    "op12_license_scan": sql.OP12,
    "op13_hard_negatives": sql.OP13,
}

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
