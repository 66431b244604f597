"""A training-corpus pipeline over ``documents``: quality, line dedup, near-dedup,
decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows of its ``docs``; its
decisions are applied.  All stages but the last return the columns of
``documents``.

Defined cases: a document whose lines are all dropped stays with an empty text
and a size of 0; of rows with equal doc_id and text one stays in near-dedup, rows
that share a doc_id otherwise are judged each by itself, and rows without a doc_id
pass; one text of a doc_id in two sources is mixed in each of them.  The cases
of the operators are told in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.llm.decontaminate import decontaminate
from wareloom.llm.line_dedup import dedup_lines
from wareloom.llm.mixing import MADE, mix
from wareloom.llm.near_dup import near_duplicates
from wareloom.llm.quality import classify
from wareloom.llm.text_hash import spare
from wareloom.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF predicts as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).where("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows the text."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five-word shingles, similarity 0.8.

    Of a group the row with the smallest doc_id stays (of rows sharing it, one); rows that share a doc_id
    but not their group are judged each by itself.
    """
    row = spare("row", docs.columns)
    named = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).withColumn(row, F.xxhash64("text"))
    judged = near_duplicates(named, k=5, percent=80, key=row).where("kept")
    first = judged.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.*")
    keep = first.unionByName(judged.where("group is null").select("doc_id", "key")).withColumnRenamed("key", row)
    stays = named.join(keep, ["doc_id", row], "left_semi")
    return stays.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).where("not contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken (words, repeats counted).

    Rows with equal doc_id, source and text come out once, with the words of all of them in ``taken``.
    """
    digest = spare("digest", docs.columns)
    key = ["doc_id", "source", digest]
    marked = docs.drop(*MADE).withColumn(digest, F.xxhash64("text"))
    plan = mix(marked.select(*key, "text")).where("taken > 0")
    plan = plan.groupBy(*key, "size", "source_size", "target").agg(F.sum("taken").alias("taken"))
    named = {k: spare(f"of_{k}", marked.columns) for k in key}
    plan = plan.withColumnsRenamed(named)
    same = [marked[k].eqNullSafe(plan[n]) for k, n in named.items()]
    taken = marked.join(plan, same[0] & same[1] & same[2]).drop(*named.values())
    return taken.dropDuplicates(key).drop(digest)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing)]

#: the line CRF cannot be written in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, f"pipeline-{name}")
    return docs
