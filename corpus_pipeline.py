"""A training corpus from raw documents: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read back as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmesh.llm.bpe import encode_documents
from voltmesh.llm.decontam import find_leaks
from voltmesh.llm.langid import fit_profiles, predict_language
from voltmesh.llm.neardup import NearDupParams, near_duplicates
from voltmesh.llm.quality import fit_quality, score_quality
from voltmesh.llm.queries import vocabulary
from voltmesh.llm.shared import discard, settle

#: Ids to drop are broadcast if they are no more than these, 24 MB; beyond, the documents are shuffled to them.
BROADCAST_IDS = 1_000_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id, null or not, and hash of the text are in gone (_id, _mark)."""
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_mark"))
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: rejected are those without a letter, which no profile is near to; close languages are no reason."""
    return predict_language(docs, fit_profiles(docs), keep=COLUMNS).where("lang_pred <> 'und'").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as label 1."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more."""
    found = settle(near_duplicates(docs, NearDupParams(), marked=True), "pipeline-classes")
    gone = found.where("not kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    out = _without(docs, gone)
    # Rows that repeat an id with its text are one document; only those are shuffled.
    again = found.where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.count("*").alias("n")).where("n > 1 and _id is not null").select("_id", "_mark")
    if again.isEmpty():
        return out
    twice = out.join(again, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_mark")), "left_semi").dropDuplicates(["doc_id", "text"])
    return _without(out, again).unionByName(twice)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item. Rows that share a doc_id, null among them, are one document here."""
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = settle(leaks.where(F.size("hits") > 0).select(F.col("doc_id").alias("_id")), "pipeline-leaks")
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, with digests of the ids and of the text that they decode to."""
    return encode_documents(docs, vocabulary(), with_ids=True)


STAGES = [("language", language), ("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: Trained stages can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
