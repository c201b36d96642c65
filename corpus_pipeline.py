"""A training-corpus pipeline: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir); ``docs`` has the columns of
``documents``.  All stages but the last return those columns; the last returns
the packing: one row per piece with its sequence.  ``run`` writes each stage's
result to the shared folder and reads it back for the next one.

Cases (each stage's operator states its own): null texts count as empty; equal
rows and ties are settled by the least doc_id; an empty table passes through
all stages; documents with a null doc_id cannot be judged by id and are kept
until packing; further columns are carried along up to the last stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm import decontamination, jaccard, packing, quality_classifier, substrings
from stagewise.llm.common import documents, staged


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` (with columns of any name) without the doc_ids of ``found``."""
    found = found.select("doc_id").alias("found")
    return docs.alias("own").join(found, F.col("own.doc_id") == F.col("found.doc_id"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    scored = quality_classifier.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scored.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    return _without(docs, jaccard.join(docs).where("doc_id != component_id").distinct())


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return substrings.without_passages(docs, substrings.repeated_passages(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    found = decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontamination.without_leaks(docs, found)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequences they are packed into."""
    return packing.pack(staged(packing.pieces(docs), "pieces"))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: None: the classifier, the chunk hashes and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
