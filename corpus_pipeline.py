"""Corpus pipeline: raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last keep the columns
of `documents`.

1. toxicity: documents that the noisy-or model scores 0.3 or more go.
2. simhash_near_dedup: of every group of near copies the smallest doc_id stays.
3. decontamination: documents that hold a benchmark item, with or without other
   numbers, names and units, go.
4. pii: personal data and terms that disclose it are replaced in the texts.
5. packing: tokenised documents are packed into sequences.

In every stage null and empty texts are texts without words: not toxic, near copies of
each other, no leak, without personal data, one end token long. Texts of any length are
taken whole. Rows with a null id are kept by all stages that take documents out. Ties go
to the smallest id; repeated rows stay or go together and are packed each. An empty table
gives an empty result. Extra columns, whatever their names, stay as they are. An empty
labels table makes no text toxic, an empty benchmark no text a leak.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snaplake.llm import decontaminate, packing, pii, shared, simhash, toxicity


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out toxic documents, as learned from the labelled ones that are not held out."""
    shared.bounded_batches(spark)
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies."""
    shared.bounded_batches(spark)
    return simhash.keep_one(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out documents that hold a benchmark item."""
    shared.bounded_batches(spark)
    return decontaminate.reject(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; n_chars keeps telling the length of the input text."""
    shared.bounded_batches(spark)
    return pii.sanitise(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every piece of a document, with its sequence and its place there."""
    shared.bounded_batches(spark)
    return packing.pack(docs, packing.word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stage_toxicity),
    ("simhash_near_dedup", stage_near_dedup),
    ("decontamination", stage_decontamination),
    ("pii", stage_pii),
    ("packing", stage_packing),
]

#: SQL expresses no stage (a fitted model, XXH64 votes, templates, a tokenizer); tests hold
#: each against a brute-force version or planted cases.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder. The
    session's batch size, which the stages set, is put back."""
    before = spark.conf.get(shared.BATCH_BYTES, None)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    try:
        for name, stage in STAGES:
            docs = shared.written(stage(spark, docs, sf_dir), name)
    finally:
        if before is None:
            spark.conf.unset(shared.BATCH_BYTES)
        else:
            spark.conf.set(shared.BATCH_BYTES, before)
    return docs
