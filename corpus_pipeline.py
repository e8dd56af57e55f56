"""The corpus pipeline: toxic texts go, one of each near-duplicate group stays, repeated passages and benchmark leaks go, texts become pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vulnatlas.llm import decontamination, minhash_dedup, sentencepiece_sampling, substring_dedup, toxicity
from vulnatlas.llm.text import remove_stored, scratch, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on the labelled ones among ``docs``, does not find toxic.

    Each row is judged by its own text; null and empty ones stay, and so do all without labels of both kinds.
    """
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more.

    Rows that repeat an id, or have none, are compared like any others; those without words all stay.
    """
    return minhash_dedup.drop_near_duplicates(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a document of smaller id holds too.

    Rows without an id lose nothing; null texts stay null, and a text that loses all its words stays, empty.
    """
    return substring_dedup.drop_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item; null and empty ones stay, all of them with an empty benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids, ids_crc32, lossless`` of each row; a null or empty text has no piece."""
    return sentencepiece_sampling.encoded(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("pieces", as_pieces),
]

#: Trained machines, sampled segmentations and tiles have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again.

    What a stage wrote on its way is removed once its rows are stored, and they are once the next one's are.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
        if before is not None:
            remove_stored(before)
        before = docs
    return docs
