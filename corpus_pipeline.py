"""Clean a corpus and pack it: every stage keeps, changes or cuts what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import chunks, exact, repetition, simhash
from fareloom.llm.queries import packed_pieces
from fareloom.llm.tables import Scratch, free_name
from fareloom.session import temporary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the suffix-array rule."""
    verdict = free_name(docs, "quality")
    return repetition.with_quality(docs, name=verdict).where(F.col(f"{verdict}.kept")).drop(verdict)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal documents the one with the largest id."""
    return exact.without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with close fingerprints the one with the smallest id."""
    return simhash.without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages that occur before; the number of characters follows."""
    left = chunks.without_repeats(docs)
    if "n_chars" not in left.columns:
        return left
    n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(left.schema["n_chars"].dataType))
    return left.withColumn("n_chars", n)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids in sequences of several lengths."""
    return packed_pieces(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Suffix arrays, fingerprints, chunks and token ids are beyond SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables, each one's rows written and read again.

    What a stage has put down on the way goes when its rows are written, and its input with it.
    """
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark):
            kept = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
