"""From raw documents to packed sequences: five stages, each over all that the one before has left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import language, lines, minhash, mixing, packing
from stockledger.llm.queries import MIX_FACTOR, MIX_TARGETS, domains_of_labels, tokenizer_path
from stockledger.llm.scratch import written


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; one without a label gets the language that was found.

    Documents without text or without a letter go.
    """
    model = language.training_text(docs)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    told = language.identify(rows, model).where(F.col("lang_pred") != language.UNKNOWN)
    label = F.coalesce(F.col("row.lang"), F.col("lang_pred"))
    return told.select(F.col("row").withField("lang", label).alias("row")).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier line; those that have no words left go."""
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.without_near_duplicates(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of domains wants them: not at all, once or several times."""
    labelled = domains_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    mixed = mixing.mix(rows, labelled, MIX_TARGETS, MIX_FACTOR)
    # a rate is bounded by what one domain's target asks for, so a row's copies are made where it is
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens."""
    return packing.packed_pieces(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

#: Trained models and hashing of the tokenizer's ids have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
