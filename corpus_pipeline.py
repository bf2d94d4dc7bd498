"""From documents to packed training sequences: five stages, each one operator of ``larkspur.llm``.

Every stage takes and returns whole rows; all but the last keep the columns of its input, whatever their names, as
all columns that an operator does not need travel in one struct. Repeated rows are rows like others, and an
empty table gives an empty table. What nulls, empty and very long texts and ties mean is told per stage.
Stages that hand whole texts to Python lower the session's rows per Arrow batch to 1000 (``small_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, darts, mixing, packing, repeats, toxicity
from larkspur.llm.common import brought_back, saved, set_aside, small_batches

CORE = ("doc_id", "text", "lang", "source")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language. The classifier
    learns from the labelled documents that are not held out. Null and empty texts score as a text without
    words; a null or unknown language has the general threshold; a score at the threshold goes."""
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(set_aside(docs, *CORE), model)
    return brought_back(scored.where(~F.col("toxic")), docs.columns, *CORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id; of rows that repeat
    that doc_id all stay. Rows without doc_id, and texts that are null or without a word, are classes of their own and stay."""
    small_batches(spark)
    return brought_back(darts.near_duplicates(set_aside(docs, *CORE)).where("kept"), docs.columns, *CORE)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that a repeated string of 200 bytes covers; n_chars follows the text.
    Null texts stay null, shorter texts stay as they are, and a text may become empty."""
    small_batches(spark)
    left = repeats.remove_repeats(set_aside(docs, *CORE, "n_chars"))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        left = left.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return brought_back(left, docs.columns, *CORE, "n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. A null source is a source of its own and
    the last; null texts and texts without a word add nothing to sizes and come as often as others of their source;
    ties within a source go by doc_id and text."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 2048 tokens. Null and empty texts are one token, the end mark; a
    long text is cut into several pieces."""
    small_batches(spark)
    return packing.pack(docs, bpe.vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", drop_repeats),
    ("source_mix", mix_sources),
    ("packing", pack),
]

#: Learned scores, signatures and tokens are beyond SQL. tests/llm holds near duplicates, repeated strings, mix and packing
#: against brute force on each stage's own input, and the toxicity stage against the scores and labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
