"""The corpus pipeline: documents to token ids, each stage one operator over all that its predecessor kept.

Each stage takes and gives the columns of documents (n_chars follows the text); the last one adds tokens and n_tokens. Work
tables go to the folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.llm import bpe, decontaminate, linededup, neardup, quality
from dwellspan.llm.text import free_name
from dwellspan.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL = None  # a fitted classifier and the merges of a vocabulary can't be written in SQL


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled documents and keeps those that score at least the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, model = quality.train_and_score(docs, labels)
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops shared lines except where they come first; a document may become empty, but stays."""
    kept = linededup.drop_shared_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*["`" + c.replace("`", "``") + "`" for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group."""
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover one word in twenty or more."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids of each text, and stops if they don't decode to the text."""
    back = free_name(docs, "back")
    coded = bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, decoded=back)
    same = F.col(back) == F.coalesce("text", F.lit(""))
    checked = F.when(same, F.col("tokens")).otherwise(F.raise_error(F.lit("a text doesn't come back from its tokens")))
    return coded.withColumn("tokens", checked).drop(back)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
