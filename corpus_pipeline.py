"""The corpus pipeline: documents that stay, without personal data, packed into training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import pii
from sluice.llm.common import discard, disposable, table, unused
from sluice.llm.decontamination import uncontaminated
from sluice.llm.language import UNKNOWN, fit, identify
from sluice.llm.near_duplicates import deduplicated
from sluice.llm.packing import pack_documents
from sluice.session import scratch_dir

TOKENIZER = "byte_bpe_50k.json"
#: Score from which the language model overrules what a document says of itself.
CERTAIN = 0.9


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the rows that name a language. Texts in no language (null, or without a letter) go, and
    those whose stated language the model contradicts with a certainty of :data:`CERTAIN`; where no row
    names a language there is no model, and only the former go."""
    model = fit(docs.select("text", "lang"))
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found, sure = unused(docs, "_language"), unused(docs, "_certainty")
    judged = identify(docs, model, names=(found, sure))
    stated = F.col("lang").isin(model.langs)
    contradicted = stated & (F.col("lang") != F.col(found)) & (F.col(sure) >= CERTAIN)
    return judged.filter((F.col(found) != UNKNOWN) & ~F.coalesce(contradicted, F.lit(False))).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word shingles are 0.8 alike or more, one stays."""
    return deduplicated(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, give way to their kind."""
    return pii.sanitised(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, each with its place in a sequence."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Trained models and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each to what the one before has written.

    What a stage wrote for itself goes when its result is there, and that when the next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        with disposable(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
