"""A corpus pipeline of five operators.  Each stage takes the documents that
the one before kept and returns documents; the last returns token counts.
``run`` writes every stage as Parquet in the shared folder and reads it back
as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeward.llm import byte_bpe, decontaminate, jaccard_join, language_id, personal_data
from homeward.llm.common import stage_table, table

LEAST_SCORE = 0.5  # posterior probability below which no language is certain


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts of no language with at least
    half of the posterior probability."""
    found = language_id.identify(docs)
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least id of each group that links of
    similarity 0.8 connect."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold half of a benchmark item or more."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the new text."""
    redacted = personal_data.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    n_chars = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return redacted.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text left."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", redact_personal_data),
    ("byte_bpe", tokenize),
]

# a trained model, probabilistic pruning and a tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
