"""From raw documents to token ids: quality, near-duplicates, personal data, source mix, tokens.

Each stage reads what the one before it wrote and keeps the columns of `documents` (extra columns
stay), but for the last, which replaces the text by its token ids. Stages may be run again on their
input at any time. An empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import mixing, neardup, pii, quality, spm
from millrace.llm.queries import model_file, table
from millrace.session import configure, materialize, scratch_path, scratch_scope  # noqa: F401 - `materialize` for tests of the stages


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, taught by `labels`, scores 0.7 or more."""
    configure(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 or more alike: that of the smallest id.

    SimHash fingerprints and their deletion variants propose pairs, as in `op8_simhash`, and MinHash bands
    those further off; the exact similarity decides.
    """
    configure(spark)
    return neardup.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    configure(spark)
    return pii.redact_documents(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them: whole epochs, then a weighted part."""
    configure(spark)
    narrow = docs.select("doc_id", "text", "source")
    return mixing.repeat_rows(docs, mixing.mix(narrow))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of texts, with their checks."""
    configure(spark)
    return spm.encode_documents(docs, model_file("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("personal_data", without_personal_data),
    ("source_mix", mixed_sources),
    ("tokens", token_ids),
]

# SQL has no random Fourier features, MinHash or SentencePiece; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each over what the one before it wrote."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        # a stage's own tables go when its rows are written
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
