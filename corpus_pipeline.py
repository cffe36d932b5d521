"""Documents to tokens: quality, near-duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns the columns of ``documents``;
the last returns a row of token counts and digests per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm import bpe, decontaminate, quality, queries, simhash, suffixes
from mereflow.llm.common import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at 0.3 or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of texts whose five-word shingles are alike to 0.8 or more."""
    return simhash.dedup_similar(docs).select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what earlier documents hold in 100 bytes or more; ``n_chars`` follows the text."""
    return suffixes.remove(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of any benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return bpe.digests(docs, *queries.vocabulary())


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The stages need trained models, XXH64 and byte-level merges, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
