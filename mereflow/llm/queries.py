"""The numbered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mereflow.llm import bitsliced, bpe, decontaminate, exact, langid, negatives, phrases, quality, simhash, suffixes, toxicity, urls, warc
from mereflow.llm.common import table


def vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Rules (host, path) of the url filter, with their verdicts.
URL_RULES = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, pattern)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"))
    return negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": op4_url_filter,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_warc": op7_warc,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_topk": op9_exact_topk,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dedup": op13_exact_dedup,
}
ORACLE: dict[str, str] = {
    "op2_simhash": simhash.ORACLE,
    "op3_decontamination": decontaminate.ORACLE,
    "op4_url_filter": urls.oracle(URL_RULES),
    "op7_warc": warc.ORACLE,
    "op8_suffix_dedup": suffixes.ORACLE,
    "op9_exact_topk": bitsliced.ORACLE,
    "op11_collocations": phrases.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_exact_dedup": exact.ORACLE,
}
