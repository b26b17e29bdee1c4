"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from spendlens.llm import (
    centroids, decontam, exact, fertility, licenses, mixing, pages, quality, quotes, search, simhash, tokens, toxicity)
from spendlens.llm.common import read
from spendlens.llm.labels import held_out


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"), licenses.corpus_path())


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(read(spark, folder, "documents"))


def op3_quote_links(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link_quotes(quotes.as_mail(read(spark, folder, "conversations")))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(read(spark, folder, "documents"),
                               public_tokenizers.path("byte_bpe_50k.json"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(found["fp"]).alias("fingerprint"),
                        "component_id")


def _predicted(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return _predicted(quality.score(docs, quality.train(docs, labels)), quality.THRESHOLD)


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(read(spark, folder, "pages"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return _predicted(toxicity.toxicity(docs, labels), toxicity.THRESHOLD)


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(read(spark, folder, "embeddings"))


def op12_fertility_rules(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return fertility.rules(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_licenses, op2_exact_dedup, op3_quote_links, op4_token_counts, op5_simhash, op6_quality, op7_html_text,
        op8_decontamination, op9_mixing, op10_toxicity, op11_centroids, op12_fertility_rules, op13_ranked_search)}

ORACLES: dict[str, str] = {
    "op1_licenses": licenses.ORACLE,
    "op2_exact_dedup": exact.ORACLE, "op3_quote_links": quotes.ORACLE,
    "op8_decontamination": decontam.ORACLE, "op9_mixing": mixing.ORACLE,
    "op11_centroids": centroids.oracle(), "op13_ranked_search": search.ORACLE}
