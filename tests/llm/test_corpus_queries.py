"""Registered corpus queries against their SQL, and all operators on odd and empty tables."""

from __future__ import annotations

import pytest
from compare import difference

from spendlens.llm import (
    decontam, exact, fertility, licenses, mixing, pages, quality, quotes, simhash, tokens, toxicity)
from spendlens.llm.queries import ORACLES, QUERIES

VOCABULARY = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
PIECES = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, small_dir, name):
    assert difference(QUERIES[name](spark, small_dir), duck, ORACLES[name]) is None


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "licenses": lambda spark, d: licenses.scan(d, licenses.corpus_path()),
    "exact": lambda spark, d: exact.exact_duplicates(d),
    "tokens": lambda spark, d: tokens.count_tokens(d, VOCABULARY),
    "simhash": lambda spark, d: simhash.near_duplicates(d),
    "fertility": lambda spark, d: fertility.rules(d, PIECES),
    "quality": lambda spark, d: quality.score(d, quality.train(d, labels(spark, (4, 1, 0), (6, 0, 1), (7, None, None)))),
    "pages": lambda spark, d: pages.extract(d, "doc_id", "source", "text"),
    "mixing": lambda spark, d: mixing.mix(d),
    "toxicity": lambda spark, d: toxicity.toxicity(d, labels(spark, (4, 1, 0), (6, 0, 1), (7, None, None))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_per_input_row(spark, odd_docs, name):
    found = OPERATORS[name](spark, odd_docs).collect()
    key = "page_id" if name == "pages" else "doc_id"
    assert sorted(str(r[key]) for r in found) == sorted(["1", "2", "3", "4", "5", "5", "6", "7", "None"])


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, docs, name):
    empty = docs((1, "x")).filter("false")
    assert OPERATORS[name](spark, empty).collect() == []


STAGES = {
    "quality": lambda spark, d: quality.good_documents(d, labels(spark, (4, 1, 0), (6, 0, 1))),
    "exact": lambda spark, d: exact.without_copies(d),
    "simhash": lambda spark, d: simhash.without_near_duplicates(d),
    "decontam": lambda spark, d: decontam.decontaminated(d, benchmark(spark, (1, None), (2, "item of words"))),
    "decontam without items": lambda spark, d: decontam.decontaminated(d, benchmark(spark, (1, "x")).filter("false")),
    "mixing": lambda spark, d: mixing.sampled(d, budget=1.0, targets={}),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stages_return_the_columns_of_their_input(spark, odd_docs, name):
    found = STAGES[name](spark, odd_docs)
    assert found.schema.simpleString() == odd_docs.schema.simpleString()
    for r in found.collect():
        assert r["kept"] == f"kept-{r['doc_id']}"
    assert STAGES[name](spark, odd_docs.filter("false")).collect() == []


def test_messages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link_quotes(quotes.as_mail(empty)).collect() == []
