from __future__ import annotations

import pytest

from spendlens.llm import tokens

P = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer
PATH = P.path("byte_bpe_50k.json")
TEXTS = ["", None, "don't  'S 1234 ''s", "a<|endoftext|>b <|endoftext|>", "  \n\n x y  ", "x y\x85z\x1cw",
         "漢字かな \U00010940 Ωμέγα €5", "ab cd " * 60_000, "the " * 700]


def test_counts_are_those_of_the_library(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    library = Tokenizer.from_file(PATH)
    expected = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in enumerate(TEXTS)}
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(docs, PATH).collect()}
    assert found == {i: (b, n, n > 512) for i, (b, n) in expected.items()}


def test_whole_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    library = Tokenizer.from_file(PATH)
    found = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, PATH).collect()}
    assert found == {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False)) for r in docs.collect()}


def test_patterns_agree_where_the_regular_expression_is_used():
    pattern, _, _ = tokens._rules(PATH)
    split = Tokenizer.from_file(PATH).pre_tokenizer.pre_tokenize_str
    for code in [*range(1, 0x530), *range(0x2000, 0x2070), *range(0x20a0, 0x20c0)]:
        text = f"a {chr(code)} {chr(code)}b 1{chr(code)}"
        assert pattern.findall(text) == [text[a:b] for _, (a, b) in split(text)], hex(code)
