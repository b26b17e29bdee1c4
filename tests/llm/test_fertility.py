"""Fertility rules: counts and bands against plain computations."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlens.llm import fertility
from spendlens.llm.fertility import FENCE, MEASURES, Words, repeated_lines, repeated_words, rules, script

VOCABULARY = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def plain_measures(text, model):
    words = WORD.findall(text or "")
    pieces = Counter(p for w in words for p in model.encode(w))
    total = sum(pieces.values())
    if not total:
        return 0, 0, 0, 0
    entropy = -sum(n / total * math.log2(n / total) for n in pieces.values())
    return (total, 1000 * sum(map(len, words)) // total,
            1000 * sum(n for p, n in pieces.items() if model.is_byte(p)) // total, math.floor(1000 * entropy + 1e-6))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=25))
def test_repeated_words(words):
    ids = np.array(["abc".index(w) for w in words], dtype=np.int64)
    assert repeated_words(ids) == plain_counts(" ".join(words))[4]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\t\r\x0b #", max_size=30))
def test_repeated_lines(text):
    assert repeated_lines(text.encode()) == plain_counts(text)[3]


def test_script():
    assert script("Größe ist 5".encode()) == "latin"
    assert script("Привет, мир ok".encode()) == "cyrillic"
    assert script("日本語のテキスト".encode()) == "kana"
    assert script(b"12 34 ...") == "none"


def test_forgotten_words_are_looked_up_again(monkeypatch):
    monkeypatch.setattr(fertility, "MAX_WORDS", 3)
    words = Words(VOCABULARY)
    for batch in ([b"one", b"two"], [b"two", b"three", b"four"], [b"one"]):
        pieces, ends = words.table(batch)
        assert [pieces[a:b].tolist() for a, b in zip(ends, ends[1:])] == [
            words.model.encode(w.decode()) for w in batch]


def test_query_equals_plain(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/documents.parquet")
    model = Words(VOCABULARY).model
    rows, groups = {}, defaultdict(set)
    for r in table.collect():
        counts, measures = plain_counts(r["text"]), plain_measures(r["text"], model)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        band = f"{r['lang']}/{counts[0].bit_length()}"
        rows[r["doc_id"]] = (counts, failed, band, measures)
        if not failed:
            groups[band].add((r["text"], measures[1:]))
    limits = {}
    for band, texts in groups.items():
        for k, name in enumerate(MEASURES):
            values = sorted(m[k] for _, m in texts)
            q1, q3 = (values[math.ceil(len(values) * part) - 1] for part in (0.25, 0.75))
            reach = FENCE * max(q3 - q1, MEASURES[name])
            limits[band, name] = (q1 - reach, q3 + reach)
    rejected = 0
    for r in rules(table, VOCABULARY).collect():
        counts, failed, band, measures = rows[r["doc_id"]]
        assert tuple(r)[1:6] == counts
        assert (r["base_failed"], r["band"], r["n_tokens"]) == (failed, band, measures[0])
        assert tuple(r[name] for name in MEASURES) == measures[1:]
        inside = not failed and all(limits[band, n][0] <= m <= limits[band, n][1] for n, m in zip(MEASURES, measures[1:]))
        assert r["kept"] == inside
        rejected += not inside and not failed
    assert rejected > 0


def test_labels_agree(spark, data_dir):
    """Beyond the base rules most labelled junk goes, and next to nothing labelled good."""
    folder = data_dir.replace("0.01", "0.1")
    found = rules(spark.read.parquet(f"{folder}/documents.parquet"), VOCABULARY)
    shares = {r["quality"]: r["share"] for r in found.filter("NOT base_failed").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.99 and shares[0] < 0.5


def test_a_large_group_of_copies_counts_once(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text", "lang")
    alone = {r["doc_id"]: r["kept"] for r in rules(table, VOCABULARY).collect()}
    one = table.filter(F.col("doc_id") == min(i for i, kept in alone.items() if kept)).select("text", "lang")
    copies = one.crossJoin(spark.range(100_000, 102_000).withColumnRenamed("id", "doc_id")).select(table.columns)
    found = {r["doc_id"]: r["kept"] for r in rules(table.unionByName(copies), VOCABULARY).collect()}
    assert {i: found[i] for i in alone} == alone
    assert all(found[i] for i in range(100_000, 102_000))


def test_missing_language_column_uses_the_script(spark):
    rows = spark.createDataFrame([(1, "слово " * 60), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["band"] for r in rules(rows, VOCABULARY).collect()}
    assert found == {1: "cyrillic/6", 2: "none/0"}
