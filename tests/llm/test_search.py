"""Ranked search against a plain computation of every score, and the plan of shared sums."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlens.llm.search import plan, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=20):
    held = [(i, Counter(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if c[t])
            if score > 0:
                scores.append((-score, i))
        out += [(item, rank, i, -score) for rank, (score, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aZ09 é  İ-_|\x00\x7f\n@[`{", max_size=40))
def test_terms(text):
    assert [t.decode() for t in terms_of(text.encode())] == plain_terms(text)


def test_plan_shares_work_and_keeps_sums():
    rng = random.Random(5)
    common = [rng.sample(range(60), 8) for _ in range(4)]
    items = [Counter(rng.choice(common) + rng.choices(range(60), k=rng.randrange(4))) for _ in range(50)]
    items += [Counter(), Counter([3]), Counter([3, 3])]
    found = plan(items)
    parts = np.array([[rng.randrange(1 << 40) for _ in range(7)] for _ in range(60)])
    expected = np.array([sum((times * parts[t] for t, times in item.items()), np.zeros(7, np.int64)) for item in items])
    assert (found.scores(parts) == expected).all()
    additions = sum(len(left) for left, _ in found.levels)
    alone = sum(max(0, len(item) - 1) for item in items)
    assert additions < 0.5 * alone


def test_plan_without_items():
    assert plan([]).scores(np.zeros((0, 3), np.int64)).shape == (0, 3)
    assert (plan([Counter()]).scores(np.zeros((0, 3), np.int64)) == 0).all()


def texts(count, seed=2):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(2000)]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(count)]


@pytest.mark.parametrize("max_terms", [200_000, 60])
def test_equals_plain(spark, docs, max_terms):
    rows = texts(400) + [(1000 + i, "w1 w2 the same text") for i in range(150)]  # a large group of copies
    items = [(i, t) for i, t in texts(30, seed=8)] + [(77, "same text"), (78, "nothing_known_here"), (79, None)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = search(docs(*rows).repartition(5), frame, max_terms=max_terms)
    assert sorted(map(tuple, found.collect())) == plain(rows, items)


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "word ONE"), (1, "word ONE"), (1, "x x"), (2, None), (3, "  ||"), (None, "nine text")],
                                  "item_id long, text string")
    found = [tuple(r) for r in search(odd_docs, items).collect()]
    texts = [(10**9 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in odd_docs.collect()]
    expected = plain(texts, [(1, "word one x x"), (-1, "nine text")])  # the terms of an id's rows add up
    assert sorted((-1 if i is None else i, rank, 10**9 if d is None else d, s) for i, rank, d, s in found) == expected
    assert search(odd_docs.filter("false"), items).collect() == []
    assert search(odd_docs, items.filter("false")).collect() == []


def test_ties_go_to_the_smaller_id_and_a_null_id_last(spark, docs):
    rows = docs(*[(i, "same words here") for i in (9, None, 3, 7)], (1, "other"))
    items = spark.createDataFrame([(5, "words")], "item_id long, text string")
    found = search(rows, items, top=3).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == [3, 7, 9]
    assert [r["doc_id"] for r in search(rows, items, top=4).orderBy("rank").collect()] == [3, 7, 9, None]
