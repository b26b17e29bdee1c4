"""Key history and bitmaps against sets in plain Python, in one run and over several."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date

import pytest

from spendlens.operators import checks, history
from spendlens.schemas import MERCHANT_SALES
from spendlens.sources.staging import Stage

CELL = ("period", "province", "category")
MONTHS = [date(2021 + k // 12, k % 12 + 1, 1) for k in range(11, 16)]


def sales(spark, rows):
    return spark.createDataFrame([(*r, 1, None) for r in rows], MERCHANT_SALES)


def random_rows(seed, months, merchants=60):
    rng = random.Random(seed)
    out = {(rng.choice(months), rng.choice("PQR"), rng.choice("ab"), rng.choice([None, *range(merchants)]))
           for _ in range(400)}
    hot = {(m, p, c, 7) for m in months for p in "PQR" for c in "ab"}
    return sorted(out | hot, key=str)


def build(spark, rows, saved=None, changed=()):
    return history.key_history(sales(spark, rows).repartition(5), "merchant_id", CELL[1:], Stage(spark).table, saved, changed)


def months_by_key(rows):
    found = defaultdict(set)
    for period, _, _, key in rows:
        found[key].add(period.year * 12 + period.month if period else 0)
    return {k: sorted(v) for k, v in found.items()}


def test_history_equals_sets(spark):
    rows = [*random_rows(1, MONTHS), (None, "P", "a", 500), (None, "P", "a", 7)]
    found = build(spark, rows).collect()
    assert {r["merchant_id"]: r["months"] for r in found} == months_by_key(rows)
    assert sorted(r["number"] for r in found) == list(range(1, len(found) + 1))
    for r in found:
        dated = [m for p, _, _, k in rows if k == r["merchant_id"] and (m := p)]
        assert (r["first_period"], r["last_period"]) == ((min(dated), max(dated)) if dated else (None, None))


def test_presence_equals_that_of_the_rows(spark):
    rows = random_rows(2, MONTHS)
    df, held = sales(spark, rows), build(spark, rows)
    for month in ("2021-12-01", "2022-02-01", "2022-04-01", "2023-01-01"):
        for mine, theirs in ((history.presence_of, checks.presence), (history.first_seen_in, checks.new_keys)):
            assert (sorted(map(str, mine(held, "merchant_id", month).collect()))
                    == sorted(map(str, theirs(df, "merchant_id", month).collect()))), month


def test_changed_months_are_merged(spark):
    """A second run that sees only the changed months equals one that sees all rows."""
    before = random_rows(3, MONTHS[:4])
    first = Stage(spark).table("first", lambda: build(spark, before))
    revised = [r for r in random_rows(4, MONTHS[3:], merchants=90)]  # the fourth month anew, and a fifth
    every = [r for r in before if r[0] not in MONTHS[3:]] + revised
    second = build(spark, revised, first, MONTHS[3:]).collect()
    assert {r["merchant_id"]: r["months"] for r in second} == months_by_key(every)
    numbers = {r["merchant_id"]: r["number"] for r in second}
    assert len(set(numbers.values())) == len(numbers)
    assert all(numbers.get(r["merchant_id"], r["number"]) == r["number"] for r in first.collect())


@pytest.mark.parametrize("merchants", [5, 40_000])
def test_bitmap_counts_equal_distinct_counts(spark, merchants):
    rows = random_rows(5, MONTHS) if merchants == 5 else [
        (MONTHS[k % 3], "PQ"[k % 2], "a", k * 1_000_003) for k in range(merchants)]
    df = sales(spark, rows).cache()
    held = Stage(spark).table("history", lambda: history.key_history(df, "merchant_id", CELL[1:], Stage(spark).table))
    bitmaps = Stage(spark).table("bitmaps", lambda: history.key_bitmaps(df, held, "merchant_id", CELL))
    for by in ([], ["period"], ["period", "province"], ["category"]):
        expected = defaultdict(set)
        for row in rows:
            expected[tuple(row[CELL.index(b)] for b in by)].add(row[3])
        found = history.distinct_keys(bitmaps, by, "n").collect()
        assert {tuple(r)[:-1]: r["n"] for r in found} == {k: len(v) for k, v in expected.items()}
    plan = history.distinct_keys(bitmaps, ["period", "province"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan and "merchant_id" not in plan
    df.unpersist()


def test_no_rows(spark):
    empty = sales(spark, [])
    held = build(spark, [])
    assert held.collect() == []
    bitmaps = history.key_bitmaps(empty, held, "merchant_id", CELL)
    assert [r["n"] for r in history.distinct_keys(bitmaps, [], "n").collect()] == [0]
