"""Merchant tables against brute force, with one merchant holding a third of the rows."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from spendlens.params import Params
from spendlens.plans.category import merchant_shares
from spendlens.plans.workspace import Workspace

PARAMS = replace(Params(), ecommerce_category="E", accumulate_from="2022-01-01", merges={})


class Tables:
    def __init__(self, **tables):
        self.tables = tables

    def table(self, name):
        return self.tables[name]


@pytest.fixture
def ws(spark):
    sales = spark.range(900).selectExpr(
        "date'2022-01-01' AS period", "concat('P', id % 4) AS province",
        "CASE WHEN id % 7 = 0 THEN 'E' WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS category",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS merchant_id",
        "CAST(id % 5 + 1 AS BIGINT) AS operations", "CAST(id % 11 + 1 AS DECIMAL(28,4)) AS amount")
    registry = spark.createDataFrame([(1, "One B"), (1, "One"), (2, "Two")],
                                     "merchant_id bigint, legal_name string")
    space = Workspace(spark, Tables(merchant_sales=sales, merchant_registry=registry), PARAMS)
    # No weights for the month: listed merchants' e-commerce rows get a null category.
    space.market_weights = spark.createDataFrame(
        [], "period date, category string, share_operations double, share_amount double")
    return space


def test_merchant_shares_match_brute_force(ws):
    listed = {1, 2}
    sums = defaultdict(lambda: defaultdict(lambda: None))
    for r in ws.table("merchant_sales").collect():
        moved = r.category == "E" and r.merchant_id in listed
        group = sums[None if moved else r.category]
        group[r.merchant_id] = (group[r.merchant_id] or 0) + (0 if moved else r.amount)
    expected = {}
    for category, merchants in sums.items():
        if category is None:
            expected[category, "Rest"] = None
            continue
        tenth = sorted(merchants.values(), reverse=True)[:10][-1]
        for merchant, amount in merchants.items():
            bucket = str(merchant) if amount >= tenth else "Rest"
            expected[category, bucket] = expected.get((category, bucket), 0) + amount

    out = merchant_shares(ws).collect()
    assert {(r.category, r.bucket): r["amount_since_2022-01-01"] for r in out} == expected
    names = {r.bucket: (r.merchant_id, r.legal_name) for r in out}
    assert names["1"] == (1, "One")
    assert names["Rest"] == (None, None)
    for category in ("a", "b", "E"):
        assert sum(r.share_amount for r in out if r.category == category) == pytest.approx(1)


def test_leaders_are_limited_before_they_meet_the_registry(ws):
    merchant_shares(ws)
    leaders = ws.spark.read.parquet(f"{ws.stage.root}/leading_merchants")
    assert leaders.groupBy("category").count().agg(F.max("count")).first()[0] < 50
