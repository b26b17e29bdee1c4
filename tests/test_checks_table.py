"""The checks table on inputs in which every invariant is broken once."""

from __future__ import annotations

from dataclasses import replace

import pytest

from spendlens.params import Params
from spendlens.plans.base import checks_table
from spendlens.plans.workspace import Workspace

PARAMS = replace(Params(), residual_categories=("X",), merges={}, synonyms={}, fill_after="2022-01-01",
                 actual_from="2020-03-01", base_month="2022-01-01")  # one month of overlap


class Tables:
    def __init__(self, **tables):
        self.tables = tables

    def table(self, name):
        return self.tables[name]


@pytest.fixture
def broken(spark, frame):
    payments = frame(
        "period date, province string, category string, payment_brand string, installments int, "
        "operations bigint, amount decimal(28,4)",
        ("2022-01", "P", "a", "v", 3, 5, 10.0), ("2022-01", "P", "a", None, 3, 5, 10.0),
        ("2022-01", "Q", "X", "v", 3, 5, 10.0),
        ("2022-02", "P", "X", "v", 12, 5, 10.0))  # no weights for plan 12
    platforms = frame(
        "period date, platform string, province string, category string, installments int, "
        "operations bigint, amount decimal(28,4)",
        ("2020-03", PARAMS.dominant_platform, "P", "a", 3, 1, 1.0),
        ("2022-01", PARAMS.dominant_platform, "P", "a", 3, 1, 1.0),
        ("2022-02", PARAMS.dominant_platform, "P", "b", 3, 1, 1.0),
        ("2022-02", PARAMS.dominant_platform, None, "b", 3, 1, 1.0))
    merchants = frame("period date, province string, category string, merchant_id bigint, "
                      "operations bigint, amount decimal(28,4)", ("2023-01", "P", "a", 1, 1, 1.0))
    return Workspace(spark, Tables(
        payments=payments, platform_sales=platforms, merchant_sales=merchants,
        price_index=frame("period date, index_level double", ("2022-01", 1.0)),
        population=frame("province string, region string, population bigint", ("P", "R", 1)),
        category_list=frame("category string", ("a",), ("z",))), PARAMS)


def test_every_broken_invariant_is_counted(broken):
    found = {r.check: r.violations for r in checks_table(broken).collect()}
    assert found == {
        "payments_null_rows": 1,
        "periods_not_first": 0,
        "residual_amount_lost": 10,
        "months_without_index": 1,           # 2022-02
        "platform_null_rows": 1,
        "base_null_rows": 1,                 # the cell without weights
        "months_without_plan": 1,            # plan 24 in 2022-02
        "several_platforms": 0,
        "weights_off_one": 1,                # the overlapping month counts twice
        "weights_overlap": 1,
        "residual_without_weight": 1,
        "amounts_off": 1,                    # its amount is lost
        "category_unlisted": 1,              # b
        "category_unobserved": 1,            # z
        "merchant_months_without_weight": 1,
        "province_without_population": 1,    # Q
    }
