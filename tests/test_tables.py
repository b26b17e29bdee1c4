"""Report tables on a small hand-made base."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from frames import rows
from spendlens.params import Params
from spendlens.plans import tables

BASE = ("period date, province string, category string, installments int, "
        "amount decimal(28,4), amount_real decimal(28,4), operations bigint")
PARAMS = replace(Params(), top_categories=1)


@pytest.fixture
def base(frame):
    return frame(
        BASE,
        ("2020-12", "P", "a", 3, 10.0, 20.0, 1), ("2021-02", "P", "a", 3, 20.0, 30.0, 2),
        ("2021-12", "P", "a", 3, 40.0, 50.0, 4), ("2021-12", "P", "b", 3, 40.0, 50.0, 9),
        ("2022-01", "P", "a", 3, 50.0, 60.0, 5), ("2022-02", "P", "a", 18, 60.0, 60.0, 6),
        ("2022-02", "P", "b", 3, 20.0, 20.0, 1), ("2022-02", "Q", "c", 3, 20.0, 20.0, 2),
        ("2022-02", "Q", "b", 3, 20.0, 20.0, 2))


def test_category_growth_compares_five_months_and_masks_the_earlier_ones(base):
    out = tables.category_growth(base, PARAMS, with_december=True)
    assert rows(out, "period", "bucket", "amount", "share", "mom", "yoy", "ytd", "share_prev_year") == [
        (date(2020, 12, 1), "a", 10.0, 1.0, None, None, None, None),
        (date(2021, 2, 1), "a", 20.0, 1.0, None, None, None, None),
        (date(2021, 12, 1), "Other", 40.0, 0.5, None, None, None, None),
        (date(2021, 12, 1), "a", 40.0, 0.5, None, None, None, None),
        (date(2022, 1, 1), "a", 50.0, 1.0, None, None, None, None),
        (date(2022, 2, 1), "Other", 60.0, 0.5, None, None, 0.5, None),
        (date(2022, 2, 1), "a", 60.0, 0.5, pytest.approx(0.2), 2.0, 0.5, 1.0)]


def test_three_month_growth_is_not_masked(base):
    out = tables.category_growth(base, PARAMS, with_december=False)
    assert rows(out.filter("bucket = 'a'"), "period", "mom_real", "mom", "yoy") == [
        (date(2021, 2, 1), None, None, None),
        (date(2022, 1, 1), pytest.approx(0.2), 0.25, None),
        (date(2022, 2, 1), 0.0, pytest.approx(0.2), 2.0)]


def test_operations_by_year_use_the_years_own_top_or_a_given_one(base):
    own = tables.category_shares_by_year(base, PARAMS, "operations", share="operations")
    assert rows(own) == [(2021, "Other", 0.4), (2021, "b", 0.6),
                         (2022, "Other", pytest.approx(5 / 16)), (2022, "a", pytest.approx(11 / 16))]
    fixed = tables.category_shares_by_year(base, PARAMS, "operations", 2021, share="operations")
    assert rows(fixed.filter("year = 2022"), "bucket", "share") == [
        ("Other", pytest.approx(13 / 16)), ("b", pytest.approx(3 / 16))]


def test_main_category_keeps_ties(base):
    assert rows(tables.main_category(base), "province", "category", "share") == [
        ("P", "a", 0.75), ("Q", "b", 0.5), ("Q", "c", 0.5)]


def test_monthly_growth_needs_the_month_before(base):
    out = tables.monthly(base, "operations")
    assert rows(out, "period", "operations", "mom", "ytd") == [
        (date(2020, 12, 1), 1, None, None), (date(2021, 2, 1), 2, None, 1.0),
        (date(2021, 12, 1), 13, None, 12.0), (date(2022, 1, 1), 5, pytest.approx(5 / 13 - 1), pytest.approx(5 / 13 - 1)),
        (date(2022, 2, 1), 11, pytest.approx(1.2), pytest.approx(11 / 13 - 1))]
