from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import rows
from spendlens.operators import metrics, prices

SERIES = "period date, k string, amount decimal(28,4)"


def by_period(df, *columns):
    return {r[0]: tuple(None if v is None else float(v) for v in r[1:])
            for r in df.select("period", *columns).collect()}


def test_growth_looks_at_the_calendar_and_not_at_the_row_before(frame):
    df = frame(SERIES, ("2020-12", "a", 10.0), ("2021-03", "a", 20.0), ("2021-12", "a", 30.0),
               ("2022-01", "a", 60.0), ("2022-03", "a", 80.0))
    out = by_period(metrics.growth(df, ["k"], mom=("amount", "mom"), yoy=("amount", "yoy"),
                                   ytd=("amount", "ytd")), "mom", "yoy", "ytd")
    assert out[date(2020, 12, 1)] == (None, None, None)
    assert out[date(2021, 3, 1)] == (None, None, 1.0)
    assert out[date(2021, 12, 1)] == (None, 2.0, 2.0)
    assert out[date(2022, 1, 1)] == (1.0, None, 1.0)   # January: month before is December too
    assert out[date(2022, 3, 1)] == (None, 3.0, pytest.approx(80 / 30 - 1))


def test_growth_keeps_null_groups_together(frame):
    df = frame(SERIES, ("2022-01", None, 10.0), ("2022-02", None, 15.0), ("2022-02", "a", 1.0))
    out = metrics.growth(df, ["k"], mom=("amount", "mom"))
    assert rows(out.filter("k is null and period = date'2022-02-01'"), "mom") == [(0.5,)]


def test_growth_of_a_constant_series_is_zero(frame):
    months = [f"{y}-{m:02d}" for y in (2020, 2021) for m in range(1, 13)]
    df = frame(SERIES, *[(p, "a", 7.0) for p in months])
    out = by_period(metrics.growth(df, ["k"], mom=("amount", "mom"), yoy=("amount", "yoy"),
                                   ytd=("amount", "ytd")), "mom", "yoy", "ytd")
    assert out[date(2021, 12, 1)] == (0.0, 0.0, 0.0)


def test_shares_and_total_shares(frame):
    df = frame("g string, x bigint", ("a", 1), ("a", 3), ("b", 4), (None, 2))
    assert rows(metrics.shares(df, ["g"], s="x")) == [
        (None, 2, 1.0), ("a", 1, 0.25), ("a", 3, 0.75), ("b", 4, 1.0)]
    assert rows(metrics.total_shares(df, s="x"), "x", "s") == [
        (1, 0.1), (2, 0.2), (3, 0.3), (4, 0.4)]


def test_annual_shares_cover_all_asked_years(frame):
    df = frame(SERIES, ("2020-01", "a", 9.0), ("2021-01", "a", 1.0), ("2021-05", "b", 3.0),
               ("2022-05", "b", 3.0))
    assert rows(metrics.annual_shares(df, (2021, 2022), "k", share="amount")) == [
        (2021, "a", 1.0, 0.25), (2021, "b", 3.0, 0.75), (2022, "b", 3.0, 1.0)]


TICKET = "period date, category string, installments int, amount decimal(28,4), operations bigint"


def test_ticket_has_total_rows_and_ratio_on_the_upper_plan_only(frame):
    df = frame(TICKET, ("2022-01", "a", 3, 10.0, 2), ("2022-01", "a", 18, 40.0, 2),
               ("2022-01", "b", 18, 40.0, 0))
    tickets = metrics.average_ticket_with_total(df)
    assert rows(tickets, "category", "installments", "avg_ticket") == [
        ("a", "18", 20.0), ("a", "3", 5.0), ("a", "Total", 12.5),
        ("b", "18", None), ("b", "Total", None)]
    assert rows(metrics.ticket_ratio(tickets, 18, 3).filter("ratio_18_3 is not null"),
                "category", "installments", "ratio_18_3") == [("a", "18", 4.0)]


def test_per_capita_growth_starts_after_the_first_month(frame):
    df = frame("period date, province string, amount decimal(28,4)",
               ("2019-12", "P", 1.0), ("2020-01", "P", 10.0), ("2020-02", "P", 30.0),
               ("2020-02", "Q", 5.0))
    people = frame("province string, region string, population bigint", ("P", "R", 10))
    out = metrics.per_capita(df, people, "2020-01-01")
    assert rows(out, "period", "province", "amount_per_capita", "mom") == [
        (date(2020, 1, 1), "P", 1.0, None), (date(2020, 2, 1), "P", 3.0, 2.0),
        (date(2020, 2, 1), "Q", None, None)]
    regions = metrics.per_capita_by_region(out)
    assert rows(regions.filter("period = date'2020-02-01'"), "region", "population",
                "amount_per_capita") == [(None, None, None), ("R", 10, 3.0)]


def test_deflator_is_one_in_the_base_month(frame):
    index = frame("period date, index_level double",
                  ("2022-01", 50.0), ("2022-02", 100.0), ("2022-04", 200.0))
    table = prices.deflator(index, prices.base_month("2022-02-01"))
    assert rows(table, "index_rebased", "coef", "inflation_mom") == [
        (100.0, 1.0, 1.0), (200.0, 2.0, None), (50.0, 0.5, None)]
    sales = frame(SERIES, ("2022-01", "a", 10.0), ("2022-04", "a", 10.0), ("2023-01", "a", 10.0))
    assert rows(prices.deflate(sales, table), "period", "amount_real") == [
        (date(2022, 1, 1), 20.0), (date(2022, 4, 1), 5.0), (date(2023, 1, 1), None)]


def test_default_base_month_is_the_month_before_today(spark):
    def base(today):
        return spark.range(1).select(prices.base_month(None, today)).first()[0]
    assert base(date(2022, 3, 31)) == date(2022, 2, 1)
    assert base(date(2022, 1, 5)) == date(2021, 12, 1)
    current = spark.range(1).select(
        (prices.base_month() < F.current_date()) & (F.dayofmonth(prices.base_month()) == 1))
    assert current.first()[0]
