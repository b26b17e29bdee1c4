from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from frames import rows
from spendlens.functions.exprs import day, half_even, money, not_in, ratio
from spendlens.operators import clean

SALE = ("period date, platform string, province string, category string, installments int, "
        "operations bigint, amount decimal(28,4)")
PAYMENT = ("period date, province string, category string, payment_brand string, "
           "installments int, operations bigint, amount decimal(28,4)")


def test_clean_payments_drops_late_odd_null_and_empty_rows(frame):
    df = frame(PAYMENT,
               ("2022-08", "P", "C", "B", 3, 1, 5.0),
               ("2022-09", "P", "C", "B", 3, 1, 5.0),
               ("2022-08", "P", "C", "B", 9, 1, 5.0),
               ("2022-08", "P", "C", None, 3, 1, 5.0),
               ("2022-08", "P", "C", "B", 3, 1, 0.0))
    kept = clean.clean_payments(df, "2022-08-01", (3, 6, 12, 18, 24))
    assert rows(kept, "period", "installments", "amount") == [(date(2022, 8, 1), 3, 5.0)]
    assert clean.incomplete_rows(df).count() == 1


def test_remap_merges_names_and_keeps_nulls_and_rows(frame):
    df = frame("category string, n int", ("a", 1), ("b", 2), ("c", 3), (None, 4))
    out = clean.remap_category(df, {"a": "z", "b": "z"})
    assert rows(out) == [(None, 4), ("c", 3), ("z", 1), ("z", 2)]
    assert clean.remap_category(df, {}) is df


def test_fill_adds_one_row_per_key_and_missing_month(frame):
    df = frame(SALE,
               ("2021-08", "M", "P", "C", 3, 9, 9.0),   # not after the date: nothing to fill
               ("2021-09", "M", "P", "C", 24, 9, 9.0),  # has the plan
               ("2021-10", "M", "P", "C", 3, 9, 9.0),
               ("2021-11", "M", "Q", "C", 3, 9, 9.0))
    assert rows(clean.missing_plan_months(df, 24, "2021-08-01")) == [
        (date(2021, 10, 1),), (date(2021, 11, 1),)]
    filled = clean.fill_missing_plan(df, 24, "2021-08-01")
    added = filled.filter("installments = 24 and operations = 1")
    assert rows(added, "period", "province", "amount") == [
        (date(2021, 10, 1), "P", 1.0), (date(2021, 10, 1), "Q", 1.0),
        (date(2021, 11, 1), "P", 1.0), (date(2021, 11, 1), "Q", 1.0)]
    assert filled.count() == 8
    assert filled.columns == df.columns


def test_fill_adds_nothing_when_no_month_is_missing(frame):
    df = frame(SALE, ("2021-09", "M", "P", "C", 24, 9, 9.0))
    assert clean.fill_missing_plan(df, 24, "2021-08-01").count() == 1


def test_distinct_values_in_long_form(frame):
    df = frame("a string, b string", ("x", "1"), ("x", "2"), ("y", "2"))
    assert rows(clean.distinct_values(df, ["a", "b"])) == [
        ("a", "x"), ("a", "y"), ("b", "1"), ("b", "2")]


def test_rounding_is_half_to_even(frame):
    df = frame("x double", (0.5,), (1.5,), (2.5,), (-0.5,), (0.4999,))
    assert [r[0] for r in df.select(half_even(F.col("x"))).collect()] == [0.0, 2.0, 2.0, 0.0, 0.0]


def test_money_rounds_to_four_decimals_half_away_from_zero(frame):
    df = frame("x double", (1.00005,), (1.00004,), (-1.00005,), (None,), (7.5e15,), (0.0,))
    assert [None if r[0] is None else str(r[0]) for r in df.select(money(F.col("x"))).collect()] == [
        "1.0001", "1.0000", "-1.0001", None, "7500000000000000.0000", "0.0000"]


def test_ratio_by_zero_is_null(frame):
    df = frame("a bigint, b bigint", (1, 0), (1, 2), (1, None))
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5, None]


def test_not_in_keeps_nulls(frame):
    df = frame("c string", ("a",), ("b",), (None,))
    assert rows(df.filter(not_in(F.col("c"), ["a"]))) == [(None,), ("b",)]


def test_day_is_a_date(spark):
    assert spark.range(1).select(day("2022-08-01")).first()[0] == date(2022, 8, 1)
