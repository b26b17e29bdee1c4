from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from frames import rows
from spendlens.functions.exprs import day
from spendlens.operators import checks, ranking

SERIES = "period date, category string, amount decimal(28,4)"


def test_top_items_break_ties_by_name(frame):
    df = frame(SERIES, ("2022-01", "b", 5.0), ("2022-01", "a", 5.0), ("2022-01", "c", 9.0))
    assert rows(ranking.top_items(df, "category", "amount", 2)) == [("a", 5.0), ("c", 9.0)]


def test_top_per_group_with_and_without_ties(frame):
    df = frame("g string, item string, x int", ("g", "a", 5), ("g", "b", 5), ("g", "c", 9), ("h", "a", 1))
    assert rows(ranking.top_per_group(df, ["g"], "item", "x", 2), "g", "item") == [
        ("g", "a"), ("g", "c"), ("h", "a")]
    assert rows(ranking.top_per_group(df, ["g"], "item", "x", 2, ties=True), "g", "item") == [
        ("g", "a"), ("g", "b"), ("g", "c"), ("h", "a")]
    assert rows(ranking.largest_in_group(df.filter("item <> 'c'"), ["g"], "x"), "g", "item") == [
        ("g", "a"), ("g", "b"), ("h", "a")]


def test_lump_sends_everything_else_and_nulls_to_other(frame):
    df = frame(SERIES, ("2022-01", "a", 1.0), ("2022-01", "b", 2.0), ("2022-01", None, 4.0))
    top = ranking.top_items(df.filter("category = 'a'"), "category", "amount", 1)
    out = ranking.lump_other(df, top, bounded=True)
    assert rows(out, "bucket", "amount") == [("Other", 2.0), ("Other", 4.0), ("a", 1.0)]


def test_latest_month_and_mask(frame):
    df = frame(SERIES, ("2022-01", "a", 1.0), ("2022-02", "a", 2.0))
    assert rows(ranking.in_latest_month(df), "amount") == [(2.0,)]
    masked = ranking.mask_before(df, ranking.latest_month(df), ["amount"])
    assert rows(masked, "period", "amount") == [(date(2022, 1, 1), None), (date(2022, 2, 1), 2.0)]


def test_comparison_months_for_every_latest_month(frame, spark):
    for month in range(1, 13):
        latest = date(2022, month, 1)
        months = spark.range(1).select(
            F.array(*ranking.comparison_months(day(latest.isoformat()), True)).alias("m")).first().m
        before = date(2022, month - 1, 1) if month > 1 else date(2021, 12, 1)
        assert months == [latest, before, date(2021, month, 1), date(2021, 12, 1), date(2020, 12, 1)]


def test_side_by_side_keeps_the_longer_table(frame):
    left = frame("bucket string, share double", ("a", 0.6), ("Other", 0.4))
    right = frame("bucket string, share double", ("b", 0.2), ("c", 0.3), ("Other", 0.5))
    out = ranking.side_by_side(left, right, ranking.other_last("bucket", "share"))
    assert rows(out, "rank", "bucket_y1", "bucket_y2") == [
        (1, "a", "c"), (2, "Other", "b"), (3, None, "Other")]


MERCHANT = "period date, merchant_id bigint, amount decimal(28,4)"


def test_new_keys_presence_and_rows(frame):
    df = frame(MERCHANT, ("2021-07", 1, 1.0), ("2021-08", 1, 2.0), ("2021-08", 2, 3.0),
               ("2021-09", 2, 4.0), ("2021-09", 3, 5.0), ("2021-06", 4, 6.0))
    assert rows(checks.presence(df, "merchant_id", "2021-08-01")) == [
        (1, "yes", "yes"), (2, None, "yes"), (4, "yes", None)]
    assert rows(checks.new_keys(df, "merchant_id", "2021-08-01"), "merchant_id") == [(2,)]
    assert rows(checks.rows_of_new_keys(df, "merchant_id", "2021-08-01"),
                "merchant_id", "amount") == [(2, 3.0), (2, 4.0)]


def test_repeated_keys_returns_all_their_rows(frame):
    df = frame("k bigint, v string", (1, "a"), (1, "b"), (2, "c"))
    assert rows(checks.repeated_keys(df, "k")) == [(1, "a"), (1, "b")]


def test_coverage_flags(frame):
    left = frame("category string", ("a",), ("a",), ("b",))
    right = frame("category string", ("b",), ("c",))
    assert rows(checks.coverage(left, right, "category", ("x", "y"))) == [
        ("a", True, False), ("b", True, True), ("c", False, True)]


def test_reconcile_shows_one_sided_keys_and_differences(frame):
    schema = "k string, amount decimal(28,4), operations bigint"
    left = frame(schema, ("a", 1.0, 1), ("a", 1.0, 1), ("b", 5.0, 3))
    right = frame(schema, ("a", 2.005, 2), ("b", 6.0, 1), ("c", 1.0, 1))
    out = checks.reconcile(left, right, ["k"])
    assert rows(out, "k", "amount_equal", "operations_equal", "operations_diff") == [
        ("a", True, True, 0), ("b", False, False, 2), ("c", None, None, None)]


def test_violations_are_counted_in_one_pass(frame):
    df = frame("x int", (1,), (2,), (None,))
    out = checks.violations(df, odd=F.col("x") % 2 == 1, missing=F.col("x").isNull())
    assert rows(out) == [("missing", 1), ("odd", 1)]


def test_null_measures_never_lead_a_group(frame):
    df = frame("g string, item string, x int", ("g", "a", None), ("g", "b", 1), (None, "c", None))
    assert rows(ranking.top_per_group(df, ["g"], "item", "x", 10, ties=True), "item") == [("b",)]
