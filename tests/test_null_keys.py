"""Null categories and merchants are counted, ranked and listed alike; an index needs its base month."""

from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from spendlens.functions.exprs import distinct_count
from spendlens.operators import checks, prices, ranking


def test_null_item_of_the_top_list_keeps_its_own_bucket(frame):
    df = frame("category string, amount double", ("a", 5.0), (None, 9.0), ("b", 1.0))
    top = ranking.top_items(df, "category", "amount", 2)
    assert rows(ranking.lump_other(df, top, bounded=True), "category", "bucket") == [
        (None, None), ("a", "a"), ("b", "Other")]
    assert rows(ranking.only_items(df, top), "category") == [(None,), ("a",)]


def test_counts_agree_with_listings(frame):
    df = frame("k string, merchant_id bigint", ("x", 1), ("x", None), ("x", 1), ("y", 2))
    assert rows(df.groupBy("k").agg(distinct_count("merchant_id").alias("n"))) == [("x", 2), ("y", 1)]
    assert df.filter("false").agg(distinct_count("merchant_id").alias("n")).first().n == 0


def test_an_index_without_its_base_month_is_an_error(frame):
    index = frame("period date, index_level double", ("2022-01", 1.0))
    with pytest.raises(Exception, match="base month"):
        prices.deflator(index, prices.base_month("2022-02-01")).collect()


def test_rows_of_new_keys_from_written_keys(frame):
    df = frame("period date, k string", ("2022-01", "a"), ("2022-02", "a"), ("2022-02", "b"), ("2022-03", "b"))
    new = checks.new_keys(df, "k", "2022-02-01")
    assert rows(checks.rows_of_new_keys(df, "k", "2022-02-01", new), "k") == rows(
        checks.rows_of_new_keys(df, "k", "2022-02-01"), "k") == [("b",), ("b",)]
