from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from frames import rows
from spendlens.operators import allocate, weights

PAYMENT = ("period date, province string, category string, payment_brand string, "
           "installments int, operations bigint, amount decimal(28,4)")
WEIGHT = ("period date, platform string, category string, installments int, operations bigint, "
          "amount decimal(28,4)")
MERCHANT = ("period date, province string, category string, merchant_id bigint, "
            "operations bigint, amount decimal(28,4)")
RESIDUAL = ("X", "Y")


def market(frame):
    return weights.category_weights(frame(
        WEIGHT,
        ("2022-01", "M", "a", 3, 98, 75.0), ("2022-01", "M", "b", 3, 1, 15.0),
        ("2022-01", "M", "c", 3, 1, 10.0), ("2022-01", "M", "a", 6, 1, 1.0)))


def test_weights_sum_to_one_in_each_plan(frame):
    assert rows(weights.weight_sums(market(frame))) == [
        (date(2022, 1, 1), 3, 1.0, 1.0), (date(2022, 1, 1), 6, 1.0, 1.0)]


def test_allocation_conserves_amounts_and_lifts_zero_operations_to_one(frame):
    clean = frame(PAYMENT,
                  ("2022-01", "P", "X", "v", 3, 20, 60.0), ("2022-01", "P", "Y", "m", 3, 20, 40.0),
                  ("2022-01", "P", "a", "v", 3, 7, 7.0))
    residual = allocate.residual_totals(clean, RESIDUAL)
    assert rows(residual) == [(date(2022, 1, 1), "P", 3, 100.0, 40)]
    out = allocate.allocate(residual, market(frame))
    assert rows(out, "category", "amount", "operations") == [
        ("a", 75.0, 39), ("b", 15.0, 1), ("c", 10.0, 1)]  # 39.2, 0.4 -> 0 -> 1
    assert rows(out, "check_amount", "check_operations") == [(100.0, 41)] * 3

    base = allocate.final_base(clean, out, RESIDUAL, "allocated")
    assert base.columns == clean.columns
    assert rows(base.groupBy("payment_brand").agg(F.sum("amount"))) == [
        ("allocated", 100.0), ("v", 7.0)]


def test_cell_without_weights_stays_with_null_category_and_amount(frame):
    clean = frame(PAYMENT, ("2022-02", "P", "X", "v", 3, 20, 60.0))
    out = allocate.allocate(allocate.residual_totals(clean, RESIDUAL), market(frame))
    assert rows(out, "category", "amount", "operations", "amount_total") == [
        (None, None, None, 60.0)]


def test_backcast_repeats_early_months_over_the_calendar(frame):
    observed = weights.category_weights(frame(
        WEIGHT,
        ("2020-04", "M", "a", 3, 1, 1.0), ("2020-05", "M", "a", 3, 1, 1.0),
        ("2020-05", "M", "b", 3, 2, 6.0), ("2020-10", "M", "b", 3, 50, 50.0)))
    early = weights.early_weights(observed, "2020-09-01")
    assert rows(early, "category", "share_operations", "share_amount") == [
        ("a", 0.5, 0.25), ("b", 0.5, 0.75)]
    past = weights.backcast_weights(early, "2015-01-01", "2020-03-01")
    assert past.count() == 2 * 63
    final = weights.join_weights(observed, past, "2020-04-01")
    assert final.count() == 2 * 63 + 4
    assert final.columns == observed.columns


REGISTRY = "merchant_id bigint, legal_name string"


def test_reassignment_splits_listed_merchants_only_and_keeps_all_spend(frame):
    sales = frame(MERCHANT,
                  ("2022-01", "P", "E", 1, 10, 100.0),   # listed twice in the registry
                  ("2022-01", "P", "E", 2, 5, 50.0),     # not listed: stays
                  ("2022-01", "P", "a", 1, 3, 30.0),     # other category: stays
                  ("2022-01", "P", None, 3, 1, 1.0))     # null category: stays
    registry = frame(REGISTRY, (1, "One"), (1, "One B"), (9, "Nine"))
    pooled = weights.pooled_weights(market(frame))
    out = allocate.reassign_merchants(sales, registry, pooled, "E", "operations")
    share_a, other = 99 / 101, 1 / 101
    assert rows(out, "merchant_id", "category", "amount", "operations") == sorted([
        (1, "a", 30.0, 3.0), (1, "a", round(100 * share_a, 4), round(10 * share_a, 4)),
        (1, "b", round(100 * other, 4), round(10 * other, 4)),
        (1, "c", round(100 * other, 4), round(10 * other, 4)),
        (2, "E", 50.0, 5.0), (3, None, 1.0, 1.0)], key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_reassignment_can_split_amounts_by_amount_share(frame):
    sales = frame(MERCHANT, ("2022-01", "P", "E", 1, 10, 101.0))
    registry = frame(REGISTRY, (1, "One"))
    pooled = weights.pooled_weights(market(frame))
    out = allocate.reassign_merchants(sales, registry, pooled, "E", "amount")
    assert rows(out, "category", "amount") == [("a", 76.0), ("b", 15.0), ("c", 10.0)]


def test_reassigned_month_without_weights_keeps_a_null_row(frame):
    sales = frame(MERCHANT, ("2022-07", "P", "E", 1, 10, 100.0))
    out = allocate.reassign_merchants(sales, frame(REGISTRY, (1, "One")),
                                      weights.pooled_weights(market(frame)), "E", "operations")
    assert rows(out, "merchant_id", "category", "amount") == [(1, None, None)]


def test_hot_merchant_is_split_like_any_other(frame, spark):
    """A third of all rows belong to one merchant; totals and distinct keys must be whole."""
    sales = (spark.range(3000).selectExpr(
        "date'2022-01-01' AS period", "concat('P', id % 5) AS province",
        "CASE WHEN id % 2 = 0 THEN 'E' ELSE 'a' END AS category",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS merchant_id",
        "CAST(1 AS BIGINT) AS operations", "CAST(101 AS DECIMAL(28,4)) AS amount"))
    registry = frame(REGISTRY, (1, "One"), (2, "Two"))
    out = allocate.reassign_merchants(sales, registry, weights.pooled_weights(market(frame)),
                                      "E", "operations")
    assert float(out.agg(F.sum("amount")).first()[0]) == 3000 * 101
    spend = {(r.province, r.merchant_id) for r in sales.collect() if r.category == "E"}
    hot = [key for key in spend if key[1] in (1, 2)]  # summed before they are split in three
    assert out.count() == 1500 + len(spend) + 2 * len(hot)
