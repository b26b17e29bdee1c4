"""Category weights learnt from marketplace sales, and their extension into the past."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.exprs import day
from spendlens.operators.metrics import shares, sums

WEIGHT_SHARES = {"share_operations": "operations", "share_amount": "amount"}


def category_weights(df: DataFrame) -> DataFrame:
    """Share of each category in a (period, platform, plan) cell, by operations and amount."""
    cells = sums(df, ["period", "platform", "category", "installments"], "operations", "amount")
    return shares(cells, ["period", "platform", "installments"], **WEIGHT_SHARES)


def early_weights(weights: DataFrame, until: str) -> DataFrame:
    """Weights of the first months pooled."""
    pooled = sums(weights.filter(F.col("period") <= day(until)),
                  ["platform", "category", "installments"], "operations", "amount")
    return shares(pooled, ["platform", "installments"], **WEIGHT_SHARES)


def backcast_weights(early: DataFrame, first: str, last: str) -> DataFrame:
    """Every pooled row repeated for each calendar month of the past."""
    calendar = F.sequence(day(first), day(last), F.expr("interval 1 month"))
    return early.withColumn("period", F.explode(calendar))


def join_weights(weights: DataFrame, backcast: DataFrame, actual_from: str) -> DataFrame:
    return weights.filter(F.col("period") >= day(actual_from)).unionByName(backcast)


def weight_sums(weights: DataFrame) -> DataFrame:
    """Check table: shares must add up to one in every (period, plan)."""
    return weights.groupBy("period", "installments").agg(
        *[F.round(F.sum(name), 6).alias(name) for name in WEIGHT_SHARES])


def pooled_weights(weights: DataFrame) -> DataFrame:
    """Monthly weights with all plans and platforms pooled."""
    return shares(sums(weights, ["period", "category"], "operations", "amount"), ["period"],
                  **WEIGHT_SHARES).drop("operations", "amount")
