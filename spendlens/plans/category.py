"""The category report and the merchant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.allocate import listed_ecommerce, split_by_weights
from spendlens.operators.metrics import shares, sums, total_shares
from spendlens.operators.ranking import top_per_group
from spendlens.plans import tables as t
from spendlens.plans.workspace import Workspace

REST = "Rest"
MEASURES = ("amount", "operations")


def _listed(ws: Workspace) -> DataFrame:
    return listed_ecommerce(ws.table("merchant_sales"), ws.registry_merchants.filter("registry_rows > 0"),
                            ws.params.ecommerce_category)


def ecommerce_merchants(ws: Workspace) -> DataFrame:
    return _listed(ws).select("merchant_id").distinct()


def ecommerce_spend(ws: Workspace) -> DataFrame:
    return _listed(ws).select("period", "province", "category", "merchant_id", "amount", "operations")


def ecommerce_reassigned(ws: Workspace) -> DataFrame:
    return split_by_weights(ecommerce_spend(ws), ws.market_weights, ws.params.amount_weight)


def province_shares_in_category(ws: Workspace) -> DataFrame:
    cells = t.since(ws.base, ["province", "category"], ws.params.accumulate_from, "amount")
    return shares(cells, ["category"], share="amount")


def merchants_by_category(ws: Workspace) -> DataFrame:
    """Sums of each merchant in each category; written once, as four tables start from it."""
    return ws.stage.table("merchant_totals", lambda: t.since(
        ws.merchant_base, ["category", "merchant_id"], ws.params.accumulate_from, *MEASURES))


def leading_merchants(ws: Workspace) -> DataFrame:
    return ws.stage.table("leading_merchants", lambda: top_per_group(
        merchants_by_category(ws), ["category"], "merchant_id", "amount",
        ws.params.top_merchants, ties=True))


def merchant_shares(ws: Workspace) -> DataFrame:
    """Leading merchants of each category and one "Rest" row, with shares and legal names.

    "Rest" is the category's total less its leaders, so the full list of merchants is reduced to
    the leaders before any join. Counted along with the sums: a category has a "Rest" row if it
    has merchants outside the leaders, and a null sum if none of them has a value.
    """
    leaders = leading_merchants(ws)
    known = {f"{m}_known": F.col(m).isNotNull().cast("long") for m in MEASURES}
    counted = [*MEASURES, "merchants", *known]
    every, top = (df.withColumns({"merchants": F.lit(1).cast("long"), **known})
                  for df in (merchants_by_category(ws), leaders))
    minus = top.select("category", *[(-F.col(m)).alias(m) for m in counted])
    rest = (sums(sums(every, ["category"], *counted).unionByName(minus), ["category"], *counted)
            .filter("merchants > 0")
            .select("category", F.lit(None).cast("long").alias("merchant_id"),
                    *[F.when(F.col(f"{m}_known") > 0, F.col(m)).alias(m) for m in MEASURES],
                    F.lit(REST).alias("bucket")))
    buckets = leaders.withColumn("bucket", F.col("merchant_id").cast("string")).unionByName(rest)
    shared = shares(buckets, ["category"], share_amount="amount", share_operations="operations")

    names = (ws.table("merchant_registry")
             .join(leaders.select("merchant_id").distinct(), "merchant_id", "left_semi")
             .groupBy("merchant_id").agg(F.min("legal_name").alias("legal_name")))
    since = ws.params.accumulate_from
    return (shared.join(names.withColumn("_listed", F.col("merchant_id")), "merchant_id", "left")
            .select("category", "bucket",
                    F.col("amount").alias(f"amount_since_{since}"),
                    F.col("operations").alias(f"operations_since_{since}"),
                    "share_amount", "share_operations",
                    F.col("_listed").alias("merchant_id"), "legal_name"))


def merchant_count_by_category(ws: Workspace) -> DataFrame:
    """Distinct merchants, a null one included: their totals have one row per category and merchant."""
    return merchants_by_category(ws).groupBy("category").agg(
        F.count(F.lit(1)).alias(f"merchants_since_{ws.params.accumulate_from}"))


def category_shares_since(ws: Workspace) -> DataFrame:
    totals = t.since(ws.base, ["category"], ws.params.accumulate_from, "operations", "amount")
    return total_shares(totals, share_operations="operations", share_amount="amount")


TABLES = {
    "ecom_merchants": ecommerce_merchants,
    "market_weights": lambda ws: ws.market_weights,
    "ecom_spend": ecommerce_spend,
    "ecom_reassigned": ecommerce_reassigned,
    "merchant_base": lambda ws: ws.merchant_base,
    "cat_share_amount": lambda ws: t.monthly_shares(
        ws.base, "category", "amount", ws.params.recent_from),
    "cat_share_ops": lambda ws: t.monthly_shares(
        ws.base, "category", "operations", ws.params.recent_from),
    "prov_in_cat": province_shares_in_category,
    "merchant_cat": merchants_by_category,
    "merchant_top10": leading_merchants,
    "merchant_share": merchant_shares,
    "merchants_cat": merchant_count_by_category,
    "cat_share_since": category_shares_since,
}
