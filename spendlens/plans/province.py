"""The province report and the merchant registry tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import day, distinct_count, ratio
from spendlens.operators.history import distinct_keys
from spendlens.operators.metrics import shares
from spendlens.operators.ranking import OTHER, top_per_group
from spendlens.plans import tables as t
from spendlens.plans.workspace import Workspace


def province_categories(ws: Workspace) -> DataFrame:
    return t.since(ws.base, ["province", "category"], ws.params.accumulate_from, "amount")


def top_in_province(ws: Workspace) -> DataFrame:
    return top_per_group(province_categories(ws), ["province"], "category", "amount",
                         ws.params.top_categories)


def category_shares_in_province(ws: Workspace) -> DataFrame:
    """Each province's own top categories and "Other"; the rank on the sums gives the bucket."""
    place = F.row_number().over(Window.partitionBy("province").orderBy(F.desc("amount"), "category"))
    bucket = F.when(F.col("_place") <= ws.params.top_categories, F.col("category")).otherwise(OTHER)
    lumped = (province_categories(ws).withColumn("_place", place)
              .groupBy("province", bucket.alias("bucket")).agg(F.sum("amount").alias("amount")))
    return shares(lumped, ["province"], share="amount")


def plan_shares_in_province(ws: Workspace) -> DataFrame:
    cells = t.since(ws.base, ["province", "category", "installments"],
                    ws.params.accumulate_from, "amount")
    main = cells.join(top_in_province(ws), ["province", "category"], "left_semi")
    return shares(main, ["province", "category"], share="amount")


def merchants_by_province(ws: Workspace) -> DataFrame:
    recent = ws.merchant_bitmaps.filter(F.col("period") >= day(ws.params.recent_from))
    return distinct_keys(recent, ["period", "province"], "merchants")


def registry_rows(ws: Workspace) -> DataFrame:
    total = ws.registry_merchants.agg(F.sum("registry_rows")).scalar()
    return ws.registry_merchants.withColumn("share", ratio(F.col("registry_rows"), total))


def _listing(ws: Workspace, rows: DataFrame, *order: str) -> DataFrame:
    """All rows, or the first ``listing_rows`` of them if a run asks for so few."""
    return rows if ws.params.listing_rows is None else rows.orderBy(*order).limit(ws.params.listing_rows)


def registry_duplicates(ws: Workspace) -> DataFrame:
    """Rows of the merchants listed more than once.

    The merchants are written: then both sides of the join are plain shuffles, which AQE can split for a
    merchant with very many rows.
    """
    keys = ws.registry_merchants.filter("registry_rows > 1")
    return _listing(ws, ws.table("merchant_registry").join(keys, "merchant_id", "left_semi"),
                    "merchant_id", "address", "legal_name", "province", "locality")


def registry_localities(ws: Workspace) -> DataFrame:
    return ws.table("merchant_registry").groupBy("province", "locality").agg(
        distinct_count("merchant_id").alias("merchants"))


def registry_addresses(ws: Workspace) -> DataFrame:
    rows = ws.table("merchant_registry").select("merchant_id", "province", "locality", "address").distinct()
    return _listing(ws, rows, "province", "locality", "merchant_id", "address")


TABLES = {
    "prov_share_amount": lambda ws: t.monthly_shares(
        ws.base, "province", "amount", ws.params.recent_from),
    "prov_share_ops": lambda ws: t.monthly_shares(
        ws.base, "province", "operations", ws.params.recent_from),
    "prov_top7": top_in_province,
    "prov_cat_share": category_shares_in_province,
    "prov_cat_plan": plan_shares_in_province,
    "merchants_prov": merchants_by_province,
    "registry_rows": registry_rows,
    "registry_dups": registry_duplicates,
    "registry_locality": registry_localities,
    "registry_address": registry_addresses,
}
