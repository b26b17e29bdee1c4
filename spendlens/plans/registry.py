"""All report tables by name, the bundles that are published together, and their row orders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlens.operators.ranking import other_last
from spendlens.plans import base, category, channel, merchants, monthly, province, weights

REPORTS = {
    "weights": weights.TABLES,
    "base": base.TABLES,
    "monthly": monthly.TABLES,
    "channel": channel.TABLES,
    "province": province.TABLES,
    "category": category.TABLES,
    "merchants": merchants.TABLES,
}

TABLES = {name: table for report in REPORTS.values() for name, table in report.items()}

_CHANNEL = ("cat_growth3", "cat_ops", "plan_share_cmp", "plan_in_cat_last", "ticket_ratio",
            "ticket_month", "prov_percap", "region_percap", "prov_main_cat")

# The tables each report publishes.
BUNDLES = {
    "monthly": (
        "m_nominal", "m_real", "m_ops", "cat_growth5_year", "cat_ops", "cat_ops_year_side",
        "plan_share_cmp", "plan_share_year", "plan_in_cat_last", "ticket_ratio", "ticket_month",
        "prov_growth", "region_growth", "prov_year_real", "prov_percap", "region_percap",
        "prov_main_cat"),
    "province": (
        "prov_share_amount", "prov_share_ops", "prov_cat_share", "prov_cat_plan",
        "merchants_prov", "registry_dups", "registry_locality", "registry_address"),
    "category": (
        "cat_share_amount", "cat_share_ops", "prov_in_cat", "merchant_share", "merchants_cat"),
    "platform": (
        "summary12", *[f"platform_{name}" for name in _CHANNEL], "platform_share",
        "minor_platform_prov"),
    "aggregator": (
        "aggregator_summary12", "aggregator_share", "aggregator_rank",
        *[f"aggregator_{name}" for name in _CHANNEL]),
    "merchants": (
        "merchants_since", "merchants_since_count", "merchants_new", "merchants_new_count",
        "merchants_new_rows"),
    "since": ("cat_share_since",),
    "checks": ("checks", "allocated", "reconcile", "category_coverage", "weights_sum",
               "weights_final_sum", "residual_weight_sum"),
}
HEADERLESS = ("aggregator_rank",)
PUBLISHED = {"aggregator_rank": ["aggregator"]}  # columns that are published, if not all
FROM_BASE = {"monthly", "province", "category", "since", "checks"}  # bundles that need the final base
FROM_HISTORY = {"province", "merchants"}  # bundles that need the merchants' history or bitmaps


def _orders() -> dict[str, list[Column]]:
    """Sort columns by table; a channel table without an entry uses the one of its short name."""
    def by(*names: str) -> list[Column]:
        return [F.col(name) for name in names]

    growth = [F.col("period"), *other_last("bucket", "amount")]
    return {
        "m_nominal": by("period"),
        "m_real": by("period"),
        "m_ops": by("period"),
        "summary12": by("period"),
        "deflator": by("period"),
        "ticket_month": by("period"),
        "top7_amount": [F.desc("amount"), F.col("category")],
        "top7_ops": [F.desc("operations"), F.col("category")],
        "cat_growth3": growth,
        "cat_growth5": growth,
        "cat_growth5_year": growth,
        "cat_ops": [F.col("period"), *other_last("bucket", "operations")],
        "cat_ops_year": [F.col("year"), *other_last("bucket", "share")],
        "cat_ops_year_side": by("rank"),
        "plan_share": by("period", "installments"),
        "plan_share_cmp": by("period", "installments"),
        "plan_share_year": by("year", "installments"),
        "plan_in_cat_last": by("period", "category", "installments"),
        "ticket": by("period", "category", "installments"),
        "ticket_ratio": by("period", "category", "installments"),
        "prov_growth": by("period", "province"),
        "region_growth": by("period", "region"),
        "prov_percap": by("period", "province"),
        "region_percap": by("period", "region"),
        "prov_main_cat": by("province"),
        "platform_share": by("period", "platform"),
        "aggregator_share": by("period", "aggregator", "amount"),
        "aggregator_rank": [F.desc("amount"), F.col("aggregator")],
        "prov_share_amount": by("period", "province"),
        "prov_share_ops": by("period", "province"),
        "prov_cat_share": [F.desc("share"), *by("province", "bucket")],
        "prov_in_cat": [F.desc("share"), *by("category", "province")],
        "merchants_prov": [F.col("period"), F.desc("merchants"), F.col("province")],
        "registry_rows": [F.desc("registry_rows"), F.col("merchant_id")],
        "registry_locality": by("province", "locality"),
        "registry_dups": by("merchant_id", "address", "legal_name", "province", "locality"),
        "registry_address": by("province", "locality", "merchant_id", "address"),
        "merchant_share": [F.col("category"), (F.col("bucket") == "Rest").asc(), F.desc("share_amount"),
                           F.col("merchant_id")],
        "merchants_cat": by("category"),
        "prov_cat_plan": by("province", "category", "installments"),
        "prov_year_real": by("year", "province"),
        "cat_share_amount": by("period", "category"),
        "cat_share_ops": by("period", "category"),
        "cat_share_since": by("category"),
        "minor_platform_prov": by("period", "province"),
        "allocated": by("period", "province", "installments", "category"),
    }


def order_of(name: str) -> list[Column]:
    """Sort columns of a published table, or none: only publishing sorts."""
    orders = _orders()
    short = name.removeprefix("platform_").removeprefix("aggregator_")
    return orders.get(name, orders.get(short, []))
