"""The channel reports: e-commerce platforms and payment aggregators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.metrics import per_capita, per_capita_by_region, sums
from spendlens.operators.ranking import in_latest_month
from spendlens.plans import tables as t
from spendlens.plans.workspace import Workspace

# Tables that both channels publish, as functions of (workspace, channel cube, its latest month).
SHARED = {
    "summary12": lambda ws, b, m: t.summary(b),
    "cat_growth3": lambda ws, b, m: t.category_growth(b, ws.params, with_december=False, latest=m),
    "top7_amount": lambda ws, b, m: t.top_categories(b, ws.params, "amount", m),
    "top7_ops": lambda ws, b, m: t.top_categories(b, ws.params, "operations", m),
    "cat_ops": lambda ws, b, m: t.category_operations(b, ws.params, m),
    "plan_share": lambda ws, b, m: t.plan_shares(b),
    "plan_share_cmp": lambda ws, b, m: t.plan_shares_compared(b, m),
    "plan_in_cat": lambda ws, b, m: t.plan_shares_in_category(b, ws.params, m),
    "plan_in_cat_last": lambda ws, b, m: t.plan_shares_in_category_latest(b, ws.params, m),
    "ticket": lambda ws, b, m: t.tickets(b, ws.params, m),
    "ticket_ratio": lambda ws, b, m: t.tickets_with_ratio(b, ws.params, m),
    "ticket_month": lambda ws, b, m: t.tickets_by_month(b),
    "prov_percap": lambda ws, b, m: per_capita(b, ws.table("population"), ws.params.recent_from),
    "region_percap": lambda ws, b, m: per_capita_by_region(
        per_capita(b, ws.table("population"), ws.params.recent_from)),
    "prov_main_cat": lambda ws, b, m: t.main_category(b, m),
}


def minor_platforms(ws: Workspace) -> DataFrame:
    minor = ws.platform_base.filter(F.col("platform") != ws.params.dominant_platform)
    return sums(minor, ["period", "province", "platform"], "amount", "operations")


def aggregator_rank(ws: Workspace) -> DataFrame:
    """Aggregators of the latest month with their amounts; published in descending order."""
    return sums(in_latest_month(ws.aggregator_base, ws.latest("aggregator_base")), ["aggregator"], "amount")


def _bound(table, base: str):
    return lambda ws: table(ws, getattr(ws, base), ws.latest(base))


def _channel_tables(channel: str) -> dict:
    return {f"{channel}_{name}": _bound(table, f"{channel}_base")
            for name, table in SHARED.items()}


TABLES = {
    **_channel_tables("platform"),
    **_channel_tables("aggregator"),
    "platform_share": lambda ws: t.member_shares(ws.platform_base, "platform"),
    "minor_platform_prov": minor_platforms,
    "aggregator_domain": lambda ws: ws.other_aggregators.select("aggregator").distinct(),
    "aggregator_plan_domain": lambda ws: ws.other_aggregators.select("installments").distinct(),
    "aggregator_share": lambda ws: t.member_shares(ws.aggregator_base, "aggregator"),
    "aggregator_rank": aggregator_rank,
}
TABLES["summary12"] = TABLES.pop("platform_summary12")
