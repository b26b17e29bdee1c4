"""The monthly report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.metrics import annual_shares, per_capita, per_capita_by_region
from spendlens.operators.ranking import mask_before, other_last, side_by_side
from spendlens.plans import tables as t
from spendlens.plans.workspace import Workspace


def growth_and_year_shares(ws: Workspace) -> DataFrame:
    """Category growth plus, on the latest month's rows, the annual shares of both years."""
    latest = ws.latest("base")
    wide = t.category_growth(ws.base, ws.params, with_december=True, latest=latest)
    columns = {f"{name}_y{i}": F.max(F.when(F.col("year") == year, F.col(name)))
               for i, year in enumerate(ws.params.years, start=1) for name in ("share_real", "share")}
    yearly = year_shares(ws).groupBy("bucket").agg(*[c.alias(name) for name, c in columns.items()])
    return mask_before(wide.join(yearly, "bucket", "left"), latest, list(columns))


def year_shares(ws: Workspace) -> DataFrame:
    return t.category_shares_by_year(ws.base, ws.params, "amount",
                                     share_real="amount_real", share="amount")


def operations_year_shares(ws: Workspace) -> DataFrame:
    return t.category_shares_by_year(ws.base, ws.params, "operations",
                                     ws.params.operations_top_year, share="operations")


def operations_years_side_by_side(ws: Workspace) -> DataFrame:
    yearly = operations_year_shares(ws)
    first, second = (yearly.filter(F.col("year") == y).drop("year") for y in ws.params.years)
    return side_by_side(first, second, other_last("bucket", "share"))


def region_growth(ws: Workspace) -> DataFrame:
    regions = ws.table("population").select("province", "region")
    return t.place_growth(ws.base.join(regions, "province", "left"), "region", ws.latest("base"))


def population_total(ws: Workspace) -> DataFrame:
    return ws.table("population").agg(F.sum("population").alias("population"))


def provinces_per_capita(ws: Workspace) -> DataFrame:
    return per_capita(ws.base, ws.table("population"), ws.params.recent_from)


TABLES = {
    "m_nominal": lambda ws: t.monthly(ws.base, "amount"),
    "m_real": lambda ws: t.monthly(ws.base, "amount_real"),
    "m_ops": lambda ws: t.monthly(ws.base, "operations"),
    "top7_amount": lambda ws: t.top_categories(ws.base, ws.params, "amount", latest=ws.latest("base")),
    "top7_ops": lambda ws: t.top_categories(ws.base, ws.params, "operations", latest=ws.latest("base")),
    "top7_amount_year": lambda ws: t.top_categories_by_year(ws.base, ws.params, "amount"),
    "top7_ops_year": lambda ws: t.top_categories_by_year(ws.base, ws.params, "operations"),
    "cat_growth5": lambda ws: t.category_growth(ws.base, ws.params, with_december=True, latest=ws.latest("base")),
    "cat_year_share": year_shares,
    "cat_growth5_year": growth_and_year_shares,
    "cat_growth3": lambda ws: t.category_growth(ws.base, ws.params, with_december=False, latest=ws.latest("base")),
    "cat_ops": lambda ws: t.category_operations(ws.base, ws.params, latest=ws.latest("base")),
    "cat_ops_year": operations_year_shares,
    "cat_ops_year_side": operations_years_side_by_side,
    "plan_share": lambda ws: t.plan_shares(ws.base),
    "plan_share_cmp": lambda ws: t.plan_shares_compared(ws.base, latest=ws.latest("base")),
    "plan_share_year": lambda ws: t.plan_shares_by_year(ws.base, ws.params),
    "plan_in_cat": lambda ws: t.plan_shares_in_category(ws.base, ws.params, latest=ws.latest("base")),
    "plan_in_cat_last": lambda ws: t.plan_shares_in_category_latest(ws.base, ws.params, latest=ws.latest("base")),
    "ticket": lambda ws: t.tickets(ws.base, ws.params, latest=ws.latest("base")),
    "ticket_ratio": lambda ws: t.tickets_with_ratio(ws.base, ws.params, latest=ws.latest("base")),
    "ticket_month": lambda ws: t.tickets_by_month(ws.base),
    "prov_growth": lambda ws: t.place_growth(ws.base, "province", latest=ws.latest("base")),
    "region_growth": region_growth,
    "prov_year_real": lambda ws: annual_shares(
        ws.base, ws.params.years[1:], "province", share_real="amount_real"),
    "pop_total": population_total,
    "prov_percap": provinces_per_capita,
    "region_percap": lambda ws: per_capita_by_region(provinces_per_capita(ws)),
    "prov_main_cat": lambda ws: t.main_category(ws.base, latest=ws.latest("base")),
}
