"""Report tables that several reports share: functions of a deflated base.

``latest`` is the base's last month as a scalar, from the written calendar of a run; without it the base
is read once more for each use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import day
from spendlens.operators.metrics import (
    annual_shares, average_ticket_with_total, growth, ratio, shares, sums, ticket_ratio, value_at)
from spendlens.operators.ranking import (
    OTHER, in_latest_month, keep_comparison_months, largest_in_group, latest_month, lump_other,
    mask_before, only_items, top_items, top_per_group)
from spendlens.params import Params


def monthly(base: DataFrame, measure: str) -> DataFrame:
    return growth(sums(base, ["period"], measure), [],
                  mom=(measure, "mom"), ytd=(measure, "ytd"))


def summary(base: DataFrame) -> DataFrame:
    """Operations, nominal and real amount by month, each with monthly and yearly growth."""
    measures = ("operations", "amount", "amount_real")
    named = {f"{kind}_{m}": (m, kind) for kind in ("mom", "yoy") for m in measures}
    return growth(sums(base, ["period"], *measures), [], **named)


def top_categories(base: DataFrame, params: Params, measure: str, latest: Column | None = None) -> DataFrame:
    return top_items(in_latest_month(base, latest), "category", measure, params.top_categories)


def top_categories_by_year(base: DataFrame, params: Params, measure: str) -> DataFrame:
    year = F.year("period")
    yearly = sums(base.filter(year.isin(list(params.years))), [year.alias("year"), "category"], measure)
    return top_per_group(yearly, ["year"], "category", measure, params.top_categories)


def category_growth(base: DataFrame, params: Params, with_december: bool,
                    latest: Column | None = None) -> DataFrame:
    """Top categories and "Other" in the comparison months, with share and growth.

    With December the growth columns also compare with the previous December and only the latest
    month shows them.
    """
    latest = latest_month(base) if latest is None else latest
    top = top_categories(base, params, "amount", latest)
    buckets = sums(lump_other(base, top, bounded=True), ["period", "bucket"],
                   "amount_real", "amount")
    kinds = ("mom", "yoy", "ytd") if with_december else ("mom", "yoy")
    named = {f"{kind}_real": ("amount_real", kind) for kind in kinds}
    named |= {kind: ("amount", kind) for kind in kinds}
    grown = growth(shares(buckets, ["period"], share="amount"), ["bucket"], **named).withColumn(
        "share_prev_year", value_at("share", ["bucket"], "yoy"))
    kept = keep_comparison_months(grown, latest, with_december)
    return mask_before(kept, latest, [*named, "share_prev_year"]) if with_december else kept


def category_operations(base: DataFrame, params: Params, latest: Column | None = None) -> DataFrame:
    latest = latest_month(base) if latest is None else latest
    top = top_categories(base, params, "operations", latest)
    buckets = sums(lump_other(base, top, bounded=True), ["period", "bucket"], "operations")
    grown = growth(shares(buckets, ["period"], share="operations"), ["bucket"],
                   mom=("operations", "mom"), yoy=("operations", "yoy"))
    return keep_comparison_months(
        grown.withColumn("share_prev_year", value_at("share", ["bucket"], "yoy")), latest)


def category_shares_by_year(base: DataFrame, params: Params, rank_by: str,
                            top_year: int | None = None, **named: str) -> DataFrame:
    """Shares of each year's top categories and "Other"; ``top_year`` applies one year's ranking
    to all years.

    The yearly sums hold one row per year and category, so the bucket is a rank on them and no
    list has to be joined back.
    """
    year = F.year("period")
    measures = list(dict.fromkeys([rank_by, *named.values()]))
    yearly = sums(base.filter(year.isin(list(params.years))), [year.alias("year"), "category"], *measures)
    ranked = yearly.withColumn("_place", F.row_number().over(
        Window.partitionBy("year").orderBy(F.desc(rank_by), "category")))
    if top_year is not None:
        ranked = ranked.withColumn("_place", F.max(
            F.when(F.col("year") == top_year, F.col("_place"))).over(Window.partitionBy("category")))
    bucket = F.when(F.col("_place") <= params.top_categories, F.col("category")).otherwise(OTHER)
    lumped = ranked.groupBy("year", bucket.alias("bucket")).agg(
        *[F.sum(m).alias(m) for m in measures])
    return shares(lumped, ["year"], **named).select("year", "bucket", *named)


def plan_shares(base: DataFrame) -> DataFrame:
    return shares(sums(base, ["period", "installments"], "amount"), ["period"], share="amount")


def plan_shares_compared(base: DataFrame, latest: Column | None = None) -> DataFrame:
    return keep_comparison_months(plan_shares(base), latest_month(base) if latest is None else latest)


def plan_shares_by_year(base: DataFrame, params: Params) -> DataFrame:
    return annual_shares(base, params.years, "installments", share_real="amount_real")


def plan_shares_in_category(base: DataFrame, params: Params, latest: Column | None = None) -> DataFrame:
    rows = only_items(base, top_categories(base, params, "amount", latest))
    return shares(sums(rows, ["period", "category", "installments"], "amount"),
                  ["period", "category"], share="amount")


def plan_shares_in_category_latest(base: DataFrame, params: Params, latest: Column | None = None) -> DataFrame:
    latest = latest_month(base) if latest is None else latest
    return plan_shares_in_category(base, params, latest).filter(F.col("period") == latest)


def tickets(base: DataFrame, params: Params, latest: Column | None = None) -> DataFrame:
    latest = latest_month(base) if latest is None else latest
    rows = only_items(base, top_categories(base, params, "amount", latest))
    grown = growth(average_ticket_with_total(rows), ["category", "installments"],
                   mom=("avg_ticket", "mom"), yoy=("avg_ticket", "yoy"))
    return keep_comparison_months(grown, latest)


def tickets_with_ratio(base: DataFrame, params: Params, latest: Column | None = None) -> DataFrame:
    return ticket_ratio(tickets(base, params, latest), *params.ratio_plans)


def tickets_by_month(base: DataFrame) -> DataFrame:
    return base.groupBy("period").agg(
        ratio(F.sum("amount"), F.sum("operations")).alias("avg_ticket"))


def place_growth(base: DataFrame, place: str, latest: Column | None = None) -> DataFrame:
    """Amount, share and growth of each place in the comparison months, growth masked."""
    by_place = shares(sums(base, ["period", place], "amount"), ["period"], share="amount")
    grown = growth(by_place, [place], mom=("amount", "mom"), yoy=("amount", "yoy"),
                   ytd=("amount", "ytd"))
    latest = latest_month(base) if latest is None else latest
    return mask_before(keep_comparison_months(grown, latest, True), latest, ["mom", "yoy", "ytd"])


def main_category(base: DataFrame, latest: Column | None = None) -> DataFrame:
    """The category with the largest amount of each province in the latest month."""
    rows = sums(in_latest_month(base, latest), ["period", "province", "category"], "amount")
    return largest_in_group(shares(rows, ["period", "province"], share="amount"),
                            ["province"], "amount")


def monthly_shares(base: DataFrame, dimension: str, measure: str, since: str) -> DataFrame:
    recent = base.filter(F.col("period") >= day(since))
    return shares(sums(recent, ["period", dimension], measure), ["period"], share=measure)


def member_shares(base: DataFrame, dimension: str) -> DataFrame:
    """Monthly amount and operations of each platform or aggregator, with both shares."""
    return shares(sums(base, ["period", dimension], "amount", "operations"), ["period"],
                  share_amount="amount", share_operations="operations")


def since(base: DataFrame, keys: Sequence[str], start: str, *measures: str) -> DataFrame:
    return sums(base.filter(F.col("period") >= day(start)), keys, *measures)
