"""Tables of the weights stage: domains, filler rows, sums by dimension, weights and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.exprs import any_null, day
from spendlens.operators import checks, clean, weights
from spendlens.operators.metrics import sums
from spendlens.plans.workspace import Workspace
from spendlens.sources.sinks import split


def plan_domain(ws: Workspace) -> DataFrame:
    return ws.dominant_sales.select("installments").distinct()


def dim_domain(ws: Workspace) -> DataFrame:
    """Distinct values of each text dimension of the payments and the platform rows."""
    domains = {
        "payments": (ws.clean, ["category", "province", "payment_brand"]),
        "platform_sales": (ws.learning_filled, ["category", "platform", "province"]),
    }
    return reduce(DataFrame.unionByName, [
        clean.distinct_values(df, columns).select(F.lit(name).alias("extract"), "dimension", "value")
        for name, (df, columns) in domains.items()])


def all_plans_domain(ws: Workspace) -> DataFrame:
    """Plans over all platforms."""
    return ws.table("platform_sales").select("installments").distinct()


def channel_domain(ws: Workspace) -> DataFrame:
    """Distinct values of the text dimensions of the channel reports."""
    return reduce(DataFrame.unionByName, [
        clean.distinct_values(cube, ["category", channel]).select(
            F.lit(channel).alias("extract"), "dimension", "value")
        for channel, cube in (("platform", ws.platform_base), ("aggregator", ws.aggregator_base))])


def base_domain(ws: Workspace) -> DataFrame:
    """Distinct brands, categories, plans and months of the final base, all as text."""
    dimensions = ["payment_brand", "category", "installments", "period"]
    rows = ws.final_base.select(*dimensions).distinct()
    return clean.distinct_values(rows.select(*[F.col(c).cast("string") for c in dimensions]), dimensions)


def null_rows(ws: Workspace) -> DataFrame:
    return clean.incomplete_rows(ws.table("payments"))


def sale_null_rows(ws: Workspace) -> DataFrame:
    return clean.incomplete_rows(ws.table("platform_sales"))


def base_null_rows(ws: Workspace) -> DataFrame:
    return clean.incomplete_rows(ws.final_base)


def null_rows_count(ws: Workspace) -> DataFrame:
    frames = {"payments": ws.table("payments"), "platform_sales": ws.learning_raw,
              "platform_channel": ws.platform_rows, "final_base": ws.final_base}
    return checks.check_table([
        checks.violations(df, **{name: any_null(df.columns)}) for name, df in frames.items()])


def missing_plan_months(ws: Workspace) -> DataFrame:
    return clean.missing_plan_months(ws.learning_cells, ws.params.fill_plan, ws.params.fill_after)


def filled_platforms(ws: Workspace) -> DataFrame:
    return ws.learning_filled


def remapped(ws: Workspace) -> DataFrame:
    return clean.remap_category(ws.learning_filled, ws.params.synonyms)


def by_province_month(ws: Workspace) -> DataFrame:
    return sums(ws.learning, ["period", "platform", "province"], "operations", "amount")


def split_province(ws: Workspace) -> DataFrame:
    """The province table written as one folder per province and read back."""
    path = f"{ws.stage.root}/split_province"
    df = by_province_month(ws)
    split(df, "province", path)
    return ws.spark.read.schema(df.schema).parquet(path)


def by_category_month(ws: Workspace) -> DataFrame:
    return sums(ws.learning, ["period", "category"], "operations", "amount")


def by_plan_month(ws: Workspace) -> DataFrame:
    return sums(ws.learning, ["period", "platform", "installments"], "operations", "amount")


def category_coverage(ws: Workspace) -> DataFrame:
    return checks.coverage(ws.learning, ws.table("category_list"), "category",
                           ("observed", "listed"))


def weights_table(ws: Workspace) -> DataFrame:
    return ws.weights_observed


def weights_sum(ws: Workspace) -> DataFrame:
    return weights.weight_sums(ws.weights_observed)


def weight_series(ws: Workspace) -> DataFrame:
    return (ws.weights_observed.filter(F.col("installments").isin(list(ws.params.series_plans)))
            .select("installments", "category", "period", "share_operations", "share_amount"))


def weights_overlap(ws: Workspace) -> DataFrame:
    """Months that both the observed and the back-cast part cover: none is right."""
    observed = ws.weights_observed.filter(F.col("period") >= day(ws.params.actual_from))
    months = checks.coverage(observed, ws.weights_past, "period", ("observed", "past"))
    return (months.agg(F.count_if(F.col("observed") & F.col("past")).alias("months"))
            .withColumn("overlap", F.col("months") > 0))


TABLES = {
    "plan_domain": plan_domain,
    "dim_domain": dim_domain,
    "all_plans_domain": all_plans_domain,
    "channel_domain": channel_domain,
    "base_domain": base_domain,
    "sale_null_rows": sale_null_rows,
    "base_null_rows": base_null_rows,
    "null_rows": null_rows,
    "null_rows_count": null_rows_count,
    "missing_plan_months": missing_plan_months,
    "filled_platforms": filled_platforms,
    "remapped": remapped,
    "by_province_month": by_province_month,
    "split_province": split_province,
    "by_category_month": by_category_month,
    "by_plan_month": by_plan_month,
    "category_coverage": category_coverage,
    "weights": weights_table,
    "weights_sum": weights_sum,
    "weight_series": weight_series,
    "early_weights": lambda ws: ws.weights_early,
    "backcast": lambda ws: ws.weights_past,
    "weights_final": lambda ws: ws.weights,
    "weights_overlap": weights_overlap,
    "weights_final_sum": lambda ws: weights.weight_sums(ws.weights),
}
