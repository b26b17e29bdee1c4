"""Tables of the base stage: clean payments, reallocation, reconciliation, deflator, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.exprs import any_null, day
from spendlens.operators import allocate, checks, weights
from spendlens.operators.clean import remap_category
from spendlens.plans.workspace import Workspace


MEASURES = ("amount", "operations")


def residual_domain(ws: Workspace) -> DataFrame:
    return (ws.clean.filter(F.col("category").isin(list(ws.params.residual_categories)))
            .select("province", "category", "payment_brand").distinct())


def single_platform(ws: Workspace) -> DataFrame:
    return ws.weights.agg(F.count_distinct("platform").alias("platforms")).withColumn(
        "single", F.col("platforms") == 1)


def residual_weight_sum(ws: Workspace) -> DataFrame:
    joined = allocate.attach_weights(ws.residual, ws.weights)
    return joined.groupBy(*allocate.CELL).agg(
        *[F.round(F.sum(c), 6).alias(c) for c in weights.WEIGHT_SHARES])


def _both_sides(ws: Workspace) -> DataFrame:
    """Final base and clean payments as columns of the same rows, with the numbers of faulty rows.

    The payments are not read: their cells hold the sums of all, and of the classified rows. A base that
    was not loaded is those plus the allocated rows.
    """
    cells, allocated = ws.payment_cells, ws.allocated
    money = cells.schema["amount"].dataType
    raw = cells.select(*allocate.CELL, *[F.col(m).alias(f"{m}_raw") for m in MEASURES],
                       *([] if ws.base_loaded else [F.col(f"{m}_classified").alias(f"{m}_clean") for m in MEASURES]),
                       "clean_rows", "null_rows", "undated_rows")
    lost = F.col("category").isNull()
    spread = allocated.select(
        *allocate.CELL, lost.cast("long").alias("lost_rows"), F.when(lost, F.col("amount_total")).alias("lost_amount"),
        *([] if ws.base_loaded else _base_side(allocated, money)))
    sides = raw.unionByName(spread, allowMissingColumns=True)
    if ws.base_loaded:
        sides = sides.unionByName(ws.final_base.select(*allocate.CELL, *_base_side(ws.final_base, money)),
                                  allowMissingColumns=True)
    return checks.compare_sums(sides, allocate.CELL, counts=(
        "clean_rows", "null_rows", "undated_rows", "lost_rows", "lost_amount", "base_rows", "base_null_rows"))


def _base_side(rows: DataFrame, money: T.DataType) -> list[Column]:
    """Rows of a base as one side: cleaning leaves no nulls in payments, but allocated rows may hold some."""
    return [F.col("amount").cast(money).alias("amount_clean"), F.col("operations").alias("operations_clean"),
            F.lit(1).alias("base_rows"),
            any_null([*allocate.CELL, "category", *MEASURES]).cast("long").alias("base_null_rows")]


def _compared() -> Column:
    """Cells that either side has; others hold faulty payments only."""
    return (F.coalesce("clean_rows", F.lit(0)) > 0) | (F.coalesce("base_rows", F.lit(0)) > 0)


def reconcile(ws: Workspace) -> DataFrame:
    """Final base against clean payments."""
    return _both_sides(ws).filter(_compared()).drop(
        "clean_rows", "null_rows", "undated_rows", "lost_rows", "lost_amount", "base_rows", "base_null_rows")


def _months(ws: Workspace) -> DataFrame:
    """Which tables hold each month."""
    p, cells, observed = ws.params, ws.learning_cells, ws.weights_observed
    after = F.col("period") > day(p.fill_after)
    past = F.col("period").between(day(p.backcast_from), day(p.backcast_to)) & (F.dayofmonth("period") == 1)
    return checks.membership({
        "base": ws.base, "indexed": ws.table("price_index"), "sold": ws.table("merchant_sales"), "weighted": ws.weights,
        "learnt": cells.filter(after), "planned": cells.filter(after & (F.col("installments") == p.fill_plan)),
        "early": observed.filter(F.col("period") <= day(p.early_until)),
        "twice": observed.filter((F.col("period") >= day(p.actual_from)) & past),
    }, ["period"])


def _names(ws: Workspace) -> DataFrame:
    """Which tables hold each category and province."""
    def named(kind: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.col(kind).alias("name"))

    return checks.membership({
        "observed": named("category", remap_category(ws.learning_cells, ws.params.synonyms)),
        "listed": named("category", ws.table("category_list")),
        "used": named("province", ws.base), "counted": named("province", ws.table("population")),
    }, ["kind", "name"])


def checks_table(ws: Workspace) -> DataFrame:
    """One row per invariant with its number of violations; lost spend is an amount.

    Each invariant is a condition on the rows of one of a few tables that hold all sides of it: cells,
    months, names, weights. So a written table is read once or twice, and payments not at all. Text
    inputs with malformed lines add a row each.
    """
    shares = ws.weights.groupBy("period", "installments").agg(
        *[F.round(F.sum(c), 6).alias(c) for c in weights.WEIGHT_SHARES],
        F.min("platform").alias("first"), F.max("platform").alias("last"))
    off_one = (F.abs(F.col("share_operations") - 1) > 1e-6) | (F.abs(F.col("share_amount") - 1) > 1e-6)
    no = F.lit(False)
    single = F.coalesce(F.min("first") == F.max("last"), no)
    category, province = F.col("kind") == "category", F.col("kind") == "province"
    malformed = getattr(ws.inputs, "malformed", lambda: None)()
    return checks.check_table([
        *([malformed] if malformed is not None else []),
        checks.totals(
            _both_sides(ws),
            payments_null_rows=F.sum("null_rows"), periods_not_first=F.sum("undated_rows"),
            base_null_rows=F.sum("base_null_rows"), residual_without_weight=F.sum("lost_rows"),
            residual_amount_lost=F.round(F.sum("lost_amount")),
            amounts_off=F.count_if(_compared() & ~F.coalesce("amount_equal", no))),
        checks.totals(
            _months(ws),
            months_without_plan=F.count_if(F.col("learnt") & ~F.col("planned")),
            months_without_index=F.count_if(F.col("base") & ~F.col("indexed")),
            merchant_months_without_weight=F.count_if(F.col("sold") & ~F.col("weighted")),
            weights_overlap=F.bool_or("twice") & F.bool_or("early")),
        checks.totals(
            _names(ws),
            category_unlisted=F.count_if(category & ~F.col("listed")),
            category_unobserved=F.count_if(category & ~F.col("observed")),
            province_without_population=F.count_if(province & ~F.col("counted") & F.col("used"))),
        checks.totals(shares, weights_off_one=F.count_if(off_one), several_platforms=~single),
        checks.totals(ws.learning_counts, platform_null_rows=F.sum("null_rows")),
    ])


TABLES = {
    "clean": lambda ws: ws.clean,
    "residual_domain": residual_domain,
    "single_platform": single_platform,
    "residual": lambda ws: ws.residual,
    "residual_weight_sum": residual_weight_sum,
    "allocated": lambda ws: ws.allocated,
    "final_base": lambda ws: ws.final_base,
    "reconcile": reconcile,
    "deflator": lambda ws: ws.deflator,
    "checks": checks_table,
}
