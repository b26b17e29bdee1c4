"""Reallocation of unclassified spend with category weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import any_null, day, exact, half_even, money, not_in
from spendlens.operators.metrics import sums

CELL = ("period", "province", "installments")


def payment_cells(payments: DataFrame, cutoff: str, plans: Sequence[int], residual: Sequence[str]) -> DataFrame:
    """What every later step asks of the payments as a whole, per month, province and plan, in one pass.

    Sums of all clean rows (``amount``, ``operations``) and of the unclassified ones (``*_residual``) and
    classified ones (``*_classified``) among them, their numbers, a digest of the clean rows that does not
    depend on their order, and the numbers of faulty rows, which the checks report. These are sums of an
    aggregation and not metrics observed on the way, which a repeated task would count twice.
    """
    clean = F.coalesce((F.col("period") <= day(cutoff)) & F.col("installments").isin(list(plans))
                       & ~any_null(payments.columns) & (F.col("amount") > 0), F.lit(False))
    open_rows = clean & F.col("category").isin(list(residual))
    parts = {"": clean, "_residual": open_rows, "_classified": clean & ~open_rows}
    kinds = F.lit(payments.schema.simpleString())  # a change of schema changes every digest
    digest = F.xxhash64(*payments.columns, kinds).cast("decimal(38,0)")
    return payments.groupBy(*CELL).agg(
        *[F.sum(F.when(rows, F.col(m))).alias(f"{m}{name}") for name, rows in parts.items() for m in ("amount", "operations")],
        F.count_if(clean).alias("clean_rows"), F.count_if(open_rows).alias("residual_rows"),
        F.sum(F.when(clean, digest)).alias("digest"),
        F.count_if(any_null(payments.columns)).alias("null_rows"),
        F.count_if(F.dayofmonth("period") != 1).alias("undated_rows"))


def residual_cells(cells: DataFrame) -> DataFrame:
    """``residual_totals`` from the cells of the payments."""
    return cells.filter("residual_rows > 0").select(
        *CELL, F.col("amount_residual").alias("amount"), F.col("operations_residual").alias("operations"))


def residual_totals(clean: DataFrame, residual: Sequence[str]) -> DataFrame:
    return sums(clean.filter(F.col("category").isin(list(residual))), CELL, "amount", "operations")


def attach_weights(residual: DataFrame, weights: DataFrame) -> DataFrame:
    """Residual cells fanned out over the categories of their (period, plan).

    A left join: a cell without weights stays, with null category and amounts. Fan-out is the
    number of categories, whatever the input size.
    """
    totals = residual.withColumnsRenamed(
        {"amount": "amount_total", "operations": "operations_total"})
    return totals.join(weights.drop("operations", "amount"), ["period", "installments"], "left")


def allocate(residual: DataFrame, weights: DataFrame) -> DataFrame:
    """Split each cell: amounts by amount share, operations rounded half to even and at least 1."""
    rounded = half_even(F.col("operations_total") * F.col("share_operations")).cast("long")
    cell = Window.partitionBy(*CELL)
    return (attach_weights(residual, weights)
            .withColumn("amount", money(F.col("amount_total").cast("double") * F.col("share_amount")))
            .withColumn("operations", F.when(rounded == 0, F.lit(1)).otherwise(rounded))
            .withColumn("check_amount", F.sum("amount").over(cell))
            .withColumn("check_operations", F.sum("operations").over(cell)))


def final_base(clean: DataFrame, allocated: DataFrame, residual: Sequence[str],
               brand: str) -> DataFrame:
    """Classified payments plus the allocated rows, in the columns of the payments."""
    classified = clean.filter(not_in(F.col("category"), residual))
    spread = (allocated.withColumn("payment_brand", F.lit(brand))
              .withColumn("amount", F.col("amount").cast(clean.schema["amount"].dataType))
              .select(*classified.columns))
    return classified.unionByName(spread)


def ecommerce_sums(sales: DataFrame, category: str) -> DataFrame:
    """E-commerce sales by month, province and merchant.

    Partial sums take up a hot merchant before it meets the registry: at most months times
    provinces rows of a merchant reach a join.
    """
    return sums(sales.filter(F.col("category") == category),
                ["period", "province", "category", "merchant_id"], "amount", "operations")


def listed_ecommerce(sales: DataFrame, registry: DataFrame, category: str) -> DataFrame:
    """E-commerce sums of merchants the registry knows."""
    return ecommerce_sums(sales, category).join(registry.select("merchant_id"), "merchant_id", "left_semi")


def split_by_weights(rows: DataFrame, pooled: DataFrame, amount_weight: str,
                     applies: str | None = None) -> DataFrame:
    """Split merchant rows over the month's categories; operations stay fractional.

    Rows whose ``applies`` flag is not set find no weight in the left join and stay whole, so one
    pass handles both kinds.
    """
    split = F.col(applies) if applies else F.lit(True)
    weights = pooled.withColumnsRenamed({"period": "_month", "category": "_category"})

    def part(measure: str, share: str) -> Column:
        whole = exact(F.col(measure))
        piece = money(F.col(measure).cast("double") * F.col(f"share_{share}"))
        return F.when(split, piece).otherwise(whole).alias(measure)

    return (rows.join(weights, (F.col("period") == F.col("_month")) & split, "left")
            .select("period", "province",
                    F.when(split, F.col("_category")).otherwise(F.col("category")).alias("category"),
                    "merchant_id", part("amount", amount_weight),
                    part("operations", "operations")))


def reassign_merchants(sales: DataFrame, registry: DataFrame, pooled: DataFrame, category: str,
                       amount_weight: str) -> DataFrame:
    """Replace the e-commerce rows of listed merchants by their split over categories.

    Only e-commerce sums meet the registry and are fanned out; all other rows pass from the scan to
    the union.
    """
    others = (sales.filter(not_in(F.col("category"), [category]))
              .select("period", "province", "category", "merchant_id",
                      exact(F.col("amount")).alias("amount"),
                      exact(F.col("operations")).alias("operations")))
    known = registry.select("merchant_id").distinct().withColumn("_listed", F.lit(True))
    flagged = ecommerce_sums(sales, category).join(known, "merchant_id", "left")
    return others.unionByName(split_by_weights(flagged, pooled, amount_weight, "_listed"))
