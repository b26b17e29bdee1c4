"""Cleaning: months, plans, nulls, category names, filler rows for a missing plan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.exprs import any_null, day


def keep_reported(df: DataFrame, cutoff: str, plans: Iterable[int]) -> DataFrame:
    """Complete months and the plans of interest; both filters reach the Parquet scan."""
    return df.filter((F.col("period") <= day(cutoff)) & F.col("installments").isin(list(plans)))


def clean_payments(df: DataFrame, cutoff: str, plans: Iterable[int]) -> DataFrame:
    return keep_reported(df, cutoff, plans).dropna("any").filter("amount > 0")


def incomplete_rows(df: DataFrame) -> DataFrame:
    return df.filter(any_null(df.columns))


def remap_category(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename or merge categories; rows are kept as they are, nulls stay null."""
    return df.replace(mapping, subset=["category"]) if mapping else df


def missing_plan_months(df: DataFrame, plan: int, after: str) -> DataFrame:
    """Months after ``after`` in which ``plan`` has no row: one aggregation, no anti join."""
    return (df.filter(F.col("period") > day(after))
            .groupBy("period")
            .agg(F.max(F.col("installments") == plan).alias("has_plan"))
            .filter(~F.coalesce("has_plan", F.lit(False)))
            .select("period"))


def fill_missing_plan(df: DataFrame, plan: int, after: str,
                      keys: Sequence[str] = ("platform", "province", "category"),
                      observed: DataFrame | None = None) -> DataFrame:
    """Add one row of amount 1 and one operation per key for each month lacking ``plan``.

    The missing months reach every key as one array value (at most one entry per month), so the
    product is an ``explode`` and not a join. Months and keys are looked up in ``observed``, a
    smaller table with the same combinations, if given.
    """
    known = df if observed is None else observed
    months = missing_plan_months(known, plan, after).agg(F.collect_list("period")).scalar()
    filler = (known.filter(F.col("period") > day(after))
              .select(*keys).distinct()
              .withColumn("period", F.explode(months))
              .withColumn("installments", F.lit(plan))
              .withColumn("operations", F.lit(1).cast(df.schema["operations"].dataType))
              .withColumn("amount", F.lit(1).cast(df.schema["amount"].dataType)))
    return df.unionByName(filler, allowMissingColumns=True)


def distinct_values(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Distinct values of several text dimensions in one pass: (dimension, value).

    Combinations are made distinct first, so that few rows are unpivoted.
    """
    return (df.select(*dimensions).distinct()
            .unpivot([], list(dimensions), "dimension", "value")
            .distinct())
