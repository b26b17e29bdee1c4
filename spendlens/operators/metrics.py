"""Measures: sums, shares, growth, annual shares, average ticket, per-capita amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import change, day, month_number, ratio


def sums(df: DataFrame, keys: Sequence, *measures: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def shares(df: DataFrame, within: Sequence[str], **named: str) -> DataFrame:
    """Add ``name = measure / sum(measure)`` inside each ``within`` group: ``share="amount"``."""
    group = Window.partitionBy(*within)
    return df.withColumns({
        name: ratio(F.col(measure), F.sum(measure).over(group)) for name, measure in named.items()})


def total_shares(df: DataFrame, **named: str) -> DataFrame:
    """Share of the grand total; the totals are one-row scalar subqueries, not a global window."""
    return df.withColumns({
        name: ratio(F.col(measure), df.agg(F.sum(measure)).scalar())
        for name, measure in named.items()})


def value_at(measure: str, keys: Sequence[str], offset: str) -> Column:
    """The measure one month, twelve months, or back to the previous December, by the calendar.

    RANGE frames over the month number look at the date and not at the row before, so a gap in a
    series gives null. The frame is at most one row wide for monthly rows (twelve for December).
    """
    group = Window.partitionBy(*keys)
    if offset == "ytd":
        december = F.when(F.month("period") == 12, F.col(measure))
        return F.max(december).over(group.orderBy(F.year("period")).rangeBetween(-1, -1))
    months = {"mom": 1, "yoy": 12}[offset]
    return F.max(measure).over(
        group.orderBy(month_number(F.col("period"))).rangeBetween(-months, -months))


def growth(df: DataFrame, keys: Sequence[str], **named: tuple[str, str]) -> DataFrame:
    """Add growth columns: ``mom=("amount", "mom")``. One row per (period, *keys) expected.

    Without keys the window has no partition: its input is then one row per month of the series.
    """
    return df.withColumns({
        name: change(F.col(measure), value_at(measure, keys, offset))
        for name, (measure, offset) in named.items()})


def annual_shares(df: DataFrame, years: Sequence[int], key: str, **named: str) -> DataFrame:
    """Yearly sums of each measure by ``key`` and their shares in the year, all years in one pass."""
    year = F.year("period")
    yearly = sums(df.filter(year.isin(list(years))), [year.alias("year"), key],
                  *dict.fromkeys(named.values()))
    return shares(yearly, ["year"], **named)


def average_ticket(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (sums(df, keys, "amount", "operations")
            .withColumn("avg_ticket", ratio(F.col("amount"), F.col("operations"))))


def average_ticket_with_total(df: DataFrame) -> DataFrame:
    """Average ticket by (period, category, plan) and, as plan "Total", by (period, category)."""
    plan = F.when(F.grouping("installments") == 1, F.lit("Total")).otherwise(
        F.col("installments").cast("string"))
    grouped = df.groupingSets(
        [["period", "category", "installments"], ["period", "category"]],
        "period", "category", "installments").agg(
            plan.alias("plan"), F.sum("amount").alias("amount"),
            F.sum("operations").alias("operations"))
    return grouped.select(
        "period", "category", F.col("plan").alias("installments"), "amount", "operations",
        ratio(F.col("amount"), F.col("operations")).alias("avg_ticket"))


def ticket_ratio(tickets: DataFrame, upper: int, lower: int) -> DataFrame:
    """Ratio of two plans' average tickets, on the rows of the upper plan only."""
    cell = Window.partitionBy("period", "category")

    def ticket_of(plan: int) -> Column:
        return F.max(F.when(F.col("installments") == str(plan), F.col("avg_ticket"))).over(cell)

    return tickets.withColumn(
        f"ratio_{upper}_{lower}",
        F.when(F.col("installments") == str(upper), ratio(ticket_of(upper), ticket_of(lower))))


def per_capita(df: DataFrame, population: DataFrame, since: str) -> DataFrame:
    """Amount per inhabitant by month and province from ``since`` on, with its monthly growth."""
    by_province = (sums(df.filter(F.col("period") >= day(since)), ["period", "province"], "amount")
                   .join(population, "province", "left")
                   .withColumn("amount_per_capita", ratio(F.col("amount"), F.col("population"))))
    return growth(by_province, ["province"], mom=("amount_per_capita", "mom")).select(
        "period", "province", "amount", "region", "population", "amount_per_capita", "mom")


def per_capita_by_region(by_province: DataFrame) -> DataFrame:
    return (sums(by_province, ["period", "region"], "population", "amount")
            .withColumn("amount_per_capita", ratio(F.col("amount"), F.col("population"))))
