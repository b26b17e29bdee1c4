"""Price index: rebased index, deflator, real amounts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import change, day, money, month_number, ratio


def base_month(iso: str | None = None, today: date | None = None) -> Column:
    """The given month, or the month before ``today``'s."""
    if iso is not None:
        return day(iso)
    now = F.current_date() if today is None else F.lit(today)
    return F.trunc(F.add_months(now, -1), "MM")


def deflator(index: DataFrame, base: Column) -> DataFrame:
    """index_level, index_rebased (base month = 100), coef, inflation_mom.

    An index without the base month is an error. The window has no partition key: the index has
    one row per month.
    """
    level = index.filter(F.col("period") == base).agg(F.max("index_level")).scalar()
    level = F.coalesce(level, F.raise_error("the price index lacks the base month").cast("double"))
    months = Window.orderBy(month_number(F.col("period")))
    previous = F.max("index_rebased").over(months.rangeBetween(-1, -1))
    return (index.select("period", "index_level", ratio(F.col("index_level"), level).alias("coef"))
            .withColumn("index_rebased", F.col("coef") * 100)
            .withColumn("inflation_mom", change(F.col("index_rebased"), previous))
            .select("period", "index_level", "index_rebased", "coef", "inflation_mom"))


def deflate(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Add ``amount_real``; a month without index keeps its row with a null real amount."""
    return (df.join(prices.select("period", "coef"), "period", "left")
            .withColumn("amount_real", money(ratio(F.col("amount"), F.col("coef"))))
            .drop("coef"))
