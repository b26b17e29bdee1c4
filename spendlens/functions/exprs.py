"""Column expressions: months, ratios, rounding, membership."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlens.schemas import AMOUNT


def month_of(moment: Column) -> Column:
    """First day of the month a date or timestamp falls in."""
    return F.trunc(moment.cast("date"), "MM")


def month_from(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def in_months(since: str | None, until: str | None, year: str = "year", month: str = "month") -> Column:
    """Whether a row's year and month lie in a range of months, both ends included.

    Said of the two stored columns and not of a date built from them, the condition reaches the scan.
    """
    condition = F.lit(True)
    if since is not None:
        first = date.fromisoformat(since)
        condition = condition & ((F.col(year) > first.year)
                                 | ((F.col(year) == first.year) & (F.col(month) >= first.month)))
    if until is not None:
        last = date.fromisoformat(until)
        condition = condition & ((F.col(year) < last.year)
                                 | ((F.col(year) == last.year) & (F.col(month) <= last.month)))
    return condition


def month_number(period: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(period) * 12 + F.month(period)


def december_before(period: Column) -> Column:
    return F.add_months(period, -F.month(period))


def day(iso: str) -> Column:
    return F.lit(iso).cast("date")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives null, not an error, for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def change(value: Column, base: Column) -> Column:
    return ratio(value, base) - 1


def exact(value: Column) -> Column:
    """A whole or decimal column in the type of amounts."""
    return value.cast(AMOUNT)


def money(value: Column) -> Column:
    """Round a double to four decimals, half away from zero, and keep it as a decimal.

    Fixing every computed amount in its row makes later sums exact, whatever order partitions and
    retried tasks deliver them in. Whole ten-thousandths that fit a long skip the slow conversion
    of a double to a decimal.
    """
    scaled = value * 10000
    whole = F.when(scaled < 0, F.ceil(scaled - 0.5)).otherwise(F.floor(scaled + 0.5))
    ten_thousandths = F.when(F.abs(scaled) < 1e18, whole.cast("decimal(24,0)")).otherwise(
        F.round(scaled).cast("decimal(24,0)"))
    return (ten_thousandths * F.lit(Decimal("0.0001"))).cast(AMOUNT)


def distinct_count(column: str) -> Column:
    """Distinct values with null as a value of its own, so that counts agree with listings."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("long")), F.lit(0))


def half_even(value: Column) -> Column:
    return F.bround(value)


def not_in(value: Column, members: Iterable) -> Column:
    """``NOT IN`` that keeps nulls."""
    return value.isNull() | ~value.isin(list(members))


def any_null(columns: Iterable[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition
