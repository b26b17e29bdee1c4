"""Reconciliation, coverage, new keys and the table of invariant checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.exprs import day


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float = 0.01,
              names: tuple[str, str] = ("clean", "raw")) -> DataFrame:
    """Totals of two tables side by side, with equality flags."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, *[F.col(m).alias(f"{m}_{name}") for m in ("amount", "operations")])

    both = side(left, names[0]).unionByName(side(right, names[1]), allowMissingColumns=True)
    return compare_sums(both, keys, tolerance, names)


def compare_sums(rows: DataFrame, keys: Sequence[str], tolerance: float = 0.01,
                 names: tuple[str, str] = ("clean", "raw"), counts: Sequence[str] = ()) -> DataFrame:
    """Sums of the measures of two sides, which are columns of the same rows, with equality flags.

    Amounts are equal up to ``tolerance`` for the rounding of their parts, plus double precision.
    One aggregation instead of two and a full join: one shuffle, and a key that only one side has
    shows nulls on the other. ``counts`` names further columns to sum.
    """
    a, b = names
    amounts = (F.col(f"amount_{a}") - F.col(f"amount_{b}")).cast("double")
    allowed = F.lit(tolerance) + F.abs(F.col(f"amount_{b}").cast("double")) * 1e-12
    return (rows.groupBy(*keys)
            .agg(*[F.sum(f"{m}_{n}").alias(f"{m}_{n}") for n in names for m in ("amount", "operations")],
                 *[F.sum(c).alias(c) for c in counts])
            .withColumn("amount_equal", F.abs(amounts) <= allowed)
            .withColumn("operations_equal",
                        F.col(f"operations_{a}") == F.col(f"operations_{b}"))
            .withColumn("operations_diff", F.col(f"operations_{a}") - F.col(f"operations_{b}")))


def membership(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Which of several tables hold each key, as flags named after them; null is a key like any other.

    One shuffle for all tables, of one row per key and task.
    """
    marked = [df.select(*keys, F.lit(name).alias("_table")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, marked).groupBy(*keys).agg(
        *[F.max(F.col("_table") == name).alias(name) for name in tables])


def coverage(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Which keys appear in which of two tables, as flags."""
    return membership(dict(zip(names, (left, right))), [key])


def presence(df: DataFrame, key: str, month: str) -> DataFrame:
    """Per key: seen before ``month``, seen in it; keys seen in neither are left out."""
    yes = F.lit("yes")
    return (df.filter(F.col("period") <= day(month))
            .groupBy(key)
            .agg(F.max(F.when(F.col("period") < day(month), yes)).alias("before"),
                 F.max(F.when(F.col("period") == day(month), yes)).alias("in_month")))


def new_keys(df: DataFrame, key: str, month: str) -> DataFrame:
    return presence(df, key, month).filter(F.col("before").isNull())


def rows_of_new_keys(df: DataFrame, key: str, month: str, new: DataFrame | None = None) -> DataFrame:
    """All rows of the keys first seen in ``month``; such keys have no earlier rows to read.

    Give ``new`` as a written copy of ``new_keys`` where a key may be hot: the aggregate itself
    would share its shuffle with the join, which AQE then cannot split.
    """
    keys = new_keys(df, key, month) if new is None else new
    return df.filter(F.col("period") >= day(month)).join(keys, key)


def repeated(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once."""
    return df.groupBy(key).count().filter("count > 1").select(key)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once; a window would hold all rows of a key in one task."""
    return df.join(repeated(df, key), key, "left_semi")


def violations(df: DataFrame, **conditions: Column) -> DataFrame:
    """(check, violations): how many rows meet each condition, all counted in one pass."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    return counted.unpivot([], list(conditions), "check", "violations")


def totals(df: DataFrame, **numbers: Column) -> DataFrame:
    """(check, violations) from aggregates that are numbers of violations."""
    summed = df.agg(*[F.coalesce(number.cast("long"), F.lit(0)).alias(name) for name, number in numbers.items()])
    return summed.unpivot([], list(numbers), "check", "violations")


def check_table(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
