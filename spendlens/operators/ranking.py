"""Rankings: latest month, top-n, the "Other" bucket, comparison months, masks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import december_before

OTHER = "Other"


def latest_month(df: DataFrame) -> Column:
    """The last period as a one-row scalar subquery; it never reaches the driver."""
    return df.agg(F.max("period")).scalar()


def in_latest_month(df: DataFrame, latest: Column | None = None) -> DataFrame:
    return df.filter(F.col("period") == (latest_month(df) if latest is None else latest))


def top_items(df: DataFrame, item: str, measure: str, n: int) -> DataFrame:
    """The n items with the largest sum; the name breaks ties, so reruns agree."""
    return (df.groupBy(item).agg(F.sum(measure).alias(measure))
            .orderBy(F.desc(measure), item).limit(n))


def top_per_group(df: DataFrame, group: Sequence[str], item: str, measure: str, n: int,
                  ties: bool = False) -> DataFrame:
    """Top n rows of each group; ``ties`` keeps every row equal to the n-th and drops null measures.

    The rank filter becomes a group limit below the shuffle, so a hot group sends at most n rows
    (plus ties) per task.
    """
    if ties:
        df = df.filter(F.col(measure).isNotNull())
    order = [F.desc(measure)] if ties else [F.desc(measure), F.col(item)]
    position = F.rank() if ties else F.row_number()
    return (df.withColumn("_position", position.over(Window.partitionBy(*group).orderBy(*order)))
            .filter(F.col("_position") <= n).drop("_position"))


def largest_in_group(df: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    return top_per_group(df, group, measure, measure, 1, ties=True)


def lump_other(df: DataFrame, top: DataFrame, item: str = "category", *,
               on: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """Add ``bucket``: the item if it is in ``top``, else "Other".

    ``bounded`` says that ``top`` ends in a LIMIT, which is the only case with a broadcast hint;
    otherwise Spark chooses the join from the sizes it measures. A null item in ``top`` is a
    bucket of its own, as in the yearly tables.
    """
    keys = [*on, item]
    flags = top.select(*[F.col(k).alias(f"_top_{k}") for k in keys]).withColumn("_top", F.lit(True))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_top_{k}")) for k in keys])
    return (df.join(F.broadcast(flags) if bounded else flags, same, "left")
            .withColumn("bucket", F.when(F.col("_top"), F.col(item)).otherwise(F.lit(OTHER)))
            .drop("_top", *[f"_top_{k}" for k in keys]))


def only_items(df: DataFrame, top: DataFrame, item: str = "category") -> DataFrame:
    """Rows of the items in a top-n list that ends in a LIMIT."""
    kept = F.broadcast(top.select(F.col(item).alias("_kept")))
    return df.join(kept, F.col(item).eqNullSafe(F.col("_kept")), "left_semi")


def comparison_months(latest: Column, with_december: bool) -> list[Column]:
    """Latest month, the one before, the same a year ago; optionally both previous Decembers."""
    months = [latest, F.add_months(latest, -1), F.add_months(latest, -12)]
    if with_december:
        december = december_before(latest)
        months += [december, F.add_months(december, -12)]
    return months


def keep_comparison_months(df: DataFrame, latest: Column, with_december: bool = False) -> DataFrame:
    return (df.withColumn("_latest", latest)
            .filter(F.col("period").isin(comparison_months(F.col("_latest"), with_december)))
            .drop("_latest"))


def mask_before(df: DataFrame, latest: Column, columns: Sequence[str]) -> DataFrame:
    """Blank the named columns outside the latest month."""
    return (df.withColumn("_latest", latest)
            .withColumns({c: F.when(F.col("period") == F.col("_latest"), F.col(c)) for c in columns})
            .drop("_latest"))


def side_by_side(left: DataFrame, right: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Pair the rows of two short result tables by rank; the longer one keeps all its rows."""
    numbered = F.row_number().over(Window.orderBy(*order))
    first, second = (
        df.select(numbered.alias("rank"), *[F.col(c).alias(f"{c}_y{i}") for c in df.columns])
        for i, df in enumerate((left, right), start=1))
    return first.join(second, "rank", "full")


def other_last(bucket: str, measure: str) -> list[Column]:
    return [(F.col(bucket) == OTHER).asc(), F.desc(measure), F.col(bucket).asc()]
