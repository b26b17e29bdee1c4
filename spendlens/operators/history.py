"""History of a key: the months each value was seen in, and exact distinct counts from bitmaps.

Both are kept from run to run, so that a new month is merged into them and earlier months are not read
again. Values of the key get dense numbers that never change; a set of values is then a bitmap, and the
union of sets, over whatever months and places, is the bitwise OR of short binaries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.exprs import day, month_number

Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]  # writes a named table and reads it back
ROW_BITS = 33  # of a row's place in its partition, in monotonically_increasing_id
NO_MONTH = 0  # month number of rows without a month


def _month(period: Column) -> Column:
    return F.coalesce(month_number(period), F.lit(NO_MONTH))


def _first_day(number: Column) -> Column:
    """The month of a month number: numbers count months from year 0, January being 1."""
    year = F.floor((number - 1) / 12)
    return F.make_date(year.cast("int"), (number - year * 12).cast("int"), F.lit(1))


def key_months(rows: DataFrame, key: str, home: Sequence[str]) -> DataFrame:
    """(key, months, home): the months of each key, and the least of its ``home`` values.

    A set has one entry per month at most. It is formed before the shuffle, so a hot key sends one row
    per task.
    """
    return rows.groupBy(key).agg(F.collect_set(_month(F.col("period"))).alias("months"),
                                 F.min(F.struct(*home)).alias("home"))


def numbered(keys: DataFrame, order: Sequence[str], start: Column, keep: Keep) -> DataFrame:
    """Add ``number``: 1, 2, ... after ``start`` in the order of some columns, without a global window.

    Rows are dealt by range and written with their place in their partition; what comes before a
    partition is summed over one row per partition.
    """
    placed = keep("placed_keys", lambda: keys.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", ROW_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")))
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (placed.join(offsets, part == F.col("_part"))
            .withColumn("number", start + F.col("_offset") + row + 1)
            .drop("_place", "_part", "_offset"))


def key_history(rows: DataFrame, key: str, home: Sequence[str], keep: Keep,
                saved: DataFrame | None = None, changed: Sequence[date | None] = ()) -> DataFrame:
    """(key, months, first_period, last_period, number), one row per key, a null key included.

    ``saved`` is the history of an earlier run, and ``rows`` then those of the months that have
    ``changed`` since. A changed month is taken out of the saved months and put back from the rows;
    keys that are seen in no month any more go. Keys that are new get the next numbers, those of one
    ``home`` (such as province and category) side by side, which keeps bitmaps of a place short.
    """
    fresh = key_months(rows, key, home)
    if saved is None:
        known = fresh.withColumn("number", F.lit(None).cast("long"))
        start = F.lit(0).cast("long")
    else:
        gone = F.array(*[_month(F.lit(m).cast("date")) for m in changed]).cast("array<int>")
        before = saved.select(key, F.array_except("months", gone).alias("months"),
                              F.lit(None).cast(fresh.schema["home"].dataType).alias("home"), "number")
        known = (before.unionByName(fresh.withColumn("number", F.lit(None).cast("long")))
                 .groupBy(key).agg(F.flatten(F.collect_list("months")).alias("months"),  # two lists at most
                                   F.min("home").alias("home"), F.max("number").alias("number")))
        start = F.coalesce(saved.agg(F.max("number")).scalar(), F.lit(0))
    known = keep("known_keys", lambda: known.filter(F.size("months") > 0)
                 .withColumn("months", F.sort_array(F.array_distinct("months"))))
    new = numbered(known.filter("number IS NULL").drop("number"), ["home", key], start, keep)
    every = known.filter("number IS NOT NULL").unionByName(new)
    seen = F.filter("months", lambda m: m != NO_MONTH)
    return every.select(key, "months", _first_day(F.array_min(seen)).alias("first_period"),
                        _first_day(F.array_max(seen)).alias("last_period"), "number")


def presence_of(history: DataFrame, key: str, month: str) -> DataFrame:
    """Per key: seen before ``month``, seen in it; keys seen in neither are left out."""
    yes = F.lit("yes")
    return history.filter(F.col("first_period") <= day(month)).select(
        key, F.when(F.col("first_period") < day(month), yes).alias("before"),
        F.when(F.array_contains("months", _month(day(month))), yes).alias("in_month"))


def first_seen_in(history: DataFrame, key: str, month: str) -> DataFrame:
    """Keys without an earlier month, in the columns of ``presence_of``."""
    return history.filter(F.col("first_period") == day(month)).select(
        key, F.lit(None).cast("string").alias("before"), F.lit("yes").alias("in_month"))


def seen_since(history: DataFrame, key: str, month: str) -> DataFrame:
    return history.filter(F.col("last_period") >= day(month)).select(key)


def key_bitmaps(rows: DataFrame, history: DataFrame, key: str, dimensions: Sequence[str]) -> DataFrame:
    """(dimensions, bucket, keys): the set of keys of each combination, 32,768 numbers to a binary.

    Rows are dealt by combination and bucket with eight bytes each, and become bitmaps after that: a
    bitmap of few keys is larger than its rows, so sending partial ones would cost more.
    """
    numbers = history.select(F.col(key).alias("_key"), "number")
    cells = (rows.select(*dimensions, key).join(numbers, F.col(key).eqNullSafe(F.col("_key")))
             .select(*dimensions, F.bitmap_bucket_number("number").alias("bucket"),
                     F.bitmap_bit_position("number").alias("position")))
    return (cells.repartition(*dimensions, "bucket").groupBy(*dimensions, "bucket")
            .agg(F.bitmap_construct_agg("position").alias("keys")))


def distinct_keys(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts: bitmaps are merged before and after a shuffle of one per task and bucket."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    counted = F.coalesce(F.sum(F.bitmap_count("keys")), F.lit(0))
    return merged.groupBy(*by).agg(counted.alias(name))
