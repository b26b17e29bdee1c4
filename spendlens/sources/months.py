"""Saved tables that are brought up to date month by month.

``<folder>/<table>/period=<month>/version=<version>`` holds the rows of one month as one run wrote them;
``<folder>/saved_<name>`` holds, per run, which version of every month counts, and small tables of the
run as a whole. A run writes only the months whose digest has changed and makes its version current last,
so a reader sees all of the earlier state or all of the new one.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.sources import versions

MONTHS = "period date, digest string, version string"
Months = dict[date | None, tuple[str, str]]  # month: digest, version


def month_digests(rows: DataFrame, count: Column, digest: Column) -> dict[date | None, str]:
    """Per month the number of rows and the sum of their digests: one short text for each month."""
    found = rows.groupBy("period").agg(F.concat_ws(":", count.cast("string"), F.sum(digest).cast("string")).alias("digest"))
    return {r.period: r.digest for r in found.collect()}


def digests(rows: DataFrame) -> dict[date | None, str]:
    """A digest of each month's rows that does not depend on their order, in one pass.

    The columns' types are part of it, so a change of schema changes every month.
    """
    kinds = F.lit(rows.schema.simpleString())
    hashed = F.xxhash64(*[F.col(c) for c in rows.columns], kinds).cast("decimal(38,0)")
    return month_digests(rows, F.count(F.lit(1)), hashed)


class SavedMonths:
    """The saved state ``name`` in ``folder``: one table by month, and tables of the whole run."""

    def __init__(self, spark: SparkSession, folder: str, name: str, table: str):
        self.spark, self.folder, self.name, self.table = spark, folder, name, table
        self.state = f"{folder}/saved_{name}"
        self.version = versions.current(spark, self.state)
        self.months: Months = {}
        if self.version:
            self.months = {r.period: (r.digest, r.version) for r in self.whole("months", MONTHS).collect()}

    def whole(self, table: str, schema: T.StructType | str) -> DataFrame:
        """A table of the current run as a whole."""
        if self.version is None:
            raise ValueError(f"there is no saved {self.name} in {self.folder}")
        return self.spark.read.schema(schema).parquet(f"{self.state}/{self.version}/{table}")

    def changed(self, digest: Mapping[date | None, str]) -> list[date | None]:
        """The months to write: new ones and those whose digest differs."""
        return [m for m, d in digest.items() if self.months.get(m, (None,))[0] != d]

    def save(self, rows: DataFrame, digest: Mapping[date | None, str], **whole: DataFrame) -> None:
        """Write ``rows``, those of the changed months, and make them current with the other months.

        Months that ``digest`` lacks are no longer read. Files that neither this state nor the one
        before it names are deleted, such as those of a run that failed.
        """
        version, changed = versions.new_version(), set(self.changed(digest))
        (rows.withColumn("version", F.lit(version)).hint("rebalance", "period").write.mode("append")
         .partitionBy("period", "version").parquet(f"{self.folder}/{self.table}"))
        months: Months = {m: (d, version if m in changed else self.months[m][1]) for m, d in digest.items()}
        listed = self.spark.createDataFrame([(m, *pair) for m, pair in months.items()], MONTHS)
        for name, df in {"months": listed.coalesce(1), **whole}.items():
            df.write.parquet(f"{self.state}/{version}/{name}")
        versions.make_current(self.spark, self.state, version)
        before, self.months, earlier = self.months, months, self.version
        self.version = version
        self._prune(before)
        versions.delete_others(self.spark, self.state, {version, earlier})

    def _prune(self, before: Months) -> None:
        named = {(_folder(m), v) for months in (before, self.months) for m, (_, v) in months.items()}
        for month in versions.folders(self.spark, self.folder, self.table):
            for version in versions.folders(self.spark, self.folder, self.table, month):
                if (month, version.removeprefix("version=")) not in named:
                    versions.delete(self.spark, self.folder, self.table, month, version)

    def read(self, schema: T.StructType) -> DataFrame:
        """The rows of all months that count; only their folders are read."""
        stored = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        rows = self.spark.read.schema(stored).parquet(f"{self.folder}/{self.table}")
        counted = [f"{_folder(m)}/{v}" for m, (_, v) in self.months.items()]
        return rows.filter(F.concat(_folder_of(F.col("period")), F.lit("/"), "version").isin(counted)).select(
            *schema.names)


def _folder(month: date | None) -> str:
    return f"period={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def _folder_of(period: Column) -> Column:
    return F.concat(F.lit("period="), F.coalesce(period.cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
