"""Saving intermediates, exporting and publishing result tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame

FORMATS = ("parquet", "csv", "json", "orc")


def save(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write one table, replacing what was there.

    With ``partition_by`` the rebalance hint lets Spark split a hot partition value over several
    tasks and merge small ones, instead of one task per value.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        (df.hint("rebalance", partition_by).write.mode("overwrite")
         .partitionBy(partition_by).parquet(path))


def split(df: DataFrame, key: str, path: str) -> None:
    """One folder per value of ``key``."""
    save(df, path, partition_by=key)


def publish(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet",
            order: Callable[[str], Sequence[Column]] = lambda name: (),
            headerless: Collection[str] = (),
            columns: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Write each named table to its own folder under ``path``; earlier contents are replaced.

    Rows are sorted here and nowhere else. CSV files carry a header unless listed as headerless;
    ``columns`` names those that are written of a table, if not all.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    targets = {}
    for name, df in tables.items():
        by = order(name)
        sorted_df = df.orderBy(*by) if by else df
        if columns and name in columns:
            sorted_df = sorted_df.select(*columns[name])
        writer = sorted_df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", name not in headerless)
        targets[name] = f"{path}/{name}"
        writer.save(targets[name])
    return targets
