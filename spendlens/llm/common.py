"""Helpers that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.sources.staging import shared_folder

ASCII_SPACE = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]


def column(name: str) -> Column:
    """A column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so that no other column of the input can clash; a null text is empty."""
    return docs.select(column(id_col).alias("doc_id"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"))


def whole_row(docs: DataFrame) -> Column:
    """All columns packed into one, so that they pass an operator under names of their own."""
    return F.struct(*[column(name) for name in docs.columns])


def unpacked(df: DataFrame, row: str, names: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(row).getField(name).alias(name) for name in names])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back.

    This cuts the lineage on storage that outlives executors, and gives both sides of a later
    join a true size and a plain shuffle, which AQE can split where a key is hot.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
