"""The labelled rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import column

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from; a null id is in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def labelled_sample(labels: DataFrame, target: str, max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``max_rows`` labelled documents outside the held-out fold.

    The rows with the smallest hashed ids are taken, so the sample is the same in every run. A
    null label is ignored; of several labels of one document the largest counts.
    """
    rows = (labels.select(column(id_col).alias("doc_id"), column(target).cast("int").alias("label"))
            .filter(~held_out(F.col("doc_id")) & F.col("label").isNotNull())
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
