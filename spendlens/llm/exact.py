"""Exact duplicates by content hash, with the bytes compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import ASCII_SPACE, column, id_and_text, staged, unpacked, whole_row

GROUP = ["content_hash", "digest"]


def without_space(text: Column) -> Column:
    return F.translate(text, ASCII_SPACE, "")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _signed(docs: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, text without white space, its hash and SHA-256, code points of the original)."""
    return (docs.select("*", without_space(F.col("text")).alias("content"))
            .withColumns({"content_hash": hashed(F.col("content")),
                          "digest": F.unhex(F.sha2(F.col("content").cast("binary"), 256)),
                          "n_chars": F.length("text").cast("long")}))


def _check_bytes(docs: DataFrame, groups: DataFrame, hashed: Callable[[Column], Column]) -> None:
    """Compare the bytes of all members of each repeated hash.

    Groups are keyed by hash and SHA-256, so texts that share only the hash are apart already. The
    aggregation by the text itself sends one row per text and task, however large its group.
    """
    repeated = groups.filter("group_size > 1").select("content_hash").distinct()
    texts = (_signed(docs, hashed).join(repeated, "content_hash", "left_semi")
             .groupBy(*GROUP, "content").agg(F.count(F.lit(1)).alias("n")))
    mixed = texts.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    if not mixed.isEmpty():
        raise ValueError("different texts share both content hash and SHA-256")


def copy_groups(docs: DataFrame, hashed: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and one row for each group of equal texts; both written."""
    signatures = staged(_signed(docs, hashed).select("doc_id", "n_chars", *GROUP), "signatures")
    groups = staged(
        signatures.groupBy(*GROUP, "n_chars", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(*GROUP).agg(
            F.sum("rows").alias("group_size"),
            # the longest original first, then the smallest id: ~id reverses the order of ids
            F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("reverse"), "rows")).alias("best"))
        .select(*GROUP, "group_size", F.bitwise_not("best.reverse").alias("keep_id"),
                F.col("best.n_chars").alias("keep_chars"), F.col("best.rows").alias("keep_rows")),
        "groups")
    _check_bytes(docs, groups, hashed)
    return signatures, groups


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hashed: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without ASCII white space; a null text is empty, and all
    empty texts are equal. The row with the longest original stays, then the smallest id; a null id
    comes last. Rows that repeat both id and text are one document and share ``kept``. An empty
    table gives no rows; other columns are not read.
    """
    signatures, groups = copy_groups(id_and_text(docs, id_col, text_col), hashed)
    return signatures.join(groups, GROUP).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))
         & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   hashed: Callable[[Column], Column] = md5_128) -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat id and text, one stays."""
    pair = id_and_text(docs, id_col, text_col)
    _, groups = copy_groups(pair, hashed)
    repeated = groups.filter("group_size > 1")
    rows = _signed(docs.select(whole_row(docs).alias("row"), column(id_col).alias("doc_id"),
                               F.coalesce(column(text_col), F.lit("")).alias("text")), hashed)
    kept = (rows.select("row", "doc_id", "n_chars", *GROUP).join(repeated, GROUP, "left")
            .filter(F.col("group_size").isNull()
                    | (F.col("doc_id").eqNullSafe(F.col("keep_id"))
                       & (F.col("n_chars") == F.col("keep_chars")))))
    if not repeated.filter("keep_rows > 1").isEmpty():
        once = kept.filter("keep_rows > 1").groupBy(*GROUP).agg(
            F.max_by("row", F.to_json("row")).alias("row")).select("row")
        kept = kept.filter("coalesce(keep_rows, 1) = 1").select("row").unionByName(once)
    return unpacked(kept, "row", docs.columns)


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
grouped AS (
  SELECT doc_id, sha256(content) AS text_sha256, count(*) OVER (PARTITION BY content) AS group_size,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY n_chars DESC, doc_id) AS keep_id
  FROM texts)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
"""
