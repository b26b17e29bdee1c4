"""Ad-hoc merchant requests: presence, new merchants, counts.

All but the rows of new merchants come from the merchants' history and bitmaps, which a run merges with
the months that changed; see ``Workspace.merchant_history``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.exprs import day
from spendlens.operators import checks, history
from spendlens.plans.workspace import MERCHANT, Workspace


def merchants_since(ws: Workspace) -> DataFrame:
    return history.seen_since(ws.merchant_history, MERCHANT, ws.params.recent_from)


def merchants_since_count(ws: Workspace) -> DataFrame:
    recent = ws.merchant_bitmaps.filter(F.col("period") >= day(ws.params.recent_from))
    return history.distinct_keys(recent, [], "merchants")


def merchants_presence(ws: Workspace) -> DataFrame:
    return history.presence_of(ws.merchant_history, MERCHANT, ws.params.new_month)


def merchants_new(ws: Workspace) -> DataFrame:
    return history.first_seen_in(ws.merchant_history, MERCHANT, ws.params.new_month)


def merchants_new_count(ws: Workspace) -> DataFrame:
    return merchants_new(ws).agg(F.count(F.lit(1)).alias("merchants"))


def merchants_new_rows(ws: Workspace) -> DataFrame:
    """The list of new merchants is written: both sides of the join are then plain shuffles, which AQE
    splits for a hot merchant, and the list is small enough for Spark to build a Bloom filter from it,
    which drops the rows of other merchants before the shuffle."""
    month = ws.params.new_month
    new = ws.stage.table("new_merchants", lambda: merchants_new(ws)).filter(F.col("in_month") == "yes")
    return checks.rows_of_new_keys(ws.months("merchant_sales", since=month), MERCHANT, month, new)


def merchants_total(ws: Workspace) -> DataFrame:
    return history.distinct_keys(ws.merchant_bitmaps, [], "merchants")


TABLES = {
    "merchants_since": merchants_since,
    "merchants_since_count": merchants_since_count,
    "merchants_presence": merchants_presence,
    "merchants_new": merchants_new,
    "merchants_new_count": merchants_new_count,
    "merchants_new_rows": merchants_new_rows,
    "merchants_total": merchants_total,
}
