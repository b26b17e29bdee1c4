"""Everything the reports share: cleaned inputs, weights, the final base, the deflator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.exprs import any_null, day
from spendlens.operators.allocate import (
    allocate, final_base, payment_cells, reassign_merchants, residual_cells)
from spendlens.operators.clean import (
    clean_payments, fill_missing_plan, keep_reported, remap_category)
from spendlens.operators.history import key_bitmaps, key_history
from spendlens.operators.metrics import sums
from spendlens.operators.prices import base_month, deflate, deflator
from spendlens.operators.weights import (
    backcast_weights, category_weights, early_weights, join_weights, pooled_weights)
from spendlens.params import Params
from spendlens.schemas import FINAL_BASE, MERCHANT_BITMAPS, MERCHANT_HISTORY, PLATFORM_WEIGHTS
from spendlens.sources.months import SavedMonths, digests, month_digests
from spendlens.sources.staging import Stage


MERCHANT = "merchant_id"
MERCHANT_CELL = ("period", "province", "category")


class Inputs(Protocol):
    """Gives each table of ``spendlens.schemas.INPUTS`` by name.

    An input may also have ``months(name, since, until)``, which leaves out at least what a scan can.
    """

    def table(self, name: str) -> DataFrame: ...


class Workspace:
    """One run over one snapshot of the inputs.

    Derived tables that many reports read are written once: weights, the cells they are learnt
    from, allocated rows, deflator and the three report cubes. All are bounded by months and
    dimensions. Whatever grows with payments or merchants stays a lazy DataFrame, but for the
    merchant totals of the category report, which several of its tables start from.
    """

    def __init__(self, spark: SparkSession, inputs: Inputs, params: Params,
                 stage: Stage | None = None):
        self.spark = spark
        self.inputs = inputs
        self.params = params
        self.stage = (stage or Stage(spark)).scope()
        self.base_loaded = False

    def table(self, name: str) -> DataFrame:
        return self.inputs.table(name)

    def months(self, name: str, since: str | None = None, until: str | None = None) -> DataFrame:
        """The rows of a table in a range of months, as early in the scan as its source can tell."""
        source = getattr(self.inputs, "months", None)
        rows = source(name, since, until) if source else self.table(name)
        if since is not None:
            rows = rows.filter(F.col("period") >= day(since))
        return rows if until is None else rows.filter(F.col("period") <= day(until))

    def save_base(self, folder: str) -> list[date]:
        """Bring the saved weights and final base up to date and go on from them; the months written.

        A month is written anew if its clean payments or its weights differ from those it was saved
        with. The others are not allocated or written again, and their files stay.
        """
        saved, p = SavedMonths(self.spark, folder, "base", "final_base"), self.params
        weights, salt = digests(self.weights), f"{sorted(p.residual_categories)} {p.allocated_brand}"
        payments = month_digests(self.payment_cells.filter("clean_rows > 0"), F.sum("clean_rows"), F.col("digest"))
        digest = {m: f"{d} {weights.get(m)} {salt}" for m, d in payments.items()}
        written = saved.changed(digest)
        changed = F.col("period").isin(written)
        spread = allocate(self.residual.filter(changed), self.weights)
        rows = final_base(self.clean.filter(changed), spread, p.residual_categories, p.allocated_brand)
        cutoff = self.spark.createDataFrame([(p.cutoff,)], "cutoff string")
        saved.save(rows.select(*FINAL_BASE.names), digest, platform_weights=self.weights, run=cutoff.coalesce(1))
        self.load_base(folder)
        return written

    def load_base(self, folder: str) -> Workspace:
        """Start from saved weights and final base; payments and platform sales stay unread
        unless a table of their own is asked for.

        The cutoff of this run may be earlier than that of the saved base, which is then read up to
        it, but not later.
        """
        saved, cutoff = SavedMonths(self.spark, folder, "base", "final_base"), self.params.cutoff
        end = saved.whole("run", "cutoff string").first().cutoff
        if cutoff > end:
            raise ValueError(f"the base in {folder} ends with {end}, before the cutoff {cutoff}")
        self.weights = saved.whole("platform_weights", PLATFORM_WEIGHTS)
        self.final_base = saved.read(FINAL_BASE).filter(F.col("period") <= day(cutoff))
        self.base_loaded = True
        return self

    def save_merchants(self, folder: str) -> list[date]:
        """Merge the months that have changed into the saved merchant history and bitmaps, and go on
        from them; the months merged."""
        saved = SavedMonths(self.spark, folder, "merchants", "merchant_bitmaps")
        sales = self.table("merchant_sales")
        digest = digests(sales)
        changed = sorted({*saved.changed(digest), *(saved.months.keys() - digest.keys())}, key=str)
        undated = F.col("period").isNull() if None in changed else F.lit(False)
        rows = sales.filter(F.col("period").isin([m for m in changed if m]) | undated)
        history = saved.whole("merchant_history", MERCHANT_HISTORY) if saved.version else None
        history = self.stage.table("merchant_history", lambda: key_history(
            rows, MERCHANT, MERCHANT_CELL[1:], self.stage.table, history, changed))
        saved.save(key_bitmaps(rows, history, MERCHANT, MERCHANT_CELL), digest, merchant_history=history)
        self.merchant_history = saved.whole("merchant_history", MERCHANT_HISTORY)
        self.merchant_bitmaps = saved.read(MERCHANT_BITMAPS)
        return changed

    # --- weights ---------------------------------------------------------------------------

    @cached_property
    def dominant_sales(self) -> DataFrame:
        """Rows of the platform that the weights are learnt from, any month and plan."""
        return self.table("platform_sales").filter(
            F.col("platform") == self.params.dominant_platform)

    @cached_property
    def learning_raw(self) -> DataFrame:
        sales = self.months("platform_sales", until=self.params.cutoff)
        return keep_reported(sales.filter(F.col("platform") == self.params.dominant_platform),
                             self.params.cutoff, self.params.plans)

    @cached_property
    def learning_counts(self) -> DataFrame:
        """The learning rows summed over their dimensions, with the number of rows that hold a null."""
        rows, measures = self.learning_raw, ("operations", "amount")
        return self.stage.table("learning_cells", lambda: rows.groupBy(
            "period", "platform", "province", "category", "installments").agg(
            *[F.sum(m).alias(m) for m in measures], F.count_if(any_null(rows.columns)).alias("null_rows")))

    @cached_property
    def learning_cells(self) -> DataFrame:
        """The learning rows summed over their dimensions: bounded, and read instead of the rows
        by everything that sums, counts or lists them."""
        return self.learning_counts.drop("null_rows")

    def _filled(self, rows: DataFrame) -> DataFrame:
        return fill_missing_plan(rows, self.params.fill_plan, self.params.fill_after,
                                 observed=self.learning_cells)

    @cached_property
    def learning_filled(self) -> DataFrame:
        return self._filled(self.learning_raw)

    @cached_property
    def learning(self) -> DataFrame:
        """Cells with filler and merged categories."""
        return remap_category(self._filled(self.learning_cells), self.params.synonyms)

    @cached_property
    def weights_observed(self) -> DataFrame:
        return self.stage.table("weights_observed", lambda: category_weights(self.learning))

    @cached_property
    def weights_early(self) -> DataFrame:
        return early_weights(self.weights_observed, self.params.early_until)

    @cached_property
    def weights_past(self) -> DataFrame:
        return backcast_weights(self.weights_early, self.params.backcast_from,
                                self.params.backcast_to)

    @cached_property
    def weights(self) -> DataFrame:
        return self.stage.table("platform_weights", lambda: join_weights(
            self.weights_observed, self.weights_past, self.params.actual_from))

    @cached_property
    def market_weights(self) -> DataFrame:
        return pooled_weights(self.weights)

    # --- final base ------------------------------------------------------------------------

    @cached_property
    def clean(self) -> DataFrame:
        return clean_payments(self.months("payments", until=self.params.cutoff), self.params.cutoff,
                              self.params.plans)

    @cached_property
    def payment_cells(self) -> DataFrame:
        """The one pass over all payments, those after the cutoff included, for the checks count them."""
        p = self.params
        return self.stage.table("payment_cells", lambda: payment_cells(
            self.table("payments"), p.cutoff, p.plans, p.residual_categories))

    @cached_property
    def residual(self) -> DataFrame:
        return residual_cells(self.payment_cells)

    @cached_property
    def allocated(self) -> DataFrame:
        return self.stage.table("allocated", lambda: allocate(self.residual, self.weights))

    @cached_property
    def final_base(self) -> DataFrame:
        """Not written unless asked: it is a filtered scan of the payments plus the allocated
        rows, so reading a copy would cost as much."""
        return final_base(self.clean, self.allocated, self.params.residual_categories,
                          self.params.allocated_brand)

    # --- cubes of the reports --------------------------------------------------------------

    @cached_property
    def deflator(self) -> DataFrame:
        return self.stage.table("deflator", lambda: deflator(
            self.table("price_index"), base_month(self.params.base_month)))

    def _cube(self, name: str, rows: Callable[[], DataFrame], *dimensions: str) -> DataFrame:
        """Amounts and operations summed by month, province, category and plan, with real amounts.

        The sums are deflated, not the rows: the month is a key, so the result is the same but for the
        rounding of each row.
        The size is bounded by the dimensions. Reports read it by column, so those without real
        amounts do not read them.
        """
        return self.stage.table(name, lambda: deflate(sums(
            rows(), ["period", *dimensions, "province", "category", "installments"],
            "amount", "operations"), self.deflator))

    def latest(self, cube: str) -> Column:
        """The last month of a cube, as a scalar from a written calendar of one row.

        Reports compare with it many times; a subquery over the cube would read the cube each time.
        """
        months = self.stage.table(f"{cube}_calendar", lambda: getattr(self, cube).agg(F.max("period").alias("latest")))
        return months.scalar()

    @cached_property
    def base(self) -> DataFrame:
        """Cube of the final base, categories merged."""
        return self._cube("base_cube", lambda: remap_category(self.final_base, self.params.merges))

    @cached_property
    def platform_rows(self) -> DataFrame:
        return keep_reported(self.months("platform_sales", until=self.params.cutoff), self.params.cutoff,
                             self.params.plans)

    @cached_property
    def other_aggregators(self) -> DataFrame:
        return self.table("aggregator_sales").filter(
            F.col("aggregator") != self.params.dominant_aggregator)

    @cached_property
    def aggregator_rows(self) -> DataFrame:
        sales = self.months("aggregator_sales", until=self.params.cutoff)
        return keep_reported(sales.filter(F.col("aggregator") != self.params.dominant_aggregator),
                             self.params.cutoff, self.params.plans)

    def _channel_names(self, rows: DataFrame) -> DataFrame:
        return remap_category(remap_category(rows, self.params.merges), self.params.synonyms)

    @cached_property
    def platform_base(self) -> DataFrame:
        return self._cube("platform_cube", lambda: self._channel_names(self.platform_rows),
                          "platform")

    @cached_property
    def aggregator_base(self) -> DataFrame:
        return self._cube("aggregator_cube", lambda: self._channel_names(self.aggregator_rows),
                          "aggregator")

    # --- merchants -------------------------------------------------------------------------

    @cached_property
    def merchant_history(self) -> DataFrame:
        """One row per merchant with the months it sold in; written, as the bitmaps need its numbers."""
        return self.stage.table("merchant_history", lambda: key_history(
            self.table("merchant_sales"), MERCHANT, MERCHANT_CELL[1:], self.stage.table))

    @cached_property
    def merchant_bitmaps(self) -> DataFrame:
        """The merchants of every month, province and category: all distinct counts start from it."""
        return self.stage.table("merchant_bitmaps", lambda: key_bitmaps(
            self.table("merchant_sales"), self.merchant_history, MERCHANT, MERCHANT_CELL))

    @cached_property
    def registry_merchants(self) -> DataFrame:
        """Merchants of the registry with their number of rows. Written, so that a join on them is a plain
        shuffle that AQE can split, and Spark can build a Bloom filter for the other side from it."""
        return self.stage.table("registry_merchants", lambda: self.table("merchant_registry").groupBy(MERCHANT).agg(
            F.count(F.lit(1)).alias("registry_rows")))

    @cached_property
    def merchant_base(self) -> DataFrame:
        """Merchant sales after reassignment and merging of categories; as large as the input,
        so it stays lazy and each report prunes it."""
        p = self.params
        return remap_category(
            reassign_merchants(self.table("merchant_sales"), self.registry_merchants,
                               self.market_weights, p.ecommerce_category, p.amount_weight),
            p.merges)
