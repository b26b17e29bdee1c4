"""The input tables derived from a retail star schema (orders, lineitem and their dimensions).

Order lines stand for card payments: customer nations are provinces, part brands are categories,
line numbers are instalment plans, return flags are platforms, market segments are aggregators
and customers are merchants. ``FIXTURES.md`` lists the deliberate defects.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.exprs import month_number, month_of
from spendlens.operators.metrics import sums
from spendlens.params import Params
from spendlens.schemas import INPUTS
from spendlens.sources.staging import Stage

PLAN_OF_LINE = {1: 1, 2: 3, 3: 6, 4: 12, 5: 18, 6: 24}
LONGEST_PLAN = 30

PARAMS = Params(
    cutoff="2001-07-01",
    residual_categories=("Brand#24", "Brand#25"),
    ecommerce_category="Brand#25",
    synonyms={"Brand#23": "Brand#22"},
    merges=dict.fromkeys(("Brand#1", "Brand#2", "Brand#3"), "Appliances"),
    dominant_platform="N",
    dominant_aggregator="MACHINERY",
    fill_after="1998-12-01",
    early_until="1996-06-01",
    backcast_from="1995-01-01",
    backcast_to="1995-12-01",
    actual_from="1996-01-01",
    recent_from="1999-01-01",
    accumulate_from="2000-01-01",
    years=(2000, 2001),
    new_month="1996-01-01",
    base_month="2001-07-01",
)


class RetailInputs:
    """Input tables over ``<folder>/<table>.parquet``.

    The order lines are joined twice in all: once into a cube over the bounded dimensions
    (months, provinces, categories, brands, platforms, aggregators, plans), from which three
    extracts are summed, and once into merchant sales.
    """

    def __init__(self, spark: SparkSession, folder: str, stage: Stage):
        self.spark = spark
        self.folder = folder
        self.stage = stage.scope()
        self.counted = False

    def table(self, name: str) -> DataFrame:
        sort_within = "period" if name == "merchant_sales" else None
        if not self.counted:
            self.stage.expect(self._raw("lineitem").count())
            self.counted = True
        return self.stage.table(name, lambda: self._typed(name), sort_within)

    def _typed(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")().select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in INPUTS[name]])

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _places(self) -> DataFrame:
        return (self._raw("nation").join(self._raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select("n_nationkey", "n_name", "r_name"))

    def _orders(self) -> DataFrame:
        return self._raw("orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority",
            month_of(F.col("o_orderdate")).alias("period"))

    def _lines(self) -> DataFrame:
        """Order lines with category and measures; the joins that follow are on the order key.

        Prices and discounts have two decimals: whole cents and percents are exact and cheaper
        than casting each double to a decimal.
        """
        plan = F.lit(LONGEST_PLAN)
        for line, months in PLAN_OF_LINE.items():
            plan = F.when(F.col("l_linenumber") == line, months).otherwise(plan)
        cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
        percent = F.lit(100) - F.rint(F.col("l_discount") * 100).cast("long")
        paid = (cents * percent * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")
        return (self._raw("lineitem")
                .join(self._raw("part").select("p_partkey", "p_brand"),
                      F.col("l_partkey") == F.col("p_partkey"))
                .select("l_orderkey", "l_suppkey",
                        F.col("p_brand").alias("category"),
                        F.col("l_returnflag").alias("platform"),
                        plan.alias("installments"),
                        F.col("l_quantity").cast("long").alias("operations"),
                        F.when(F.col("l_quantity") == 13, F.lit(0).cast("decimal(18,4)"))
                        .otherwise(paid).alias("amount")))

    def _cube(self) -> DataFrame:
        customers = (self._raw("customer").join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
                     .select("c_custkey", F.col("n_name").alias("province"),
                             F.col("c_mktsegment").alias("aggregator")))
        buyers = (self._orders().join(customers, F.col("o_custkey") == F.col("c_custkey"))
                  .withColumn("payment_brand",
                              F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")))
                  .drop("o_custkey", "c_custkey", "o_orderpriority"))
        return sums(self._lines().join(buyers, F.col("l_orderkey") == F.col("o_orderkey")),
                    ["period", "province", "category", "payment_brand", "platform", "aggregator",
                     "installments"], "operations", "amount")

    @property
    def cube(self) -> DataFrame:
        return self.stage.table("sales_cube", self._cube)

    def _payments(self) -> DataFrame:
        return sums(self.cube, ["period", "province", "category", "payment_brand", "installments"],
                    "operations", "amount")

    def _platform_sales(self) -> DataFrame:
        """Plan 24 is missing in some months: its rows are there as a plan that no report keeps."""
        gap = ((F.col("installments") == 24) & F.month("period").isin(3, 9)
               & (F.year("period") >= 1999))
        plan = F.when(gap, LONGEST_PLAN).otherwise(F.col("installments"))
        return sums(self.cube.withColumn("installments", plan), ["period", "platform", "province", "category", "installments"],
                    "operations", "amount")

    def _aggregator_sales(self) -> DataFrame:
        return sums(self.cube, ["period", "aggregator", "province", "category", "installments"],
                    "operations", "amount")

    def _merchant_sales(self) -> DataFrame:
        suppliers = (self._raw("supplier").join(self._raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                     .select("s_suppkey", F.col("n_name").alias("province")))
        rows = (self._lines().join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(self._merchants(), F.col("l_orderkey") == F.col("o_orderkey")))
        return sums(rows, ["period", "province", "category", "merchant_id"], "operations", "amount")

    def _merchants(self) -> DataFrame:
        """Orders with their merchant; merchants in debt sell under an id that the registry lacks."""
        customers = self._raw("customer").select(
            "c_custkey", F.when(F.col("c_acctbal") < 0, -F.col("c_custkey"))
            .otherwise(F.col("c_custkey")).alias("merchant_id"))
        return (self._orders().join(customers, F.col("o_custkey") == F.col("c_custkey"))
                .select("o_orderkey", "period", "merchant_id"))

    def _merchant_registry(self) -> DataFrame:
        """One row per merchant and address."""
        addresses = (self._raw("orders").select("o_custkey", F.col("o_orderpriority").alias("address"))
                     .distinct())
        return (self._raw("customer")
                .join(self._raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(addresses, F.col("c_custkey") == F.col("o_custkey"))
                .select(F.col("c_custkey").alias("merchant_id"), F.col("c_name").alias("legal_name"),
                        F.col("n_name").alias("province"), F.col("c_mktsegment").alias("locality"),
                        "address"))

    def _price_index(self) -> DataFrame:
        months_since_start = month_number(F.col("period")) - (1995 * 12 + 1)
        return (self._orders().select("period").distinct()
                .withColumn("index_level", 100 + 2 * months_since_start))

    def _population(self) -> DataFrame:
        """Customers per nation; the sheet has no figures for one region."""
        count = F.when(F.col("r_name") != "MIDDLE EAST", F.count(F.lit(1)))
        return (self._raw("customer")
                .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
                .groupBy("n_name", "r_name").agg(count.alias("population"))
                .withColumnsRenamed({"n_name": "province", "r_name": "region"}))

    def _category_list(self) -> DataFrame:
        """Brands of the parts; one more listed name has no sales."""
        brands = self._raw("part").select(F.col("p_brand").alias("category"))
        unlisted = self.spark.createDataFrame([("Unlisted",)], INPUTS["category_list"])
        return brands.unionByName(unlisted).distinct()
