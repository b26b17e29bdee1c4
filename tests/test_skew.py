"""Hot keys in the order lines: a third belong to one part, a third of the orders to one customer."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendlens.operators import allocate, checks
from spendlens.sources.retail import RetailInputs
from spendlens.sources.staging import Stage

SETTINGS = {  # small thresholds, so that a small table counts as large
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    "spark.sql.shuffle.partitions": "16",
}
LINES = 60000


@pytest.fixture
def inputs(spark, tmp_path):
    def put(name, df):
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    put("region", spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name"))
    put("nation", spark.sql("SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey"))
    put("supplier", spark.range(10).selectExpr("id AS s_suppkey", "0 AS s_nationkey"))
    put("part", spark.range(2000).selectExpr("id AS p_partkey", "concat('Brand#', id % 25 + 1) AS p_brand"))
    put("customer", spark.range(3000).selectExpr(
        "id AS c_custkey", "concat('C', id) AS c_name", "0 AS c_nationkey",
        "1.0D AS c_acctbal", "'MACHINERY' AS c_mktsegment"))
    put("orders", spark.range(LINES // 2).repartition(8).selectExpr(
        "id AS o_orderkey", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 3000 END AS o_custkey",
        "CAST(date'1997-01-15' AS TIMESTAMP_NTZ) AS o_orderdate", "'1-URGENT' AS o_orderpriority"))
    put("lineitem", spark.range(LINES).repartition(8).selectExpr(
        "id DIV 2 AS l_orderkey", "CASE WHEN id % 3 = 0 THEN 11 ELSE id % 2000 END AS l_partkey",
        "id % 10 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber", "2.0D AS l_quantity",
        "10.50D AS l_extendedprice", "0.05D AS l_discount", "'N' AS l_returnflag"))
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield RetailInputs(spark, str(tmp_path), Stage(spark))
    for key in SETTINGS:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_part_and_customer_are_split_and_nothing_is_lost(inputs):
    total = inputs._cube().agg(F.sum("amount").alias("amount"), F.sum("operations").alias("operations"))
    text = final_plan(total)
    assert "SortMergeJoin(skew=true) [l_partkey" in text
    assert "SortMergeJoin(skew=true) [o_custkey" in text
    row = total.first()
    assert (float(row.amount), row.operations) == (LINES * 9.975, LINES * 2)


def test_hot_merchant_sums_are_whole(inputs):
    by_merchant = inputs._merchant_sales().groupBy("merchant_id").agg(F.sum("operations").alias("n"))
    hot = by_merchant.filter("merchant_id = 7").first().n
    assert hot == 2 * LINES // 3 + sum(
        4 for i in range(LINES // 2) if i % 3 and i % 3000 == 7)


def joined_rows(df) -> int:
    """Rows that the joins of an executed plan put out, the largest of them."""
    plan, most, work = df._jdf.queryExecution().executedPlan(), 0, []
    work.append(plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan)
    while work:
        node = work.pop()
        if node.nodeName().startswith("SortMergeJoin"):
            most = max(most, node.metrics().get("numOutputRows").get().value())
        if "QueryStage" in node.nodeName():
            work.append(node.plan())
        children = node.children()
        work += [children.apply(i) for i in range(children.size())]
    return most


def test_a_hot_merchant_is_summed_before_it_meets_the_registry(inputs):
    sales = inputs._lines().join(inputs._merchants(), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "period", F.lit("N").alias("province"), F.lit("E").alias("category"), "merchant_id", "amount", "operations")
    registry = inputs.spark.range(3000).select(F.col("id").alias("merchant_id"))
    df = allocate.listed_ecommerce(sales.checkpoint(), registry, "E")
    assert len(df.collect()) == 2000  # one month and province: one row per merchant with sales
    assert joined_rows(df) == 2000


@pytest.mark.parametrize("find", [
    lambda df, keys: df.join(keys, "merchant_id", "left_semi"),
    lambda df, keys: checks.rows_of_new_keys(df, "merchant_id", "1997-01-01", keys)])
def test_rows_of_written_keys_are_split(inputs, tmp_path, find):
    df = inputs.spark.range(LINES).repartition(8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS merchant_id", "date'1997-01-01' AS period",
        "repeat(string(id), 8) AS legal_name")
    inputs.spark.range(LINES).selectExpr("id AS merchant_id").write.parquet(f"{tmp_path}/keys")
    assert "SortMergeJoin(skew=true)" in final_plan(find(df, inputs.spark.read.parquet(f"{tmp_path}/keys")))
