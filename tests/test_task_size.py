"""Staged tables are written by tasks whose size does not grow with the input."""

from __future__ import annotations

import pytest

from spendlens.sources import staging
from spendlens.sources.retail import RetailInputs
from spendlens.sources.staging import PARTITIONS, TASK_BYTES, Stage, bounded_tasks

KEYS = (PARTITIONS, *TASK_BYTES)


@pytest.fixture
def whole_partitions(spark):
    """Every shuffle partition is a task, and so a file of a written table."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def files(df) -> int:
    return len(df.inputFiles())


def star(spark, folder, lines):
    def put(name, *columns, rows=50):
        spark.range(rows).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")

    put("region", "id AS r_regionkey", "'R' AS r_name", rows=1)
    put("nation", "id AS n_nationkey", "'N' AS n_name", "0L AS n_regionkey", rows=1)
    put("supplier", "id AS s_suppkey", "0L AS s_nationkey")
    put("part", "id AS p_partkey", "concat('Brand#', id % 25) AS p_brand")
    put("customer", "id AS c_custkey", "concat('C', id) AS c_name", "0L AS c_nationkey", "1.0D AS c_acctbal",
        "'MACHINERY' AS c_mktsegment")
    put("orders", "id AS o_orderkey", "id % 50 AS o_custkey", "CAST(date'1997-01-15' AS TIMESTAMP_NTZ) AS o_orderdate",
        "'1-URGENT' AS o_orderpriority", rows=lines)
    put("lineitem", "id AS l_orderkey", "id % 50 AS l_partkey", "id % 50 AS l_suppkey", "1 AS l_linenumber",
        "2.0D AS l_quantity", "10.50D AS l_extendedprice", "0.05D AS l_discount", "'N' AS l_returnflag", rows=lines)


@pytest.mark.parametrize("name", ["merchant_sales", "platform_sales"])
def test_the_number_of_tasks_follows_the_order_lines(spark, tmp_path, monkeypatch, whole_partitions, name):
    monkeypatch.setattr(staging, "TASK_ROWS", 100)
    before = {key: spark.conf.get(key, None) for key in KEYS}
    written = {}
    for lines in (1000, 4000):
        star(spark, tmp_path / str(lines), lines)
        inputs = RetailInputs(spark, str(tmp_path / str(lines)), Stage(spark))
        assert inputs.table(name).agg({"operations": "sum"}).first()[0] == 2 * lines
        written[lines] = inputs.stage.rows
        with bounded_tasks(spark, inputs.stage.rows):
            assert int(spark.conf.get(PARTITIONS)) == lines // 100
    assert written == {1000: 1000, 4000: 4000}
    assert {key: spark.conf.get(key, None) for key in KEYS} == before


def test_a_staged_sum_has_a_file_per_task(spark, whole_partitions, monkeypatch):
    monkeypatch.setattr(staging, "TASK_ROWS", 100)
    stage = Stage(spark)
    inputs, workspace = stage.scope(), stage.scope()
    inputs.expect(2000)
    keys = workspace.table("keys", lambda: spark.range(2000).selectExpr("id % 500 AS key").groupBy("key").count())
    assert files(keys) == 20
    assert keys.count() == 500
    stage.drop()


def test_settings_come_back_after_a_failure_and_smaller_ones_stay(spark):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key, None) for key in KEYS}
    with pytest.raises(ZeroDivisionError), bounded_tasks(spark, 10 ** 9):
        assert int(spark.conf.get(PARTITIONS)) == 1667
        raise ZeroDivisionError
    assert {key: spark.conf.get(key, None) for key in KEYS} == before
    spark.conf.set(advisory, "50k")
    with bounded_tasks(spark, 0):
        assert spark.conf.get(advisory) == "50k"
        assert spark.conf.get(PARTITIONS) == before[PARTITIONS]
    spark.conf.unset(advisory)
