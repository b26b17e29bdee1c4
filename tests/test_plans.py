"""Physical plans: what must and must not appear, whatever the data size."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module
from spendlens.operators.ranking import top_per_group
from spendlens.plans.category import merchants_by_category
from spendlens.plans.registry import TABLES
from spendlens.plans.workspace import Workspace
from spendlens.sources.retail import PARAMS, RetailInputs
from spendlens.sources.staging import Stage

UNBOUNDED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "collect_set")


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    settings = {"spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "500"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def ws(spark, small_dir):
    return entry_module.workspace(spark, small_dir)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLES)
def test_no_cross_join_and_no_python(ws, name):
    found = [word for word in UNBOUNDED if word in plan(TABLES[name](ws))]
    assert not found


def test_sources_join_by_key_and_preaggregate(spark, small_dir):
    inputs = RetailInputs(spark, small_dir, Stage(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (inputs._cube(), inputs._merchant_sales()):
            text = plan(df)
            assert not [word for word in UNBOUNDED if word in text]
            assert "BroadcastHashJoin" not in text  # no forced broadcast of a growing table
            assert "SortMergeJoin" in text
            assert "partial_sum" in text
            schema = re.search(r"FileScan parquet \[([^\]]*l_orderkey[^\]]*)\]", text).group(1)
            assert "l_tax" not in schema and "l_shipdate" not in schema
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_reach_the_scan(ws):
    text = plan(ws.clean)
    assert "LessThanOrEqual(period,2001-07-01)" in text
    assert "In(installments" in text
    assert "GreaterThan(amount" in text


def test_scan_reads_only_the_needed_columns(ws):
    text = plan(TABLES["m_ops"](ws))
    assert re.search(r"ReadSchema: struct<period:date,operations:bigint>", text)


def test_group_limits_run_before_the_shuffle(ws):
    merchants = top_per_group(merchants_by_category(ws), ["category"], "merchant_id", "amount", 10,
                              ties=True)
    for df in (TABLES["prov_top7"](ws), merchants):
        assert re.search(r"WindowGroupLimit .*Partial", plan(df))


def test_global_top_is_a_bounded_take(ws):
    assert "TakeOrderedAndProject" in plan(TABLES["top7_amount"](ws))


def test_only_leading_merchants_meet_the_registry(ws):
    """The written list of leaders is on one side of the joins; no join reads all merchants."""
    text = plan(TABLES["merchant_share"](ws))
    for join in re.findall(r"(?:BroadcastHash|SortMerge|ShuffledHash)Join[^\n]*", text):
        assert "merchant_id" in join
    assert "leading_merchants" in text


def test_distinct_counts_are_preaggregated(ws):
    text = plan(TABLES["registry_locality"](ws))
    assert "partial_count" in text and "Exchange hashpartitioning" in text


@pytest.mark.parametrize("name", ["merchants_prov", "merchants_since_count", "merchants_total"])
def test_distinct_merchants_are_merged_bitmaps(ws, name):
    text = plan(TABLES[name](ws))
    assert "partial_bitmap_or_agg" in text and "merchant_id" not in text
    assert re.search(r"FileScan parquet \[[^\]]*\][^\n]*/merchant_bitmaps\]", text)


@pytest.mark.parametrize("name, pushed", [
    ("merchants_since", "GreaterThanOrEqual(last_period"), ("merchants_presence", "LessThanOrEqual(first_period"),
    ("merchants_new", "EqualTo(first_period")])
def test_merchant_lists_read_the_history_alone(ws, name, pushed):
    text = plan(TABLES[name](ws))
    assert "merchant_history]" in text and "Exchange" not in text and "/merchant_sales]" not in text
    assert pushed in text


def test_comparison_months_come_from_the_calendar(ws):
    for name, most in (("cat_growth5", 3), ("cat_growth5_year", 4)):
        text = plan(TABLES[name](ws))
        reads = re.findall(r"FileScan parquet \[[^\]]*\][^\n]*/base_cube\]", text)
        assert 0 < len(reads) <= most, name
        assert "base_calendar]" in text


def test_reconciling_and_checks_read_the_cells_of_the_payments(ws):
    for name in ("reconcile", "checks", "residual"):
        text = plan(TABLES[name](ws))
        assert "/payments]" not in text and "/payment_cells]" in text, name


def test_payments_are_summed_in_one_scan(spark, small_dir):
    ws = Workspace(spark, RetailInputs(spark, small_dir, Stage(spark)), PARAMS)
    ws.table("payments")
    built = {}
    ws.stage.table = lambda key, build, **_: built.setdefault(key, build())
    ws.payment_cells
    text = plan(built["payment_cells"])
    assert len(re.findall(r"FileScan parquet \[[^\]]*\][^\n]*/payments\]", text)) == 1
    assert "partial_sum" in text


@pytest.mark.parametrize("name", ["base", "platform_base", "aggregator_base"])
def test_cubes_are_summed_before_they_are_deflated(spark, small_dir, name):
    ws = Workspace(spark, RetailInputs(spark, small_dir, Stage(spark)), PARAMS)
    built = {}
    ws.stage.table = lambda key, build, **_: built.setdefault(key, build())
    getattr(ws, name)
    text = plan(built[{"base": "base_cube", "platform_base": "platform_cube", "aggregator_base": "aggregator_cube"}[name]])
    join = text.index("Join [period")
    assert "partial_sum(amount" not in text[:join] and "partial_sum(amount" in text[join:]
