"""Runs that follow one another: months brought up to date, versions, and failures on the way."""

from __future__ import annotations

import shutil
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import rows
from spendlens import job
from spendlens.plans.registry import TABLES
from spendlens.plans.workspace import Workspace
from spendlens.sources import versions
from spendlens.sources.files import FileInputs
from spendlens.sources.months import digests
from spendlens.sources.retail import PARAMS, RetailInputs
from spendlens.sources.staging import Stage

MERCHANT_TABLES = ("merchants_since", "merchants_since_count", "merchants_presence", "merchants_new",
                   "merchants_new_count", "merchants_new_rows", "merchants_total", "merchants_prov")


class Edited:
    """Inputs of which one table is another."""

    def __init__(self, inputs, **tables):
        self.inputs, self.tables = inputs, tables

    def table(self, name):
        return self.tables[name] if name in self.tables else self.inputs.table(name)


@pytest.fixture(scope="module")
def inputs(spark, data_dir):
    """Large enough for each month to hold every place and category: a new one would change the filler
    rows, and so the weights, of the earlier months that lack a plan."""
    return RetailInputs(spark, data_dir, Stage(spark))


@pytest.fixture
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def run(spark, inputs, cutoff="2001-07-01"):
    return Workspace(spark, inputs, replace(PARAMS, cutoff=cutoff), Stage(spark))


def saved_until(spark, inputs, tmp_path_factory, cutoff):
    folder = tmp_path_factory.mktemp("saved")
    months = run(spark, inputs, cutoff).save_base(str(folder))
    assert date.fromisoformat(cutoff) in months
    return folder


@pytest.fixture(scope="module")
def saved_june(spark, inputs, tmp_path_factory):
    return saved_until(spark, inputs, tmp_path_factory, "2001-06-01")


@pytest.fixture(scope="module")
def saved_july(spark, inputs, tmp_path_factory):
    return saved_until(spark, inputs, tmp_path_factory, "2001-07-01")


@pytest.fixture(scope="module")
def expected(spark, inputs):
    """A run over everything at once."""
    return run(spark, inputs)


def copied(folder, tmp_path):
    return str(shutil.copytree(folder, tmp_path / "copy"))


def files(folder, month):
    return sorted(p.name for p in Path(folder, "final_base", f"period={month}").rglob("part-*.parquet"))


def months_on_disk(folder):
    return {p.name.removeprefix("period=") for p in Path(folder, "final_base").glob("period=*")}


def test_one_more_month_writes_one_partition(spark, inputs, expected, saved_june, tmp_path):
    folder = copied(saved_june, tmp_path)
    before = {m: files(folder, m) for m in months_on_disk(folder)}
    ws = run(spark, inputs)
    assert ws.save_base(folder) == [date(2001, 7, 1)]
    assert {m: files(folder, m) for m in before} == before
    assert months_on_disk(folder) - before.keys() == {"2001-07-01"}
    assert digests(ws.final_base) == digests(expected.final_base)
    for name in ("cat_growth5", "checks"):
        assert rows(TABLES[name](ws)) == rows(TABLES[name](expected)), name
    both = [TABLES["reconcile"](w).agg(F.count("*"), F.min("amount_equal"), F.sum("amount_clean"), F.sum("operations_diff"))
            for w in (ws, expected)]
    assert rows(both[0]) == rows(both[1])

    assert run(spark, inputs).save_base(folder) == []  # nothing has changed
    assert digests(run(spark, inputs).load_base(folder).final_base) == digests(expected.final_base)


def test_revised_and_vanished_months(spark, inputs, saved_july, tmp_path):
    revised = F.when(F.col("period") == date(2000, 3, 1), F.col("amount") + 1).otherwise(F.col("amount"))
    payments = (inputs.table("payments").filter(F.col("period") != date(1999, 5, 1))
                .withColumn("amount", revised.cast("decimal(28,4)")))
    edited = Edited(inputs, payments=payments)
    ws = run(spark, edited)
    assert ws.save_base(copied(saved_july, tmp_path)) == [date(2000, 3, 1)]
    assert digests(ws.final_base) == digests(run(spark, edited).final_base)
    assert ws.final_base.filter(F.col("period") == date(1999, 5, 1)).isEmpty()


def test_changed_weights_change_the_months_they_apply_to(spark, inputs, saved_july, tmp_path):
    sales = inputs.table("platform_sales")
    doubled = F.when((F.col("period") == date(2000, 3, 1)) & (F.col("category") == "Brand#11"), F.col("amount") * 2)
    edited = Edited(inputs, platform_sales=sales.withColumn(
        "amount", F.coalesce(doubled, F.col("amount")).cast("decimal(28,4)")))
    ws = run(spark, edited)
    assert ws.save_base(copied(saved_july, tmp_path)) == [date(2000, 3, 1)]
    assert digests(ws.final_base) == digests(run(spark, edited).final_base)


def test_a_failed_run_leaves_the_saved_base(spark, inputs, expected, saved_june, tmp_path, monkeypatch):
    folder = copied(saved_june, tmp_path)
    before = digests(run(spark, inputs, "2001-06-01").load_base(folder).final_base)

    def fail(*_):
        raise RuntimeError("stopped")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "make_current", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            run(spark, inputs).save_base(folder)
    assert digests(run(spark, inputs, "2001-06-01").load_base(folder).final_base) == before
    ws = run(spark, inputs)
    assert ws.save_base(folder) == [date(2001, 7, 1)]  # the next run writes it, and once
    assert digests(ws.final_base) == digests(expected.final_base)
    assert len(list(Path(folder, "final_base", "period=2001-07-01").glob("version=*"))) == 1


def test_merchant_history_of_two_runs_equals_that_of_one(spark, inputs, expected, tmp_path):
    sales = inputs.table("merchant_sales")
    earlier = Edited(inputs, merchant_sales=sales.filter(F.col("period") < date(2001, 6, 1)).withColumn(
        "operations", F.when(F.col("period") == date(1996, 1, 1), F.lit(0)).otherwise(F.col("operations"))))
    run(spark, earlier).save_merchants(str(tmp_path))
    ws = run(spark, inputs)
    merged = ws.save_merchants(str(tmp_path))
    assert date(1996, 1, 1) in merged and min(m for m in merged if m != date(1996, 1, 1)) == date(2001, 6, 1)
    for name in MERCHANT_TABLES:
        assert rows(TABLES[name](ws)) == rows(TABLES[name](expected)), name
    assert run(spark, inputs).save_merchants(str(tmp_path)) == []


def test_a_failed_publication_leaves_the_earlier_bundle(spark, inputs, expected, tmp_path, monkeypatch):
    output, fmt = str(tmp_path), "parquet"
    monkeypatch.setattr(job, "BUNDLES", {"two": ("cat_share_since", "prov_share_amount")})
    job.publish_reports(run(spark, inputs, "2001-06-01"), output, ["two"], fmt)
    earlier = job.published(spark, output, "two")
    before = rows(spark.read.parquet(earlier["cat_share_since"]))

    broken = {**TABLES, "prov_share_amount": lambda ws: ws.spark.sql("SELECT raise_error('stopped') AS x")}
    with monkeypatch.context() as patch:
        patch.setattr(job, "TABLES", broken)
        with pytest.raises(Exception, match="stopped"):
            job.publish_reports(expected, output, ["two"], fmt)
    assert job.published(spark, output, "two") == earlier
    assert rows(spark.read.parquet(earlier["cat_share_since"])) == before

    Path(output, "two", "notes").mkdir()  # a folder of someone else stays
    for _ in range(2):
        job.publish_reports(expected, output, ["two"], fmt)
    latest = job.published(spark, output, "two")
    assert spark.read.parquet(latest["prov_share_amount"]).agg(F.max("period")).first()[0] == date(2001, 7, 1)
    kept = versions.folders(spark, output, "two")
    assert len(kept) == 3 and "notes" in kept  # the current version and the one before


def test_nothing_saved_or_published(spark, inputs, tmp_path):
    with pytest.raises(ValueError, match="no saved base"):
        run(spark, inputs).load_base(str(tmp_path))
    with pytest.raises(ValueError, match="published"):
        job.published(spark, str(tmp_path), "monthly")


def test_year_and_month_columns_are_filtered_by_the_scan(spark, inputs, tmp_path, whole_plan_text):
    paths = {}
    for name in ("payments", "platform_sales", "aggregator_sales", "merchant_sales"):
        paths[name] = f"{tmp_path}/{name}"
        (inputs.table(name).select(F.year("period").alias("anio"), F.month("period").alias("mes"), "*").drop("period")
         .write.parquet(paths[name]))
    paths["price_index"] = f"{tmp_path}/price_index"
    inputs.table("price_index").write.parquet(paths["price_index"])
    ws = run(spark, FileInputs(spark, paths), "1999-04-01")
    expected = run(spark, inputs, "1999-04-01")
    for name in ("clean", "learning_raw", "platform_rows", "aggregator_rows"):
        df = getattr(ws, name)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "LessThan(anio,1999)" in plan and "LessThanOrEqual(mes,4)" in plan, name
        assert digests(df) == digests(getattr(expected, name)), name
    new = TABLES["merchants_new_rows"](ws)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(anio,1996)" in plan and "GreaterThanOrEqual(mes,1)" in plan
    assert rows(new) == rows(TABLES["merchants_new_rows"](expected))


def test_rows_of_other_merchants_go_before_the_shuffle(spark, inputs, tmp_path):
    """A Bloom filter of the written list drops rows below the exchange, whatever the sizes here."""
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ws = run(spark, inputs)
        plans = {name: TABLES[name](ws)._jdf.queryExecution().executedPlan().toString()
                 for name in ("merchants_new_rows", "ecom_spend", "registry_dups")}
    finally:
        for key in settings:
            spark.conf.unset(key)
    for name, plan in plans.items():
        assert "might_contain" in plan, name


def test_malformed_lines_are_counted_and_left_out(spark, inputs, tmp_path):
    header = "anio,mes,provincia,rubroa12,marca_medio_pago,monto,operaciones,cuotas"
    lines = ["2022,8,Salta,Otros,VISA,1.5,10,3", "2022,8,Salta,Otros,VISA", "2022,8,Salta,Otros,VISA,1.5,10,3,9",
             "2022,13,Salta,Otros,VISA,1.5,10,3", "2022,8,Salta,Otros,VISA,many,10,3", "2022,8,Salta,,VISA,2,10,3"]
    (tmp_path / "payments.csv").write_text("\n".join([header, *lines]) + "\n")
    (tmp_path / "categories.csv").write_text("rubroa12\nOtros\n")
    source = FileInputs(spark, {"payments": f"{tmp_path}/payments.csv", "category_list": f"{tmp_path}/categories.csv"},
                        Stage(spark))
    assert [r.category for r in source.table("payments").orderBy("amount").collect()] == ["Otros", None]
    source.table("category_list")
    assert [tuple(r) for r in source.malformed().collect()] == [("malformed_payments", 4)]
