from __future__ import annotations

from dataclasses import replace
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from frames import rows
from spendlens import job
from spendlens.params import Params
from spendlens.plans.registry import BUNDLES, PUBLISHED, TABLES, order_of
from spendlens.plans.workspace import Workspace
from spendlens.schemas import INPUTS, MERCHANT_REGISTRY, PAYMENTS
from spendlens.sources import sinks, staging
from spendlens.sources.files import FileInputs, read_table
from spendlens.sources.retail import PARAMS, RetailInputs
from spendlens.sources.staging import Stage


def test_csv_headers_types_and_nulls(spark, tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text(
        "anio,mes,provincia,rubroa12,marca_medio_pago,monto,operaciones,cuotas\n"
        "2022,8,Salta,Otros,VISA,1234.5678,10,3\n"
        "2022,7,Salta,Otros,NA,1.2e3,3.0,12\n"
        "2022,6,Salta,,VISA,,3,12\n")
    df = read_table(spark, str(path), PAYMENTS)
    assert df.schema == PAYMENTS
    assert rows(df) == [
        (date(2022, 6, 1), "Salta", None, "VISA", 12, 3, None),
        (date(2022, 7, 1), "Salta", "Otros", None, 12, 3, 1200.0),
        (date(2022, 8, 1), "Salta", "Otros", "VISA", 3, 10, 1234.5678)]


def test_other_raw_headers(spark, tmp_path):
    path = tmp_path / "registry.csv"
    path.write_text("cuit,razon_social,provincia,localidad,direccion\n30,Uno SA,Salta,Cafayate,Calle 1\n")
    assert rows(read_table(spark, str(path), MERCHANT_REGISTRY)) == [
        (30, "Uno SA", "Salta", "Cafayate", "Calle 1")]
    index = tmp_path / "index.csv"
    index.write_text("periodo,ipc_indec_ng\n2022-08-15,101.5\n")
    assert rows(read_table(spark, str(index), INPUTS["price_index"])) == [(date(2022, 8, 1), 101.5)]


def test_unknown_input_is_refused(spark):
    with pytest.raises(ValueError, match="unknown"):
        FileInputs(spark, {"sales": "/x"})


class FakeSession:
    """Only what ``shared_folder`` asks a session for."""

    def __init__(self, master, configured=None, checkpoint=None):
        self.conf = SimpleNamespace(get=lambda key, default: configured or default)
        self.sparkContext = SimpleNamespace(
            master=master, getCheckpointDir=lambda: checkpoint, setCheckpointDir=lambda folder: None)


def test_shared_folder_is_the_configured_one():
    assert staging.shared_folder(FakeSession("yarn", configured="hdfs:///x")) == "hdfs:///x"
    assert staging.shared_folder(FakeSession("yarn", checkpoint="hdfs:///c/id")) == "hdfs:///c/id"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(FakeSession("yarn"))
    assert Path(staging.shared_folder(FakeSession("local[2]"))).is_dir()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(FakeSession("local-cluster[2,1,1024]"))


def test_stage_writes_once(spark):
    stage = Stage(spark)
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    assert stage.table("t", build).count() == stage.table("t", build).count() == 5
    assert built == [1]
    assert stage.table("t", build).inputFiles()[0].startswith(f"file://{stage.root}/t/")


def test_split_and_save_replace_earlier_contents(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "province string, n int")
    target = str(tmp_path / "split")
    sinks.split(df, "province", target)
    sinks.split(df.filter("n > 1"), "province", target)
    assert sorted(p.name for p in Path(target).glob("province=*")) == ["province=a", "province=b"]
    assert rows(spark.read.parquet(target), "province", "n") == [("a", 2), ("b", 3)]


def test_publish_orders_and_omits_headers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "aggregator string, amount double")
    targets = sinks.publish({"aggregator_rank": df}, str(tmp_path), "csv", order_of, ["aggregator_rank"])
    lines = [line for f in sorted(Path(targets["aggregator_rank"]).glob("part-*"))
             for line in f.read_text().splitlines()]
    assert lines == ["b,2.0", "a,1.0"]
    with pytest.raises(ValueError, match="format"):
        sinks.publish({}, str(tmp_path), "xlsx")


def test_bundles_name_registered_tables():
    assert {n for names in BUNDLES.values() for n in names} <= set(TABLES)
    assert {k: len(v) for k, v in BUNDLES.items()} | {} == {
        "monthly": 17, "province": 8, "category": 5, "platform": 12, "aggregator": 12,
        "merchants": 5, "since": 1, "checks": 7}


RAW_NAMES = {
    "category": "rubroa12", "province": "provincia", "payment_brand": "marca_medio_pago",
    "platform": "plataforma", "aggregator": "agrupador", "installments": "cuotas",
    "operations": "operaciones", "amount": "monto", "merchant_id": "cuit",
    "legal_name": "razon_social", "locality": "localidad", "address": "direccion",
    "population": "poblacion", "index_level": "ipc_indec_ng",
}


@pytest.fixture(scope="module")
def raw_files(spark, small_dir, tmp_path_factory):
    """The retail inputs written as raw CSV files with the original header names."""
    folder = tmp_path_factory.mktemp("raw")
    ws = entry_module.workspace(spark, small_dir)
    paths = {}
    for name in INPUTS:
        df = ws.table(name)
        if name != "price_index" and "period" in df.columns:
            df = df.select(F.year("period").alias("anio"), F.month("period").alias("mes"),
                           *[c for c in df.columns if c != "period"])
        paths[name] = f"{folder}/{name}.csv"
        df.withColumnsRenamed(RAW_NAMES).write.option("header", True).csv(paths[name])
    return paths


def test_reports_from_raw_files_equal_reports_from_tables(spark, raw_files, small_dir):
    stage = Stage(spark)
    ws = Workspace(spark, FileInputs(spark, raw_files, stage), PARAMS, stage)
    expected = entry_module.workspace(spark, small_dir)
    for name in ("final_base", "cat_growth5_year", "merchant_share", "summary12", "checks"):
        assert rows(TABLES[name](ws)) == rows(TABLES[name](expected)), name


def test_job_publishes_bundles_and_a_second_run_starts_from_its_base(
        spark, raw_files, tmp_path, monkeypatch):
    monkeypatch.setattr(job, "Params", lambda: PARAMS)
    inputs = [a for name, path in raw_files.items() for a in ("--input", f"{name}={path}")]
    first, second = f"{tmp_path}/first", f"{tmp_path}/second"
    common = ["--cutoff", "2001-06-01", "--format", "parquet", "--reports"]
    targets = job.main([*inputs, "--output", first, *common, "province", "since"])
    assert len(targets) == 9
    assert Path(first, "final_base", "period=2001-06-01").is_dir()
    latest = spark.read.parquet(targets["prov_share_amount"]).agg(F.max("period")).first()[0]
    assert latest == date(2001, 6, 1)

    # Without payments the base cannot be built again: it has to be the saved one.
    others = [a for name, path in raw_files.items() if name != "payments"
              for a in ("--input", f"{name}={path}")]
    again = job.main([*others, "--output", second, "--base", first, *common, "since"])
    assert rows(spark.read.parquet(again["cat_share_since"])) == rows(
        spark.read.parquet(targets["cat_share_since"]))


def test_two_cutoffs_on_one_stage_are_two_runs(spark, small_dir):
    stage = Stage(spark)
    inputs = RetailInputs(spark, small_dir, stage)
    for cutoff in ("2001-07-01", "2000-06-01"):
        ws = Workspace(spark, inputs, replace(PARAMS, cutoff=cutoff), stage)
        assert TABLES["m_nominal"](ws).agg(F.max("period")).first()[0] == date.fromisoformat(cutoff)


def test_a_saved_base_is_read_up_to_an_earlier_cutoff_and_refuses_a_later_one(spark, small_dir, tmp_path):
    def run(cutoff):
        stage = Stage(spark)
        return Workspace(spark, RetailInputs(spark, small_dir, stage), replace(PARAMS, cutoff=cutoff), stage)

    run("2000-06-01").save_base(str(tmp_path))
    earlier = run("1999-12-01").load_base(str(tmp_path))
    assert earlier.base.agg(F.max("period")).first()[0] == date(1999, 12, 1)
    with pytest.raises(ValueError, match="2000-06-01"):
        run("2001-07-01").load_base(str(tmp_path))


def test_date_periods_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/sales"
    spark.sql("SELECT date'2022-01-01' AS period, 'P' AS province, 'a' AS category, 1L AS merchant_id, 1L AS operations, "
              "CAST(1 AS DECIMAL(28,4)) AS amount").write.parquet(path)
    df = FileInputs(spark, {"merchant_sales": path}).table("merchant_sales").filter("period >= date'2021-01-01'")
    assert "GreaterThanOrEqual(period" in df._jdf.queryExecution().executedPlan().toString()


def test_merchant_bundle_needs_merchant_sales_alone(spark, raw_files, tmp_path, monkeypatch):
    monkeypatch.setattr(job, "Params", lambda: PARAMS)
    targets = job.main(["--input", f"merchant_sales={raw_files['merchant_sales']}", "--output", f"{tmp_path}/out",
                        "--reports", "merchants", "--format", "parquet"])
    counted = spark.read.parquet(targets["merchants_since_count"]).first()[0]
    assert counted == spark.read.parquet(targets["merchants_since"]).count() > 0


def test_a_folder_of_monthly_files(spark, tmp_path):
    header = "anio,mes,provincia,rubroa12,marca_medio_pago,monto,operaciones,cuotas"
    for month in (7, 8):
        (tmp_path / f"2022-{month}.csv").write_text(f"{header}\n2022,{month},Salta,Otros,VISA,1.5,10,3\n")
    assert rows(read_table(spark, str(tmp_path), PAYMENTS), "period") == [(date(2022, 7, 1),), (date(2022, 8, 1),)]
    (tmp_path / "2022-9.csv").write_text("mes,anio" + header[8:] + "\n9,2022,Salta,Otros,VISA,1.5,10,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path), PAYMENTS).collect()


def test_settings_of_a_run():
    assert job.setting("years=(2022,2023)") == ("years", (2022, 2023))
    assert job.setting("new_month=2022-09-01") == ("new_month", "2022-09-01")
    with pytest.raises(ValueError, match="unknown"):
        job.setting("yeras=1")


def test_published_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "aggregator string, amount double")
    targets = sinks.publish({"aggregator_rank": df}, str(tmp_path), "csv", order_of, ["aggregator_rank"], PUBLISHED)
    assert [line for f in sorted(Path(targets["aggregator_rank"]).glob("part-*"))
            for line in f.read_text().splitlines()] == ["b", "a"]


def test_dropping_a_stage_deletes_its_tables(spark):
    stage = Stage(spark)
    stage.table("t", lambda: spark.range(3))
    root = Path(stage.root)
    assert root.is_dir()
    stage.drop()
    assert not root.exists()
    assert stage.table("t", lambda: spark.range(4)).count() == 4


def test_default_parameters_are_the_programme_values():
    p = Params()
    assert (p.cutoff, p.plans, p.fill_plan, p.top_categories, p.top_merchants) == (
        "2022-08-01", (3, 6, 12, 18, 24), 24, 7, 10)
    assert p.merges["Televisores"] == "Electrodomésticos"
