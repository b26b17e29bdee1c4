"""Batch job: read the inputs, save (or load) weights and final base, publish the report bundles.

    spark-submit --conf spark.checkpoint.dir=<shared folder> --py-files spendlens.zip \\
        spendlens/job.py \\
        --input payments=<path> --input platform_sales=<path> ... \\
        --output <folder> --reports monthly province --cutoff 2022-08-01
"""

from __future__ import annotations

import argparse
import ast
from collections.abc import Sequence
from dataclasses import fields, replace

from pyspark.sql import SparkSession

from spendlens.params import Params
from spendlens.plans.registry import BUNDLES, FROM_BASE, FROM_HISTORY, HEADERLESS, PUBLISHED, TABLES, order_of
from spendlens.plans.workspace import Workspace
from spendlens.session import COMMON_CONF
from spendlens.sources import versions
from spendlens.sources.files import FileInputs
from spendlens.sources.sinks import publish
from spendlens.sources.staging import Stage


def publish_reports(ws: Workspace, output: str, reports: Sequence[str], fmt: str) -> dict[str, str]:
    """Publish each named bundle as a new version under ``output``; returns the folder of every table.

    A bundle becomes current when all its tables are written. The version before it stays for those
    who are reading it; older ones go.
    """
    targets, version = {}, versions.new_version()
    for report in reports:
        folder = f"{output}/{report}"
        before = versions.current(ws.spark, folder)
        tables = {name: TABLES[name](ws) for name in BUNDLES[report]}
        targets |= publish(tables, f"{folder}/{version}", fmt, order_of, HEADERLESS, PUBLISHED)
        versions.make_current(ws.spark, folder, version)
        versions.delete_others(ws.spark, folder, {version, before})
    return targets


def published(spark: SparkSession, output: str, report: str) -> dict[str, str]:
    """The folder of every table of the current version of a bundle."""
    version = versions.current(spark, f"{output}/{report}")
    if version is None:
        raise ValueError(f"nothing is published in {output}/{report}")
    return {name: f"{output}/{report}/{version}/{name}" for name in BUNDLES[report]}


def setting(item: str) -> tuple[str, object]:
    """A field of ``Params`` and its value: a Python literal, or text such as a date."""
    name, _, text = item.partition("=")
    if name not in {f.name for f in fields(Params)}:
        raise ValueError(f"unknown parameter: {name}")
    try:
        return name, ast.literal_eval(text)
    except (SyntaxError, ValueError):
        return name, text


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Instalment-spending reports")
    parser.add_argument("--input", action="append", required=True, metavar="TABLE=PATH")
    parser.add_argument("--output", required=True)
    parser.add_argument("--base", help="output of an earlier run whose weights and base to start from")
    parser.add_argument("--reports", nargs="+", choices=list(BUNDLES), default=list(BUNDLES))
    parser.add_argument("--format", choices=("parquet", "csv", "json", "orc"), default="csv")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE",
                        help="any field of spendlens.params.Params, for example years=(2022,2023)")
    parser.add_argument("--cutoff", help="last complete month, for example 2022-08-01")
    parser.add_argument("--base-month", help="month that real amounts are expressed in")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> dict[str, str]:
    args = arguments(argv)
    spark = SparkSession.builder.appName("spendlens").getOrCreate()
    given = dict(setting(item) for item in args.set)
    given |= {k: v for k, v in (("cutoff", args.cutoff), ("base_month", args.base_month)) if v}
    for key, value in COMMON_CONF.items():
        spark.conf.set(key, value)
    stage = Stage(spark)
    inputs = FileInputs(spark, dict(item.split("=", 1) for item in args.input), stage)
    ws = Workspace(spark, inputs, replace(Params(), **given), stage)
    try:
        if args.base:
            ws.load_base(args.base)
        elif not FROM_BASE.isdisjoint(args.reports):
            ws.save_base(args.output)
        if not FROM_HISTORY.isdisjoint(args.reports):
            ws.save_merchants(args.output)
        return publish_reports(ws, args.output, args.reports, args.format)
    finally:
        stage.drop()


if __name__ == "__main__":
    main()
