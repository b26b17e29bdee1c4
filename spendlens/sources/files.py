"""The input tables from files: raw monthly CSV extracts or Parquet, one path per table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.exprs import in_months, month_from, month_of
from spendlens.schemas import HEADERS, INPUTS
from spendlens.sources.staging import Stage


MALFORMED, BROKEN = "_malformed", "_broken_line"


def english_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(HEADERS)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename raw headers, build ``period`` from year and month, cast to the table's schema.

    A DATE ``period`` must hold first days of months. It passes untouched, so that filters on it reach
    the Parquet scan and prune partitions; the ``checks`` table counts other days.
    """
    named = english_names(df)
    if "period" in schema.names:
        if "period" in named.columns:
            if not isinstance(named.schema["period"].dataType, T.DateType):
                named = named.withColumn("period", month_of(F.col("period")))
        else:
            named = named.withColumn("period", month_from(
                F.col("year").cast("double").cast("int"), F.col("month").cast("double").cast("int")))
    return named.select(*[_typed(named, f).alias(f.name) for f in schema])


def _typed(df: DataFrame, field: T.StructField) -> Column:
    """Cast to the declared type; whole numbers written as "3.0" or "3e2" are accepted in text."""
    column = F.col(field.name)
    whole = isinstance(field.dataType, T.IntegerType | T.LongType)
    if whole and isinstance(df.schema[field.name].dataType, T.StringType):
        column = column.cast("decimal(38,6)")
    return column.cast(field.dataType)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw text columns named by the header line, and ``_malformed``; empty fields and "NA" are null.

    Nothing is inferred from the data: ``conform`` casts to the declared types. Files of one folder
    must name their columns in the same order; others are refused rather than read by position. A line
    with too few or too many fields is malformed.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
    columns = reader.csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BROKEN]])
    raw = reader.schema(text).option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).csv(path)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin("", "NA"), F.col(f"`{c}`")).alias(c) for c in columns],
                      F.col(BROKEN).isNotNull().alias(MALFORMED))


def parse_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns and ``_malformed``: a wrong number of fields, or a value of another type.

    Values that cannot be read are null here, and a month outside 1 to 12 is one of them.
    """
    raw = english_names(read_csv(spark, path))
    given = [c for c in raw.columns if c != MALFORMED]
    if "period" in schema.names and "period" not in given:
        year, month = (F.col(c).try_cast("double").cast("int") for c in ("year", "month"))
        valid = F.when(month.between(1, 12) & year.between(1, 9999), month_from(year, month))
        raw = raw.withColumn("period", F.coalesce(valid.cast("string"), F.concat_ws("-", "year", "month")))
        raw = raw.withColumn("period", F.when(F.col("year").isNotNull() & F.col("month").isNotNull(), F.col("period")))
    values = {f.name: _parsed(F.col(f.name), f.dataType) for f in schema}
    unread = [F.col(name).isNotNull() & value.isNull() for name, value in values.items()]
    return raw.select(*[value.alias(name) for name, value in values.items()],
                      reduce(Column.__or__, unread, F.col(MALFORMED)).alias(MALFORMED))


def _parsed(text: Column, kind: T.DataType) -> Column:
    """Text as its declared type, null if it is not of that type; whole numbers may be written "3.0"."""
    if isinstance(kind, T.DateType):
        return F.trunc(text.try_cast("date"), "MM")
    if isinstance(kind, T.IntegerType | T.LongType):
        text = text.try_cast("decimal(38,6)")
    return text.try_cast(kind)


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col(MALFORMED)).drop(MALFORMED)


CSV = (".csv", ".csv.gz")


def is_csv(spark: SparkSession, path: str) -> bool:
    """By the name of the path, or by those of the files in it, such as one extract per month."""
    if path.rstrip("/").lower().endswith(CSV):
        return True
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(folder) and any(
        status.getPath().getName().lower().endswith(CSV) for status in files.listStatus(folder))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The well-formed rows of a table."""
    if is_csv(spark, path):
        return well_formed(parse_csv(spark, path, schema))
    return conform(spark.read.parquet(path), schema)


class FileInputs:
    """``FileInputs(spark, {"payments": "/data/payments.csv", ...})``.

    With a stage, text files are parsed once and kept as Parquet; Parquet inputs are read in place.
    """

    def __init__(self, spark: SparkSession, paths: Mapping[str, str], stage: Stage | None = None):
        unknown = set(paths) - set(INPUTS)
        if unknown:
            raise ValueError(f"unknown input tables: {sorted(unknown)}")
        self.spark = spark
        self.paths = dict(paths)
        self.stage = stage.scope() if stage else None
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._open(self.paths[name], name)
        return self._tables[name]

    def months(self, name: str, since: str | None, until: str | None) -> DataFrame:
        """The table, with what a file of year and month columns holds outside a range of months left
        out by the scan. Other files take a filter on ``period`` as it is."""
        path = self.paths[name]
        if is_csv(self.spark, path):
            return self.table(name)
        raw = self.spark.read.parquet(path)
        named = english_names(raw)
        if "period" in named.columns or not all(
                isinstance(named.schema[c].dataType, T.NumericType) for c in ("year", "month")):
            return self.table(name)
        return conform(named.filter(in_months(since, until)), INPUTS[name])

    def _open(self, path: str, name: str) -> DataFrame:
        if self.stage is None or not is_csv(self.spark, path):
            return read_table(self.spark, path, INPUTS[name])
        return well_formed(self._parsed(path, name))

    def _parsed(self, path: str, name: str) -> DataFrame:
        schema = INPUTS[name]
        return self.stage.table(f"input_{name}", lambda: parse_csv(self.spark, path, schema),
                                sort_within="period" if "period" in schema.names else None)

    def malformed(self) -> DataFrame | None:
        """(check, violations) of the text files opened so far that have malformed lines.

        Such lines are in no table. They are counted where they were parsed, in the written copy.
        """
        if self.stage is None:
            return None
        counts = [self._parsed(path, name).agg(F.lit(f"malformed_{name}").alias("check"),
                                               F.count_if(MALFORMED).alias("violations"))
                  for name, path in self.paths.items() if name in self._tables and is_csv(self.spark, path)]
        return reduce(DataFrame.unionByName, counts).filter("violations > 0") if counts else None
