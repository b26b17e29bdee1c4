"""Versions of saved tables, side by side in one folder, and the pointer to the current one.

A version is written beside the earlier ones and made current by a small file that is replaced last,
in one rename. A job that fails on its way leaves the pointer, and with it the earlier version, as they
were; what it wrote is left to the next job to delete.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection
from datetime import UTC, datetime

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

POINTER = "CURRENT"
NAME = re.compile(r"\d{8}T\d{6}-[0-9a-f]{8}")


def new_version() -> str:
    """A name that sorts by time and that no other job takes."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _path(spark: SparkSession, *parts: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, *parts: str) -> bool:
    path = _path(spark, *parts)
    return _files(spark, path).exists(path)


def folders(spark: SparkSession, *parts: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    path = _path(spark, *parts)
    files = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []


def delete(spark: SparkSession, *parts: str) -> None:
    path = _path(spark, *parts)
    _files(spark, path).delete(path, True)


def current(spark: SparkSession, folder: str) -> str | None:
    """The version that the pointer in ``folder`` names, if there is one."""
    if not exists(spark, folder, POINTER):
        return None
    return spark.read.text(f"{folder}/{POINTER}").first().value


def make_current(spark: SparkSession, folder: str, version: str) -> None:
    """Replace the pointer; readers see the earlier or the new version, and never neither."""
    place, draft = _path(spark, folder, POINTER), _path(spark, folder, f".{POINTER}-{uuid.uuid4().hex}")
    stream = _files(spark, draft).create(draft, True)
    stream.write(bytearray(f"{version}\n".encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, place, options)


def delete_others(spark: SparkSession, folder: str, kept: Collection[str | None]) -> None:
    """Delete the versions in ``folder`` but those in ``kept``; folders of other names stay."""
    for version in folders(spark, folder):
        if NAME.fullmatch(version) and version not in kept:
            delete(spark, folder, version)
