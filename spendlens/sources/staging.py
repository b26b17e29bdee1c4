"""Intermediate tables written to shared storage.

A staged table plays the part of a saved intermediate: it cuts the lineage, survives the loss of
executors, and gives the optimizer a true size, so that a later join is broadcast only if the
written files are under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
PARTITIONS = "spark.sql.shuffle.partitions"
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}
TASK_ROWS = 600_000
_settings = threading.Lock()  # a session has one set of settings for all its threads


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where driver and executors
    are one process."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spendlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def bounded_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Settings under which the sorts and sums of a task fit its memory, however large the input is.

    A session's number of shuffle partitions is fixed, so its tasks grow with the input, and once they
    outgrow their memory every row of a join or sum is spilled besides being shuffled. Here their number
    follows ``rows``. Values of the session that give smaller tasks stay; all are put back at the end.
    """
    with _settings:
        before = {key: spark.conf.get(key, None) for key in (PARTITIONS, *TASK_BYTES)}
        try:
            spark.conf.set(PARTITIONS, str(max(int(spark.conf.get(PARTITIONS)), -(-rows // TASK_ROWS))))
            for key, size in TASK_BYTES.items():
                if _bytes(spark.conf.get(key)) > _bytes(size):
                    spark.conf.set(key, size)
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Stage:
    """Named tables of one run under the shared folder; each is written on first use."""

    def __init__(self, spark: SparkSession, parent: Stage | None = None):
        self.spark = spark
        self._parent = parent
        self._root: str | None = None
        self._tables: dict[str, DataFrame] = {}
        self._scopes: list[Stage] = []
        self._rows: int = 0
        self._lock = threading.RLock()  # reentrant: a table may be built from others

    def scope(self) -> Stage:
        """A stage with names of its own in a subfolder of this one, dropped with it.

        Inputs and workspaces each take a scope, so tables of runs with other parameters or paths
        are never mistaken for one another.
        """
        with self._lock:
            self._scopes.append(Stage(self.spark, self))
            return self._scopes[-1]

    @property
    def root(self) -> str:
        if self._root is None:
            folder = self._parent.root if self._parent else shared_folder(self.spark)
            self._root = f"{folder}/spendlens-{uuid.uuid4().hex}"
        return self._root

    @property
    def rows(self) -> int:
        """Rows of the largest input, as far as known: what the number of tasks follows."""
        return self._parent.rows if self._parent else self._rows

    def expect(self, rows: int) -> None:
        if self._parent:
            self._parent.expect(rows)
        else:
            self._rows = max(self._rows, rows)

    def table(self, name: str, build: Callable[[], DataFrame],
              sort_within: str | None = None) -> DataFrame:
        """``sort_within`` orders each file by a column, without a shuffle, so that a later
        filter on it skips row groups and pages by their statistics."""
        with self._lock:
            if name not in self._tables:
                df = build()
                path = f"{self.root}/{name}"
                rows = df.sortWithinPartitions(sort_within) if sort_within else df
                with bounded_tasks(self.spark, self.rows):
                    rows.write.mode("overwrite").parquet(path)
                self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
            return self._tables[name]

    def drop(self) -> None:
        """Delete the tables of this run; their DataFrames must not be used afterwards."""
        with self._lock:
            for scope in self._scopes:
                scope.drop()
            if self._root is not None:
                context = self.spark.sparkContext
                path = context._jvm.org.apache.hadoop.fs.Path(self._root)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
            self._root = None
            self._tables.clear()
