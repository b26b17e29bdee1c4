"""Session settings the jobs are designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

COMMON_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(cores: int) -> dict[str, str]:
    """Settings for a cluster.

    Sizes are per task and so hold for any input: many shuffle partitions to start with, which AQE
    merges up to the advisory size and splits where a key is hot. The broadcast limit stays at
    Spark's 10 MB of measured data.
    """
    return {
        **COMMON_CONF,
        "spark.sql.shuffle.partitions": str(max(cores * 4, 8)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("spendlens")
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spendlens-"))
    for key, value in COMMON_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
