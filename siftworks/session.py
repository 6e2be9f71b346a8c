"""Session settings for local runs, tests and the benchmark.

On a cluster the caller brings its own session; nothing in the library needs
the settings below to give right results.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftworks")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    if not spark.conf.get("spark.checkpoint.dir", None):
        # one machine, one disk: on a cluster this is a folder that all executors share
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="siftworks-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark
