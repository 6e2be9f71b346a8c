"""Tables written once in the folder all executors share.

Iterative operators cut their lineage here. A written table survives the loss
of executors, is computed once, and its file sizes give Catalyst the statistics
it needs to choose broadcast or shuffle joins by actual size.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows per partition of a table that is held through the rounds of a run.
ROWS_PER_PARTITION = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, else the session's checkpoint folder, else one in the warehouse."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/siftworks-{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove all tables stored for this application; results that still read them are lost."""
    app = spark.sparkContext.applicationId
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/siftworks-{app}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(df: DataFrame, rows: int | None = None) -> int:
    """A number of partitions for a held table, from its rows, which are counted if not given.

    AQE does not change the partitioning of a cached table, so it is chosen here: enough
    for the rows, and for all cores where there are fewer rows.
    """
    spark = df.sparkSession
    cores = min(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return max(cores, math.ceil((df.count() if rows is None else rows) / ROWS_PER_PARTITION))
