"""State tables of ``foreachBatch`` programs.

Everything lies under one folder: ``checkpoint`` for Spark, and tables written
once per micro-batch. Each write overwrites its own batch only, and batch b reads
only what batches before b wrote, so a batch that is run again after a failure
gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


class BatchTables:
    def __init__(self, location: str):
        self.location = location.rstrip("/")

    # --- small tables replaced as a whole: two slots in turn, the other one being the previous state ---

    def _slot(self, name: str, batch_id: int) -> str:
        return f"{self.location}/{name}/slot-{batch_id % 2}"

    def replace(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            self._slot(name, batch_id)
        )

    def previous(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> DataFrame:
        """The table as the batch before ``batch_id`` left it; empty for the first batch."""
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        stored = spark.read.schema(f"{schema}, batch_id bigint").parquet(self._slot(name, batch_id - 1))
        return stored.filter(F.col("batch_id") == batch_id - 1).drop("batch_id")

    def current(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """The table as the last batch left it; empty before the first."""
        last = self.last_batch(spark)
        return self.previous(spark, name, schema, 0 if last is None else last + 1)

    # --- growing tables: one folder per batch ---

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.location}/{name}/batch_id={batch_id}"

    def append(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(name, batch_id))

    def added(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> DataFrame:
        """The rows one batch appended; none for a batch before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._folder(name, batch_id))

    def log(self, spark: SparkSession, schema: str) -> DataFrame:
        """The running report: one row per micro-batch."""
        return spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{self.location}/report")

    def last_batch(self, spark: SparkSession) -> int | None:
        try:
            rows = spark.read.schema("batch_id bigint").parquet(f"{self.location}/report")
            return rows.agg(F.max("batch_id")).first()[0]
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise


def start(
    writer: DataStreamWriter, tables: BatchTables, every: str | None
) -> StreamingQuery:
    """Start with a processing-time trigger, or work off what is there and stop if ``every`` is None."""
    writer = writer.option("checkpointLocation", f"{tables.location}/checkpoint")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
