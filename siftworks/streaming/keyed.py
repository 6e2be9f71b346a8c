"""Starting queries whose state Spark keeps by key, and small steps before their shuffles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# The state store that keyed processors need, which holds state on disk, and
# checkpoints that write what a batch changed instead of all files of the store.
STORE = "spark.sql.streaming.stateStore"
SETTINGS = {
    f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}
BATCH_ID = "streaming.sql.batchId"


def append_to(df: DataFrame, location: str, name: str, every: str | None) -> StreamingQuery:
    """Append the rows of a stream to the Parquet folder ``name`` of ``location`` by Spark's file sink.

    The sink's log names each batch's files once, so a batch that runs again adds nothing. Without
    ``every`` the query works off what is there and stops.
    """
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        conf.set(k, v)
    try:
        writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{location}/checkpoint")
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return writer.option("path", f"{location}/{name}").trigger(**trigger).start()
    finally:
        # a query keeps the settings it was started with
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)


def summed(df: DataFrame, *columns: str) -> DataFrame:
    """(batch_id, sums of the columns) of a stream: a row per Arrow batch, so a few per micro-batch."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = int(TaskContext.get().getLocalProperty(BATCH_ID))
        for frame in frames:
            if len(frame):
                yield frame.sum().to_frame().T.assign(batch_id=batch)

    return df.select(*columns).mapInPandas(add, ", ".join(f"{c} long" for c in [*columns, "batch_id"]))
