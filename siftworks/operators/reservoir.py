"""A uniform sample of fixed size.

The ``k`` rows with the smallest seeded hash are a uniform sample without
replacement. Unlike slot replacement it needs no order and no single writer:
samples of parts merge into the sample of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.functions.hashing import priority


def reservoir(df: DataFrame, k: int = 100, seed: int = 42, key: str = "event_id") -> DataFrame:
    """``k`` rows of ``df`` (all, if there are fewer), chosen by the hash of ``key``."""
    return (
        df.withColumn("_priority", priority(seed, key))
        .orderBy("_priority", key)
        .limit(k)
        .drop("_priority")
    )
