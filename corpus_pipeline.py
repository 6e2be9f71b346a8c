"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing and packing over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet in the shared folder and read again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import line_dedup, mixing, packing, quality, simhash
from siftworks.sources.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the web policy keeps."""
    judged = quality.with_failed(quality.measure(docs))
    return quality.kept_by(quality.WEB, judged).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share; n_chars follows the text."""
    out = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1, kept="text")
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (four words, four bits), the one with the smallest id."""
    return simhash.keep_one(docs, width=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget holds it."""
    return mixing.Mix(docs).repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# Packing needs the tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
