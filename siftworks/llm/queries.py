"""The registered queries: each applies its operator to whole tables and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import (
    chat,
    html_text,
    licenses,
    line_dedup,
    merkle,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    token_counts,
    topk,
    whitening,
)
from siftworks.sources.shared import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_simhash(spark, sf):
    out = simhash.near_duplicates(table(spark, sf, "documents"), width=4, max_bits=4)
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_top_k(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), "vec_id % 20 = 0", k=20)


@query
def op4_mixing(spark, sf):
    taken = mixing.Mix(table(spark, sf, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = materialize(quality.ledger(docs), "quality_ledger")
    base = ~quality.passes(quality.BASE)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & quality.passes(quality.WEB)).alias("kept"),
        "failed",
    )


@query
def quality_ablations(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.ablations(materialize(quality.ledger(docs), "quality_ledger"), quality.WEB)


@query
def op6_chat(spark, sf):
    text = "\\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.conversation_digests(chat.format_records(chat.turn_records(rows)))


@query
def op7_licenses(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "digest", "license", "notices")


@query
def op8_html(spark, sf):
    out = html_text.extract(table(spark, sf, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op9_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query
def op10_secrets(spark, sf):
    found = secrets.scan(table(spark, sf, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(secrets.BASE)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.written("base"), 256).alias("base_sha256"),
        secrets.written("spans").alias("spans"),
    )


@query
def op13_merkle(spark, sf):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(table(spark, sf, "documents"), tampered).drop("path")


@query
def op12_token_counts(spark, sf):
    counted = token_counts.count_tokens(table(spark, sf, "documents"), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op11_whitening(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    fitted = whitening.Whitening(vectors, "embedding", n_components=4)
    explained = F.array(*[F.lit(x) for x in fitted.explained]).cast("array<double>")
    return (
        fitted.apply(vectors)
        .select("vec_id", "deviation", F.posexplode(F.arrays_zip("whitened", explained.alias("explained"))).alias("at", "c"))
        .select(
            "vec_id",
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(fitted.n).cast("bigint").alias("n"),
            F.col("deviation").cast("bigint"),
            F.col("c.whitened").alias("whitened"),
            F.col("c.explained").alias("explained"),
            F.lit(fitted.identity_error).cast("double").alias("identity_error"),
        )
    )
