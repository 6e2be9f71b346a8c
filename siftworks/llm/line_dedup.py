"""Line dedup: lines that many documents share are dropped everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.text import ascii_lower, fingerprint, free_names, strip_white
from siftworks.sources.shared import materialize


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _hashes(lines: Column, min_chars: int) -> Column:
    """The 128-bit hash of each line's key; NULL for keys that are never dropped."""
    keys = F.transform(F.transform(lines, strip_white), ascii_lower)

    def hashed(key: Column) -> Column:
        a, b = fingerprint(key)
        return F.when(F.char_length(key) >= min_chars, F.struct(a.alias("a"), b.alias("b")))

    return F.transform(keys, hashed)


def common_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(_a, _b, n_docs): hashes of the lines found in at least ``min_docs`` rows.

    A row counts a line once, so the lines are made distinct within the row and
    need no document id; counts are combined before the shuffle.
    """
    seen = F.array_distinct(F.filter(_hashes(_lines(text), min_chars), lambda h: h.isNotNull()))
    return (
        docs.select(F.explode(seen).alias("_h"))
        .groupBy(F.col("_h.a").alias("_a"), F.col("_h.b").alias("_b"))
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )


def drop_common_lines(
    docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, kept: str = "kept_text"
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and the text without its common lines.

    A line's key is the line without ASCII white space at both ends and with A-Z
    in lower case. All lines whose key has at least ``min_chars`` code points and
    occurs in at least ``min_docs`` rows go, in every row; the others are joined
    again in their order. Each row is a document, also a repeated one or one
    without an id; ids are not used. A NULL text is one empty line and stays ''.
    Columns of ``docs`` named like an output column are replaced, all others stay whatever their names.

    Which positions go depends on the text alone, so decisions are made per
    distinct text and joined back to every copy. Both joins have a stored side
    with one row per key, so adaptive execution can split a line or a text that
    makes up a large part of all rows.
    """
    docs = docs.drop("n_lines", "n_dropped", *([kept] if kept != text else []))
    common = materialize(common_lines(docs, text, min_docs, min_chars).select("_a", "_b"), "common_lines")
    lines = _lines(text)
    ta, tb = fingerprint(F.coalesce(F.col(text), F.lit("")))
    at = docs.select(ta.alias("_ta"), tb.alias("_tb"), F.posexplode(_hashes(lines, min_chars)).alias("_pos", "_h"))
    hits = (
        at.filter(F.col("_h").isNotNull())
        .select("_ta", "_tb", "_pos", F.col("_h.a").alias("_a"), F.col("_h.b").alias("_b"))
        .join(common, ["_a", "_b"], "left_semi")
        .groupBy("_ta", "_tb")
        .agg(F.collect_set("_pos").alias("_drop"))
    )
    hits = materialize(hits, "dropped_lines")
    a, b, all_lines, drop = free_names([*docs.columns, kept], "ta", "tb", "lines", "drop")
    cut = docs.withColumns({a: ta, b: tb, all_lines: lines})
    cut = cut.drop(text) if kept == text else cut
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(drop))
    chosen = F.when(F.col(drop).isNull(), F.col(all_lines)).otherwise(
        F.transform(left, lambda i: F.get(F.col(all_lines), i))
    )
    return (
        cut.join(hits.toDF(a, b, drop), [a, b], "left")
        .withColumns(
            {
                "n_lines": F.size(all_lines).cast("bigint"),
                "n_dropped": F.coalesce(F.size(drop), F.lit(0)).cast("bigint"),
                kept: F.array_join(chosen, "\n"),
            }
        )
        .drop(a, b, all_lines, drop)
    )
