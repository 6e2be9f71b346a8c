"""License scans: texts and lines whose canonical form is that of a known license text or notice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.license_texts import DIGESTS, NOTICES, TEXTS
from siftworks.llm.text import ascii_lower, free_names, strip_white

# Spellings that count as the same, applied in this order after lower-casing.
SPELLINGS = {
    "licence": "license",
    "sub-licen": "sublicen",
    "non-infring": "noninfring",
    "http://": "https://",
    "organisation": "organization",
    "merchantibility": "merchantability",
    "per cent": "percent",
    "copyright owner": "copyright holder",
}

# A lower-cased line that names a copyright holder, and what is no letter or digit.
COPYRIGHT = r"[^a-z0-9]*(copyright([^a-z].*)?|\(c\) .*|©.*|all rights reserved[^a-z]*)"
# Fixed value: every known notice has one of these words.
NOTICE_WORD = r"(?i)licen[cs]e"
# As COPYRIGHT, but only lines that make a claim, with a sign, a year or a place for
# one, since running text may start a line with the word; and titles before the first words of a text.
CLAIM = (
    r"[^a-z0-9\n]*(copyright[ \t:]*(\(c\)|©|[0-9]{4}|[<\[{]).*"
    r"|(\(c\)|©)[ \t]*(copyright[ \t]*)?([0-9]{4}|[<\[{]).*|all rights reserved[^a-z0-9\n]*)"
)
TITLE = (
    # taken for good (++): given back word by word, a text that begins with thousands of them needs a stack as deep
    r"^(?:(?:the|mit|expat|isc|zlib|libpng|bsd|0bsd|zero|clause|[0-3]|simplified|freebsd|new|modified|revised|unlicense|license) )++"
    r"(?=permission |redistribution |this software is provided |this is free and unencumbered )"
    r"|^apache license (version 2 0 january 2004 )?(https www apache org licenses )?(?=terms and conditions for use )"
)
PUNCTUATION = r"[^a-z0-9\x{80}-\x{10ffff}]+"


def canonical(text: Column, claims: str = COPYRIGHT) -> Column:
    """Lower case, one spelling, without copyright lines, each run of punctuation and blanks one blank."""
    out = ascii_lower(text)
    for found, put in SPELLINGS.items():
        out = F.replace(out, F.lit(found), F.lit(put))
    claim = rf"(?m)^{claims}$"
    out = F.when(out.rlike(claim), F.regexp_replace(out, claim, "")).otherwise(out)
    return strip_white(F.regexp_replace(out, PUNCTUATION, " "))


def digest(text: Column) -> Column:
    return F.md5(canonical(text).cast("binary"))


def body_digest(text: Column) -> Column:
    """The digest of a whole text without claims and title, the same however its paragraphs are wrapped."""
    return F.md5(F.regexp_replace(canonical(text, CLAIM), TITLE, "").cast("binary"))


def known_bodies(spark: SparkSession) -> DataFrame:
    """(digest, license): one row per ``body_digest`` of a known whole text."""
    rows = [(name, body, None) for name, body in TEXTS.items()] + [(name, None, d) for name, ds in DIGESTS.items() for d in ds.split()]
    table = spark.createDataFrame(rows, "license string, body string, digest string")
    return table.groupBy(F.coalesce("digest", body_digest(F.col("body"))).alias("digest")).agg(F.min("license").alias("license"))


def known_digests(spark: SparkSession, texts: dict[str, str] | None = None, kind: str = "text") -> DataFrame:
    """(digest, license): one row per known text; the table is as long as the list in the code."""
    rows = [(name, body) for name, body in (texts or {"text": TEXTS, "notice": NOTICES}[kind]).items()]
    table = spark.createDataFrame(rows, "license string, body string")
    # two names for one text: the first in alphabetical order stands for both
    return table.groupBy(digest(F.col("body")).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with digest, license and notices.

    ``digest`` is the canonical digest of the whole text, ``license`` the known
    text it equals, also by ``body_digest`` (NULL if none), ``notices`` the licenses named by lines that are
    known notices, in order of their first line, joined by commas ('' if none). NULL and
    empty texts have the digest of the empty text and no license. Columns of
    these names are replaced. Both lookups are hash joins against a table as
    short as the list of licenses; no row of ``docs`` is moved.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.drop(*[c for c in ("digest", "license", "notices") if c != text])
    d, b, by_body = free_names(docs.columns, "d", "b", "body")
    whole = F.broadcast(known_digests(spark).withColumnRenamed("digest", d))
    bodies = F.broadcast(known_bodies(spark).select(F.col("digest").alias(b), F.col("license").alias(by_body)))
    # the known notices as one row: a map from digest to license, bounded by the list in the code
    notices = known_digests(spark, kind="notice").collect()
    lookup = F.create_map(*[F.lit(x) for r in notices for x in (r["digest"], r["license"])])
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(NOTICE_WORD))
    named = F.transform(lines, lambda line: F.try_element_at(lookup, digest(line)))
    return (
        docs.withColumn("digest", digest(body))
        .join(whole, F.col("digest") == F.col(d), "left")
        .join(bodies, body_digest(body) == F.col(b), "left")
        .withColumn("license", F.coalesce("license", by_body))
        .drop(d, b, by_body)
        .withColumn("notices", F.array_join(F.array_distinct(F.array_compact(named)), ","))
    )
