"""Quality rules: a ledger of rule bits and measurements, and policies read from it.

Each rule is evaluated once per document. Its failure is one bit of ``failed``;
what it measured is stored beside it. A policy is a versioned mask over the
bits, so a new policy, or the effect of leaving out one rule, needs the ledger
only and never the texts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.text import WHITE_RUN, free_names, strip_white, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_text_lines", "n_dup_lines", "n_repeat_words", "n_letters")

# The rules in the order of their bits. True means that the rule fails.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_text_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "few_letters": "2 * n_letters < word_chars",
}


class Policy(NamedTuple):
    """A named, versioned choice of rules: a document is kept if none of them fails."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
WEB = Policy("web", 1, tuple(RULES))


def bit(rule: str) -> int:
    return list(RULES).index(rule)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``MEASURES``, which replace columns of the same name; all others stay.

    A NULL text has no words. ``n_repeat_words`` counts the words that lie in a
    three-word window found twice or more: the windows of a document are sorted
    and compared with their neighbours, so a long text costs n log n.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    all_words, all_windows, bare_text, lines = free_names(docs.columns, "words", "windows", "bare", "lines")

    def window(i: Column) -> Column:
        w = F.col(all_words)
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))

    def repeated(x: Column, i: Column) -> Column:
        before, after = (F.get(F.col(all_windows), j)["g"] for j in (i - 1, i + 1))
        return F.coalesce(before == x["g"], F.lit(False)) | F.coalesce(after == x["g"], F.lit(False))

    n = F.size(all_words)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window))
    starts = F.transform(F.filter(all_windows, repeated), lambda x: x["i"])
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    bare = F.regexp_replace(body, WHITE_RUN, "")
    text_lines = F.filter(F.split(body, "\n", -1), lambda line: strip_white(line) != "")
    return (
        docs.drop(*MEASURES)
        .withColumns({all_words: words(strip_white(body)), bare_text: bare, lines: text_lines})
        .withColumn(all_windows, F.array_sort(windows))
        .withColumns(
            {
                "n_words": n.cast("bigint"),
                "word_chars": F.char_length(bare_text).cast("bigint"),
                "n_symbols": F.char_length(F.regexp_replace(bare_text, r"[^#*$%&|<>]+", "")).cast("bigint"),
                "n_text_lines": F.size(lines).cast("bigint"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
                "n_repeat_words": F.when(F.col(all_windows).isNull(), 0).otherwise(F.size(covered)).cast("bigint"),
                "n_letters": F.char_length(F.regexp_replace(bare_text, r"\P{L}+", "")).cast("bigint"),
            }
        )
        .drop(all_words, bare_text, lines, all_windows)
    )


def with_failed(measured: DataFrame) -> DataFrame:
    """Add ``failed``: bit i is set if rule i fails."""
    bits = [F.when(F.expr(rule), 1 << i).otherwise(0) for i, rule in enumerate(RULES.values())]
    return measured.withColumn("failed", sum(bits[1:], bits[0]).cast("bigint"))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with all measurements and the bits of the failed rules."""
    return with_failed(measure(docs, text)).drop(text)


def passes(policy: Policy) -> Column:
    """True for the rows of a ledger that the policy keeps."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def kept_by(policy: Policy, judged: DataFrame) -> DataFrame:
    """The rows of ``judged`` that the policy keeps.

    A plain filter would be pushed below the projections of ``measure`` and their arrays
    computed again for each element; the row number keeps it above them.
    """
    (row,) = free_names(judged.columns, "row")
    numbered = judged.withColumn(row, F.monotonically_increasing_id())
    return numbered.filter(passes(policy) & (F.col(row) >= 0)).drop(row)


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """(rule, n_failed, n_alone, kept_without): what each rule of the policy does.

    ``n_alone`` documents are rejected by this rule only; ``kept_without`` documents
    remain if it is left out. The ledger is reduced to its distinct bit masks
    before the rules are looked at: at most ``2 ** len(RULES)`` rows.
    """
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("m")).agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << bit(r)).cast("bigint").alias("b")) for r in policy.rules]))
    others = F.col("m").bitwiseAND(F.bitwise_not(F.col("b")))
    hit = F.col("m").bitwiseAND(F.col("b")) != 0

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    return (
        masks.select("m", "n", rule.alias("r"))
        .select("m", "n", "r.*")
        .groupBy("rule")
        .agg(
            total(hit).alias("n_failed"),
            total(hit & (others == 0)).alias("n_alone"),
            total(others == 0).alias("kept_without"),
        )
    )
