"""Token, hashtag and length expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column | str) -> Column:
    """Blank-separated tokens; trailing empty tokens are dropped, leading and inner ones kept.

    An empty text has one empty token, a text of blanks only has none.
    """
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.rtrim(text)
    none = F.array().cast("array<string>")
    return (
        F.when(text.isNull() | ((trimmed == "") & (text != "")), none).otherwise(F.split(trimmed, " "))
    )


def hashtags(text: Column | str, clean: bool = True) -> Column:
    """Array of the tokens that begin with ``#``; ``clean`` removes line breaks and commas."""
    found = F.filter(tokens(text), lambda t: F.startswith(t, F.lit("#")))
    if clean:
        return F.transform(found, lambda t: F.translate(t, "\n,", ""))
    return found


def text_length(text: Column | str, utf16: bool = True) -> Column:
    """Length in UTF-16 units, or in code points with ``utf16=False``."""
    text = F.col(text) if isinstance(text, str) else text
    if utf16:
        return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")
    return F.length(text).cast("bigint")
