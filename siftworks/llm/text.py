"""Text expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six ASCII white space characters, and the letters that are lower-cased.
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. ASCII texts take the faster ``lower``."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def strip_white(text: Column) -> Column:
    """Without ASCII white space at both ends, in time linear in the text."""
    return F.btrim(text, F.lit(WHITE))


def words(stripped: Column) -> Column:
    """The words of a text from ``strip_white``."""
    none = F.array().cast("array<string>")
    return F.when(stripped == "", none).otherwise(F.split(stripped, WHITE_RUN))


def fingerprint(*columns: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds: a 128-bit key that joins compare as integers."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """``wanted`` as names of working columns that no column of ``columns`` has, in any case of letters."""
    taken = {c.lower() for c in columns}
    mark = "_"
    while any(f"{mark}{w}".lower() in taken for w in wanted):
        mark += "_"
    return [f"{mark}{w}" for w in wanted]
