"""Hash expressions shared by the sampler, the k-means start and the Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hash bits kept before the modulo, as hex digits: 60 bits, so that filters of any width are used evenly.
HASH_HEX_DIGITS = 15


def priority(seed: int, key: str | Column) -> Column:
    """A random-looking but repeatable priority of a row."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")).cast("binary"))


def bit_position(tag: str | Column, i: int | Column, width: int) -> Column:
    """Bit of hash number ``i`` for ``tag`` in a filter of ``width`` bits."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    i = F.lit(i) if isinstance(i, int) else i
    digest = F.md5(F.concat(i.cast("string"), F.lit(":"), tag).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_HEX_DIGITS), 16, 10).cast("bigint") % F.lit(width)


def bit_positions(tag: str | Column, width: int, num_hash: int) -> Column:
    """The distinct bits of ``tag`` as an array."""
    return F.array_distinct(F.array(*[bit_position(tag, i, width) for i in range(num_hash)]))


def page_of(bit: str | Column) -> Column:
    """The page, from 1, of a bit in a filter kept as packed pages."""
    return F.bitmap_bucket_number((F.col(bit) if isinstance(bit, str) else bit) + 1)


def place_in_page(bit: str | Column) -> Column:
    """The place, from 0, of a bit within its page."""
    return F.bitmap_bit_position((F.col(bit) if isinstance(bit, str) else bit) + 1)
