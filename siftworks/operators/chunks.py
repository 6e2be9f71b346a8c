"""Itemsets of chunks of baskets, each mined and counted within one task.

A chunk is a bounded number of (basket, item) rows. Items are rows of a bitmap over the
chunk's baskets where that is small; supports are then counts of set bits of rows that were
ANDed. A chunk with many items and baskets is first narrowed to the baskets of one item at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells of a bitmap that is built at once.
BITMAP_CELLS = 1 << 26

# Candidates that are counted in a chunk by one task; more of them are shared out.
CANDIDATES_PER_TASK = 2_000_000

# Itemsets of one length that share all but their last item: (items before, last items, supports).
Found = tuple[tuple[int, ...], np.ndarray, np.ndarray]


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The values as numbers in ascending order of the values, and the values."""
    coded = column.combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = pa.concat_arrays(coded.chunks) if coded.num_chunks else pa.array([], column.type).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def _bitmap(item: np.ndarray, basket: np.ndarray, items: int, baskets: int) -> np.ndarray:
    cells = np.zeros((items, baskets), dtype=bool)
    cells[item, basket] = True
    return np.packbits(cells, axis=1)


def _ones(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def _by_bits(bits: np.ndarray, items: np.ndarray, before: tuple[int, ...], least: int, room: int) -> Iterator[Found]:
    """All larger itemsets of ``items``, whose bitmaps are already narrowed to the items before."""
    for i in range(len(items) - 1):
        met = bits[i + 1 :] & bits[i]
        n = _ones(met)
        kept = n >= least
        if kept.any():
            head = (*before, int(items[i]))
            last = items[i + 1 :][kept]
            yield head, last, n[kept]
            if room > 1 and len(last) > 1:
                yield from _by_bits(met[kept], last, head, least, room - 1)


def _rows_of(baskets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The places of all rows of some baskets, where the rows are in order of baskets."""
    sizes = starts[baskets + 1] - starts[baskets]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts[baskets] - (ends - sizes), sizes)


def _grown(
    basket: np.ndarray, item: np.ndarray, before: tuple[int, ...], least: int, room: int, cells: int
) -> Iterator[Found]:
    """All itemsets in at least ``least`` of the baskets that have up to ``room`` items."""
    n = np.bincount(item)
    items = np.flatnonzero(n >= least)
    if not len(items):
        return
    yield before, items, n[items]
    if room == 1 or len(items) == 1:
        return
    kept = n[item] >= least
    basket, item = np.unique(basket[kept], return_inverse=True)[1], item[kept]
    width = int(basket.max()) + 1
    if len(items) * width <= cells:
        yield from _by_bits(_bitmap(np.searchsorted(items, item), basket, len(items), width), items, before, least, room - 1)
        return
    order = np.argsort(basket, kind="stable")
    basket, item = basket[order], item[order]
    starts = np.searchsorted(basket, np.arange(width + 1))
    by_item = np.argsort(item, kind="stable")
    ends = np.searchsorted(item[by_item], items, side="right")
    for i, end in zip(items, ends):
        rows = _rows_of(basket[by_item[end - n[i] : end]], starts)
        rows = rows[item[rows] > i]
        yield from _grown(basket[rows], item[rows], (*before, int(i)), least, room - 1, cells)


def _named(sets: list[np.ndarray], counts: list[np.ndarray], names: pa.Array) -> pa.Table:
    """(items, n) from arrays of equally long itemsets."""
    sizes = np.concatenate([np.full(len(s), s.shape[1]) for s in sets]) if sets else np.empty(0, dtype=np.int64)
    flat = np.concatenate([s.ravel() for s in sets]) if sets else np.empty(0, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    items = pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(flat)))
    n = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
    return pa.table({"items": items, "n": pa.array(n, pa.int64())})


def chunk_itemsets(rows: DataFrame, least: int, max_k: int | None = None, cells: int = BITMAP_CELLS) -> DataFrame:
    """(chunk, items, n): the itemsets of two items or more in at least ``least`` baskets of a chunk.

    ``rows`` is (chunk, basket, item), distinct and without NULLs, partitioned by chunk.
    """
    items_type = rows.schema["item"].dataType.simpleString()

    def mined(key: tuple, table: pa.Table) -> pa.Table:
        item, names = _codes(table["item"])
        basket, _ = _codes(table["basket"])
        sets, counts = [], []
        for before, last, n in _grown(basket, item, (), least, max_k or len(names), cells):
            if before:
                head = np.broadcast_to(np.array(before), (len(last), len(before)))
                sets.append(np.column_stack([head, last]))
                counts.append(n)
        out = _named(sets, counts, names)
        return out.add_column(0, "chunk", pa.array([key[0].as_py()] * len(out), pa.int32()))

    return rows.groupBy("chunk").applyInArrow(mined, f"chunk int, items array<{items_type}>, n bigint")


class _Members:
    """The baskets of each item of a chunk: as bitmaps where they are small together, else as lists."""

    def __init__(self, basket: np.ndarray, item: np.ndarray, items: int, cells: int):
        baskets = int(basket.max()) + 1 if len(basket) else 0
        self.bits = _bitmap(item, basket, items, baskets) if items * baskets <= cells else None
        if self.bits is None:
            order = np.lexsort((basket, item))
            self.lists = np.split(basket[order], np.searchsorted(item[order], np.arange(1, items)))

    def of(self, i: int) -> np.ndarray:
        return self.lists[i] if self.bits is None else self.bits[i]

    def both(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.intersect1d(x, y, assume_unique=True) if self.bits is None else x & y

    def size(self, x: np.ndarray) -> int:
        return len(x) if self.bits is None else int(_ones(x))


def _counted(members: _Members, places: dict, sets: list[list]) -> list[int]:
    """Supports of itemsets, which in ascending order share the work of their common beginnings."""
    out = [0] * len(sets)
    held: list[tuple] = []
    for at in sorted(range(len(sets)), key=sets.__getitem__):
        same = 0
        for (i, _), j in zip(held, sets[at]):
            if i != j:
                break
            same += 1
        del held[same:]
        for i in sets[at][same:]:
            place = places.get(i)
            if place is None:
                break
            mine = members.of(place)
            held.append((i, members.both(held[-1][1], mine) if held else mine))
        else:
            out[at] = members.size(held[-1][1])
    return out


def chunk_supports(rows: DataFrame, wanted: DataFrame, n_wanted: int, cells: int = BITMAP_CELLS) -> DataFrame:
    """(items, n): how often each itemset of ``wanted`` (chunk, items) occurs in that chunk.

    ``n_wanted`` is the number of different itemsets. Where they are too many for one task, they are shared out over
    several, which all read the chunk's rows.
    """
    parts = max(1, -(-n_wanted // CANDIDATES_PER_TASK))
    items_type = rows.schema["item"].dataType.simpleString()
    left = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = wanted.withColumn("part", F.pmod(F.xxhash64("items"), F.lit(parts)).cast("int"))

    def counted(mine: pa.Table, asked: pa.Table) -> pa.Table:
        item, names = _codes(mine["item"])
        basket, _ = _codes(mine["basket"])
        places = {name: i for i, name in enumerate(names.to_pylist())}
        sets = asked["items"].to_pylist()
        n = _counted(_Members(basket, item, len(names), cells), places, sets)
        return pa.table({"items": asked["items"], "n": pa.array(n, pa.int64())})

    both = left.groupBy("chunk", "part").cogroup(right.groupBy("chunk", "part"))
    return both.applyInArrow(counted, f"items array<{items_type}>, n bigint")
