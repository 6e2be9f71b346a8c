"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where both encodings agree.

Splitting into pre-tokens (words, digits, runs of signs, special strings) runs from left to
right and starts afresh at every pre-token. So if two chunks that overlap have the
start of a pre-token at the same place, away from the ends of both, they agree from there
on: tokens before the place are counted in the first chunk, the others in the second.
Where no such place exists in an overlap, as in very long words, the document is cut again
with wider chunks and overlaps, at last into one chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.text import fingerprint, free_names
from siftworks.sources.shared import materialize

# Code points from one chunk's start to the next one's, and by which it runs into the
# next. Texts of at most one chunk are encoded whole.
CHUNK, OVERLAP = 1 << 15, 1 << 10

# Both grow by this factor where an overlap has no common place.
WIDER = 4

# Documents counted at once, pieces of them encoded at once, and how many pieces
# of which length in code points a Python worker remembers.
BATCH, PIECES, KEPT, KEPT_LENGTH = 128, 4096, 1 << 19, 64

# Fixed value: the vocabulary of the counts.
VOCABULARY = "word_bpe_49k.json"

PLACES = pa.list_(pa.int64())
CHUNKS = pa.schema(
    [
        *[pa.field(c, pa.int64()) for c in ("t0", "t1", "chunk", "total")],
        *[pa.field(c, PLACES) for c in ("left_at", "left_n", "right_at", "right_n")],
    ]
)


@lru_cache(maxsize=2)
def tokenizer(path: str | None):
    """The tokenizer of a file, and how far from a chunk's end its places count: the longest special string does not reach it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks fill the cores
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found, 1 + max((len(t.content) for t in found.get_added_tokens_decoder().values()), default=0)


class PieceCounts:
    """Counts of whole texts as sums over their pieces between spaces and line breaks.

    No token, special string or composed character spans such a place, and none looks beyond
    it. Pieces not met before are encoded many at a time, joined by spaces; the counts
    of short ones are kept, at most ``KEPT`` of them.
    """

    def __init__(self, encoder):
        self.encoder, self.known = encoder, {"": 0}

    def _encode(self, pieces: list[str]) -> list[int]:
        starts = np.cumsum([0] + [len(p) + 1 for p in pieces[:-1]])
        encoding = self.encoder.encode(" ".join(pieces), add_special_tokens=False)
        at = np.fromiter((o[0] for o in encoding.offsets), dtype=np.int64, count=len(encoding))
        return np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=len(pieces)).tolist()

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.known) > KEPT:
            self.known = {"": 0}
        lists = [t.replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*lists).difference(self.known))
        for at in range(0, len(new), PIECES):
            some = new[at : at + PIECES]
            self.known.update(zip(some, self._encode(some)))
        out = [sum(map(self.known.__getitem__, pieces)) for pieces in lists]
        for piece in new:
            if len(piece) > KEPT_LENGTH:
                del self.known[piece]
        return out


@lru_cache(maxsize=2)
def piece_counts(path: str | None) -> PieceCounts:
    return PieceCounts(tokenizer(path)[0])


def _whole(path: str | None):
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counted, out = piece_counts(path), []
        for at in range(0, len(texts), BATCH):
            out += counted([t or "" for t in texts[at : at + BATCH]])
        return pd.Series(out, dtype="int64")

    return count


def chunk_starts(n: int, chunk: int, overlap: int) -> range:
    """The starts of the chunks of a text of n code points; each but the last runs ``overlap`` into the next."""
    return range(0, max(1, n - overlap), chunk)


def _cut(chunk: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                t0, t1, copy, text = (batch.column(i)[row].as_py() for i in range(4))
                starts = chunk_starts(len(text), chunk, overlap)
                for first in range(0, len(starts), BATCH):
                    some = starts[first : first + BATCH]
                    n = len(some)
                    columns = [pa.array([x] * n, pa.int64()) for x in (t0, t1, copy)]
                    columns += [pa.array(range(first, first + n), pa.int64()), pa.array([s == starts[-1] for s in some])]
                    columns.append(pa.array([text[s : s + chunk + overlap] if s < starts[-1] else text[s:] for s in some]))
                    yield pa.RecordBatch.from_arrays(columns, ["t0", "t1", "copy", "chunk", "last", "text"])

    return cut


def places(encoding) -> tuple[list[int], list[int]]:
    """Starts of the pre-tokens of an encoding in code points, and the number of tokens before each."""
    at, before, previous = [], [], None
    for i, (word, offset) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != previous:
            at.append(offset[0])
            before.append(i)
            previous = word
    return at, before


def _encode(path: str | None, chunk: int, overlap: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, margin = tokenizer(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for row, text in enumerate(texts):
                t0, t1, number = (batch.column(c)[row].as_py() for c in ("t0", "t1", "chunk"))
                encoding = encoder.encode(text, add_special_tokens=False)
                sides = []
                at, before = places(encoding)
                for base in (0, chunk):
                    inside = [i for i, p in enumerate(at) if base + margin <= p <= base + overlap - margin]
                    sides += [[number * chunk + at[i] for i in inside], [before[i] for i in inside]]
                out.append((t0, t1, number, len(encoding) if batch.column("last")[row].as_py() else None, *sides))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(CHUNKS), CHUNKS)], schema=CHUNKS)

    return encode


def _before(places: Column, counts: Column, place: Column) -> Column:
    return F.element_at(counts, F.array_position(places, place).cast("int"))


def spliced(chunks: DataFrame) -> DataFrame:
    """(t0, t1, n): tokens of each text from its chunks; n is NULL where some overlap has no common place.

    The tokens after the last seam are the last chunk's; for every seam the first
    chunk's count up to the place is added and the second one's taken off.
    """
    keys = ["t0", "t1"]

    def side(seam: Column, kind: int, at: Column, n: Column) -> Column:
        return F.struct(seam.alias("seam"), F.lit(kind).alias("kind"), at.alias("at"), n.alias("n"))

    total, chunk = F.col("total"), F.col("chunk")
    none = F.array().cast("array<bigint>")
    left = F.when(chunk > 0, side(chunk - 1, 1, F.col("left_at"), F.col("left_n")))
    right = F.when(total.isNull(), side(chunk, 0, F.col("right_at"), F.col("right_n"))).otherwise(side(chunk, 2, none, F.array(total)))
    met = (
        # one pass over the chunks: they are encoded as they are read
        chunks.select(*keys, F.explode(F.array_compact(F.array(left, right))).alias("s"))
        .groupBy(*keys, F.col("s.seam").alias("seam"))
        # copies of a text give equal sides
        .agg(*[F.max(F.when(F.col("s.kind") == i, F.struct("s.at", "s.n"))).alias(x) for i, x in enumerate(["a", "b", "last"])])
    )
    place = F.get(F.array_intersect("a.at", "b.at"), 0)
    gain = _before(F.col("a.at"), F.col("a.n"), place) - _before(F.col("b.at"), F.col("b.n"), place)
    gains = met.select(*keys, F.coalesce(F.col("last.n")[0], gain).alias("n"))
    return gains.groupBy(*keys).agg(F.when(F.count("*") == F.count("n"), F.sum("n")).alias("n"))


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    vocabulary: str | None = None,
    limit: int = 2048,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    The tokens are those of ``tokenizers`` with the file ``vocabulary`` (a path on every
    executor) at its defaults for the whole text, without added special tokens. A NULL or
    empty text has none. Rows are counted each for itself, also repeated ones; ids are not used, and
    columns of ``docs`` named like an output column are replaced.

    Texts above ``chunk`` code points are cut; their chunks are spread over tasks, and the
    counts joined back by a 128-bit hash of the text, a stored table, so adaptive
    execution can split a text with many copies. A text whose overlaps have no common place
    is cut again, ``WIDER`` times wider, which ends when it is one chunk.
    """
    _, margin = tokenizer(vocabulary)
    if overlap < 2 * margin or chunk <= overlap:
        raise ValueError(f"an overlap holds {2 * margin} code points or more and is shorter than a chunk")
    docs = docs.drop(*[c for c in ("n_bytes", "n_tokens", "over_limit") if c != text])
    body = F.coalesce(F.col(text), F.lit(""))
    huge = F.char_length(body) > chunk
    (n,) = free_names(docs.columns, "n")
    small = docs.filter(~huge).withColumn(n, _whole(vocabulary)(body))
    a, b = free_names(docs.columns, "t0", "t1")
    large = docs.filter(huge).withColumns(dict(zip((a, b), fingerprint(body))))

    texts = docs.filter(huge).select(*[h.alias(c) for c, h in zip(("t0", "t1"), fingerprint(body))], F.monotonically_increasing_id().alias("copy"), body.alias("text"))
    counts, left = None, None
    while True:
        pending = texts if left is None else texts.join(left, ["t0", "t1"], "left_semi")
        cut = pending.select("t0", "t1", "copy", "text").mapInArrow(_cut(chunk, overlap), "t0 long, t1 long, copy long, chunk long, last boolean, text string")
        spread = cut.repartition("t0", "t1", "copy", "chunk").select("t0", "t1", "chunk", "last", "text")
        kind = "t0 long, t1 long, chunk long, total long, left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>"
        found = materialize(spliced(spread.mapInArrow(_encode(vocabulary, chunk, overlap), kind)), "token_counts")
        done = found.filter("n IS NOT NULL")
        counts = done if counts is None else counts.unionByName(done)
        left = found.filter("n IS NULL").select("t0", "t1")
        if left.isEmpty():
            break
        chunk, overlap = chunk * WIDER, overlap * WIDER
    spliced_rows = large.join(counts.toDF(a, b, n), [a, b]).drop(a, b)
    tokens = F.col(n)
    return (
        small.unionByName(spliced_rows)
        .withColumns({"n_bytes": F.octet_length(body).cast("bigint"), "n_tokens": tokens, "over_limit": tokens > limit})
        .drop(n)
    )
