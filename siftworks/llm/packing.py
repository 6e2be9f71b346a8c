"""Packing: documents in order into token sequences of bounded length, cut where it costs least."""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 1024
END_ID = 0

# Costs in tokens of padding: for a sequence as such, for a cut after a sentence
# and for one within a sentence. A cut after a document is free.
SEQUENCE_COST, SENTENCE_COST, TRUNCATION_COST = 4, 1, 8

# Sentence ends nearer to the last place to cut are not looked at; where none
# comes for so long, a token in between may end a sequence too.
MIN_GAP, MAX_GAP = 8, 16

# Tokens that one run of the dynamic programme covers at least.
CHUNK_TOKENS = 1 << 20

# Sequences of one task are numbered below this.
IDS_PER_TASK = 1 << 40

# Fixed value: how the byte-level vocabulary splits a text before merging, written
# without backtracking.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary file writes each byte: itself if printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a byte-level BPE file and, per id, whether the token ends a sentence.

    The file's ids are in the order of its merges, so they serve as merge ranks.
    Special tokens keep their ids: their strings in a text are these tokens, as the file's own library has it.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    ends = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=bool)
    for token, i in ranks.items():
        ends[i] = token.rstrip(b"\"')")[-1:] in (b".", b"!", b"?", b"\n") and bool(token)
    return tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special), ends


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a sequence may end, and what a cut there costs."""
    after = np.flatnonzero(ends[ids]) + 1
    cost = np.full(len(ids) + 1, TRUNCATION_COST, dtype=np.int64)
    cost[after] = SENTENCE_COST
    cost[doc_ends] = 0
    docs = np.zeros(len(ids) + 1, dtype=bool)
    docs[doc_ends] = True
    kept, last = [], 0
    for p in np.union1d(after, doc_ends).tolist():
        if not docs[p] and p - last < MIN_GAP:
            continue
        if p - last > MAX_GAP:
            kept.extend(range(last + MAX_GAP, p, MAX_GAP))
        kept.append(p)
        last = p
    places = np.array(kept, dtype=np.int64)
    return places, cost[places]


def plan(places: np.ndarray, costs: np.ndarray, limit: int = MAX_TOKENS) -> list[int]:
    """Ends of the sequences with the least padding and cut costs; the last place is always one.

    A sequence is padded to ``limit`` unless its length is a power of two. The best
    start for a padded end p minimises cost + start over the window of ``limit``
    tokens before p; a monotone queue holds the candidates, so each place enters and
    leaves once. Starts at a power of two before p are looked up beside it.
    """
    pos = np.concatenate([[0], places])
    powers = [1 << k for k in range(limit.bit_length()) if 1 << k <= limit]
    at = []
    for power in powers:
        j = np.searchsorted(pos, pos - power)
        at.append(np.where(pos[j] == pos - power, j, -1))
    rows = np.stack(at, axis=1)
    some = (rows >= 0).any(axis=1).tolist()
    position, cost = pos.tolist(), [0, *costs.tolist()]
    best, back = [0] * len(position), [0] * len(position)
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    for i in range(1, len(position)):
        p = position[i]
        while position[queue[0][1]] < p - limit:
            queue.popleft()
        value, start = queue[0]
        value += limit - p
        if some[i]:
            for j in rows[i].tolist():
                if j >= 0 and best[j] < value:
                    value, start = best[j], j
        value += cost[i] + SEQUENCE_COST
        best[i], back[i] = value, start
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i))
    ends, i = [], len(position) - 1
    while i:
        ends.append(position[i])
        i = back[i]
    return ends[::-1]


def pack_chunk(doc_ids: list, ids: np.ndarray, lengths: np.ndarray, ends: np.ndarray, first: int, limit: int) -> tuple[pa.RecordBatch, int]:
    """Pieces of one chunk of whole documents, and the number of its sequences."""
    doc_ends = np.cumsum(lengths)
    doc_starts = doc_ends - lengths
    seq_ends = np.array(plan(*cut_places(ids, doc_ends, ends), limit), dtype=np.int64)
    seq_starts = np.concatenate([[0], seq_ends[:-1]])
    starts = np.union1d(doc_starts, seq_starts)
    stops = np.append(starts[1:], len(ids))
    doc = np.searchsorted(doc_starts, starts, side="right") - 1
    seq = np.searchsorted(seq_starts, starts, side="right") - 1
    raw = memoryview(ids.astype("<u4").tobytes())
    crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist())]
    columns = [
        pa.array(doc_ids, pa.int64()).take(pa.array(doc)),
        pa.array(starts - doc_starts[doc]),
        pa.array(stops - starts),
        pa.array(crcs, pa.int64()),
        pa.array(lengths[doc]),
        pa.array(first + seq),
        pa.array(starts - seq_starts[seq]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=PIECES), len(seq_ends)


def _packer(path: str | None, limit: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path is None:
            import public_tokenizers

        encoder, ends = tokenizer(path or public_tokenizers.path("byte_bpe_50k.json"))
        first = TaskContext.get().partitionId() * IDS_PER_TASK
        doc_ids, parts, total = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = encoder.encode(text.as_py() or "", allowed_special="all")
                ids.append(END_ID)
                doc_ids.append(doc_id.as_py())
                parts.append(np.fromiter(ids, dtype=np.int32, count=len(ids)))
                total += len(ids)
                if total >= CHUNK_TOKENS:
                    out, n = pack_chunk(doc_ids, np.concatenate(parts), np.array([len(p) for p in parts]), ends, first, limit)
                    yield out
                    first += n
                    doc_ids, parts, total = [], [], 0
        if parts:
            yield pack_chunk(doc_ids, np.concatenate(parts), np.array([len(p) for p in parts]), ends, first, limit)[0]

    return packed


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, limit: int = MAX_TOKENS
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and then id 0; a NULL or empty text is id 0 alone. The
    documents of a partition are packed in the order in which they come, in chunks
    of about a million tokens: no text is moved, no sequence spans two chunks, and a
    document longer than a chunk is a chunk of its own. Within a chunk the cuts
    minimise padding plus cut costs over the places of ``cut_places``, which are thinned. Repeated documents and ids are packed as often as they occur.
    ``vocabulary`` is the path of a byte-level BPE file on every executor.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = ", ".join(f"{f.name} long" for f in PIECES)
    return rows.mapInArrow(_packer(vocabulary, limit), kind)
