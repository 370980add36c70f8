"""Packing documents into sequences by minimum bin slack.

Documents are tokenized, ended with an end id and cut into full sequences; the remaining pieces, all shorter than a
sequence, are packed. A window starts with the longest piece left. Which other pieces fill it best is a subset-sum
question over lengths: bit n of an integer says that n ids can be made from the lengths seen so far, and adding a
length with its count is a few shifts. The highest reachable bit within the window is the least slack; going back
through the stored integers gives the count of each length. The same filling is used as long as its lengths last.

Pieces meet in blocks of bounded size drawn by a hash, so a block costs the same however large the corpus is, and a
hot source or repeated document spreads over all blocks. What does not fill a window at the end of a block stays
padded.

Defined results: null or empty text is a document of the end id alone; equal rows are separate documents; null ids are
kept; an empty table gives an empty result; a text longer than a sequence is cut at multiples of it; other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from starmart.llm.common import releasing
from starmart.llm.tokens import binary, encode_batches

CAPACITY = 1024
BLOCK_ROWS = 2000


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum is the largest up to ``capacity``."""
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        steps.append((length, reach))
        left, times = min(counts[length], capacity // length), 1
        while left > 0:  # copies in powers of two reach every count up to the limit
            times = min(times, left)
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            used[length] = n
    return used


def windows(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece."""
    piles: dict[int, list[int]] = {}
    for at, length in enumerate(lengths.tolist()):
        piles.setdefault(length, []).append(at)
    window, offset, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while piles:
        longest = max(piles)
        counts = {length: len(pile) for length, pile in piles.items()}
        counts[longest] -= 1
        used = fill({k: v for k, v in counts.items() if v}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        for _ in range(min(len(piles[length]) // k for length, k in used.items())):
            at = 0
            for length, k in used.items():
                for _ in range(k):
                    piece = piles[length].pop()
                    window[piece], offset[piece] = n, at
                    at += length
            n += 1
        for length in used:
            if not piles[length]:
                del piles[length]
    return window, offset


def cut(capacity: int):
    """Documents' ids to pieces of at most ``capacity`` ids."""
    def emit(rows: pa.Table, ids: np.ndarray, offsets: np.ndarray) -> pa.Table:
        sizes = np.diff(offsets)
        counts = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), counts)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * capacity
        length = np.minimum(sizes[row] - start, capacity)
        bounds = np.append(offsets[:-1][row] + start, offsets[-1])
        return pa.table({
            "doc_id": rows.column("doc_id").take(pa.array(row)), "start": pa.array(start), "length": pa.array(length),
            "ids": binary(ids.astype("<u4") if ids.itemsize > 2 else ids, bounds), "doc_tokens": pa.array(sizes[row]),
            "salt": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])], pa.int64()),
        })
    return emit


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, doc_id: str = "doc_id",
         text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: one row per piece.

    ``ids`` holds the piece's ids as little-endian unsigned integers of 2 bytes, or of 4 for a vocabulary above 65,536.
    """
    blocks = max(1, -(-docs.count() // block_rows))
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = inner.schema["doc_id"]
    long = lambda name: StructField(name, LongType())
    piece = StructType([key, long("start"), long("length"), StructField("ids", BinaryType()), long("doc_tokens")])
    cut_schema = StructType([*piece.fields, long("salt")])
    out_schema = StructType([*piece.fields, long("sequence_id"), long("offset")])
    arrow_cut, arrow_out = to_arrow_schema(cut_schema), to_arrow_schema(out_schema)
    emit = cut(capacity)
    pieces = inner.mapInArrow(
        encode_batches(tokenizer, "text", end_id, lambda *a: emit(*a).cast(arrow_cut)), cut_schema)
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(blocks))).drop("salt")

    def pack_block(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        rows = rows.select(piece.names).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        window, offset = windows(rows.column("length").to_numpy(), capacity)
        return (rows.append_column("sequence_id", pa.array((block << 32) + window))
                .append_column("offset", pa.array(offset)).cast(arrow_out))

    return pieces.groupBy("block").applyInArrow(pack_block, out_schema)


def ids_crc32(packed: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the crc32 of each row's ids as little-endian unsigned 32-bit integers."""
    schema = StructType([*[packed.schema[c] for c in keep], StructField("ids_crc32", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            crcs = [zlib.crc32(np.frombuffer(b, f"<u{len(b) // n}").astype("<u4")) if n else 0
                    for b, n in zip(batch.column("ids").to_pylist(), lengths)]
            yield from pa.table([*[batch.column(c) for c in keep], pa.array(crcs, pa.int64())],
                                schema.names).cast(arrow).to_batches()
    return packed.select(*keep, "ids").mapInArrow(releasing(run), schema)
