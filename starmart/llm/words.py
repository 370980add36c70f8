"""Hashes of words and word shingles of whole texts, computed for many texts at once on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starmart.llm.common import mix64

SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Letters and digits, with all bytes of characters beyond ASCII; the rest is punctuation.
LETTER = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE, INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
NEXT = np.uint64(0xD6E8FEB86659FD93)
SLICE_BYTES = 1 << 19
powers: dict[int, np.ndarray] = {}


def power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text goes alone."""
    sizes = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64))
    start, base = 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield start, stop
        start, base = stop, int(sizes[stop - 1])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each starts (and the last ends); null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def words(texts: pa.Array, punctuation: bool = False, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text.

    Words lie between ASCII white space; with ``punctuation`` they also end where letters meet other signs. A long text
    is hashed in parts that end at white space, so what is held beside the hashes is bounded but for endless words.
    """
    data, at = raw(texts)
    counts = np.zeros(len(at) - 1, np.int64)
    made, start = [np.zeros(0, np.uint64)], 0
    while start < len(data):
        stop = part_end(data, start + SLICE_BYTES)
        hashes, places = words_of(data[start:stop], at[(at >= start) & (at < stop)] - start, punctuation, lower)
        doc = np.searchsorted(at, places + start, side="right") - 1
        counts += np.bincount(doc, minlength=len(counts))
        made.append(hashes)
        start = stop
    return np.concatenate(made), counts


def part_end(data: np.ndarray, least: int) -> int:
    """The first place from ``least`` on that white space starts, or the end; looked for in steps."""
    while least < len(data):
        found = np.flatnonzero(SPACE[data[least:least + 4096]])
        if len(found):
            return least + int(found[0])
        least += 4096
    return len(data)


def words_of(data: np.ndarray, at: np.ndarray, punctuation: bool, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` and where they start; texts start at ``at``."""
    kind = np.where(SPACE[data], 0, 1 + (LETTER[data] if punctuation else 0)).astype(np.int8)
    fresh = np.empty(len(data), bool)  # the byte's kind differs from the one before, or a text starts
    fresh[0], fresh[1:] = True, kind[1:] != kind[:-1]
    fresh[at] = True
    edges = np.append(np.flatnonzero(fresh), len(data))
    real = kind[edges[:-1]] > 0
    starts, ends = edges[:-1][real], edges[1:][real]
    value = BYTE[LOWER[data] if lower else data] * power(BASE, len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    hashes = (total[ends] - total[starts]) * power(INVERSE, len(data))[starts]
    return mix64(hashes ^ (ends - starts).astype(np.uint64)), starts


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and how many each text has; a shorter text is one run of all its words."""
    n = len(hashes)
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(n)  # words from here to the end of the text
    short = np.repeat(counts, counts) < size
    first = np.repeat(ends - counts, counts) == np.arange(n)
    mixed = np.zeros(n, np.uint64)
    for j in reversed(range(size)):
        ahead = np.zeros(n, np.uint64)
        if j < n:
            ahead[:n - j] = hashes[j:]
        mixed = mixed * NEXT + np.where(left > j, ahead, np.uint64(0))
    keep = (left >= size) | (short & first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix64(mixed)[keep], made
