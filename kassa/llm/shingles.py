"""Word shingles of whole texts as 64-bit hashes, computed on byte arrays.

Words are maximal runs of bytes other than white space, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kassa.llm.common import mix64, row_blocks, text_bytes

WORDS = 5
BLOCK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15          # odd, so that its powers can be undone modulo 2**64
UNDO = pow(BASE, -1, 1 << 64)


def byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each range [start, end), whatever its place (polynomial modulo 2**64, mixed)."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_values()[data] * powers(BASE, n), out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * powers(UNDO, n + 1)[starts] + (ends - starts).astype(np.uint64))


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every word."""
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    inside = ~blank[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of every run of ``words`` words; a shorter text is one shingle, one without words none."""
    data = lowered(data)
    starts, ends, doc = word_ranges(data, offsets)
    if not len(starts):
        return doc, np.zeros(0, np.uint64)
    h = range_hashes(data, starts, ends)
    per = np.bincount(doc, minlength=len(offsets) - 1)
    many = per >= words
    total = np.zeros(max(len(h) - words + 1, 0), np.uint64)
    for k in range(words):
        total += mix64(h[k:k + len(total)] + np.uint64(k + 1)) * np.uint64(2 * k + 1)
    own = doc[:len(total)] == doc[words - 1:words - 1 + len(total)]
    long_doc, long_sh = doc[:len(total)][own], mix64(total[own])
    short = np.flatnonzero(~many[doc])
    if not len(short):
        return long_doc, long_sh
    place = short - np.concatenate(([0], np.cumsum(per)))[doc[short]]
    part = mix64(h[short] + np.uint64(1) + place.astype(np.uint64)) * (2 * place + 1).astype(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], doc[short][1:] != doc[short][:-1])))
    short_sh = mix64(np.add.reduceat(part, first) + per[doc[short][first]].astype(np.uint64))
    all_doc, all_sh = np.concatenate([long_doc, doc[short][first]]), np.concatenate([long_sh, short_sh])
    order = np.argsort(all_doc, kind="stable")
    return all_doc[order], all_sh[order]


def counted(doc: np.ndarray, sh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with the number of times each occurs, ordered by both."""
    if not len(doc):
        return doc, sh, np.zeros(0, np.int64)
    order = np.lexsort((sh, doc))
    doc, sh = doc[order], sh[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (sh[1:] != sh[:-1]))))
    return doc[new], sh[new], np.diff(np.append(new, len(doc)))


def shingle_blocks(arr: pa.Array, words: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (first row, end row, text within the block, shingle, count) of an Arrow string array."""
    data, offsets = text_bytes(arr)
    for lo, hi in row_blocks(offsets, BLOCK_BYTES):
        yield lo, hi, *counted(*shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words))
