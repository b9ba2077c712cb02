"""Operator 10: benchmark decontamination by q-gram lemma filtering.

A benchmark item of m bytes that occurs in a document with at most k edits
shares at least ``m + 1 - Q (k + 1)`` q-grams with it, and the diagonals
(document position - item position) of these lie at most k apart. Documents
are scanned for the items' q-grams, the matches are counted in diagonal bands
of 2 (k + 1) that overlap by half, and only bands that reach the bound are
kept; so no occurrence within the edit budget is lost. A banded alignment then
decides: an item is reported where its edit distance to a part of the document
is at most k.

Source code repeats itself. A run of white space, of whatever length, counts as
one blank, so indentation neither matches indentation nor costs edits. Each
place of an item, and each position of the document, counts once in a band,
however many partners it has there (rulers). And q-grams that the items hold several times each on average are left out of an item as long as its
bound, less by as many, stays a third of what it was (the lemma holds for any
subset of the places: k edits spoil at most Q k of them).

Items of fewer than ``MIN_BYTES`` bytes have no budget: each is found where its
folded bytes stand between word borders, in the same scan.

With ``segment_words`` passages of an item are found too: every run of so many
of its words is searched like an item, with its own budget and bound, and
occurrences that overlap along the item become one region. A run's matches are
counted in the item's own bands, so the items' q-grams are looked up once.

Edits are counted in UTF-8 bytes; the case of Latin letters and the kind and
amount of white space do not count. The items are a stated
query set: they are broadcast in blocks of ``BLOCK_BYTES``, one scan of the
documents for each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import fresh, row_blocks, share, shared, stash, text_bytes, whole

Q = 8
EDIT_RATE = 0.08
MIN_BYTES = 32          # shorter items are found without edits and between word borders only
SEGMENT_WORDS = 13
BLOCK_BYTES = 4 << 20
SCAN_BYTES = 2 << 20
FILTER_BITS = 20
COMMON = 64             # places of a q-gram in a block of items, and twice as many as items, that make it common
MOST_PAIRS = 1 << 22    # matches (position, place) of a window; one that has more is cut

# scripts without blanks between words (Thai to Myanmar, Khmer, Chinese, Japanese): every place is a border
UNSPACED = ((0x0E00, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))

SPACELESS = "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in UNSPACED)
WORD = re.compile(f"[{SPACELESS}]|[^ {SPACELESS}]+")

HIT_FIELDS = ("item_id", "start", "end", "edits")
HIT = "array<struct<item_id:long,start:int,end:int,edits:int>>"


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with Latin letters (A-Z and U+00C0 to U+00DE) lower-cased and each
    white-space byte as a blank; lengths stay."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[9:14] = 32
    out = table[data]
    second = np.flatnonzero(out[:-1] == 0xC3) + 1
    second = second[(out[second] >= 0x80) & (out[second] <= 0x9E) & (out[second] != 0x97)]
    out[second] += 32
    return out


def single_blanks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which bytes of folded texts stay when runs of blanks become one blank; runs end with their text."""
    blank = data == 32
    stay = np.ones(len(data), bool)
    stay[1:] = ~(blank[1:] & blank[:-1])
    stay[starts[:-1][np.diff(starts) > 0]] = True
    return stay


def prepared(item: str) -> np.ndarray:
    data = folded(np.frombuffer(item.encode("utf-8"), np.uint8))
    return data[single_blanks(data, np.array([0, len(data)]))]


def codes_at(data: np.ndarray) -> np.ndarray:
    """The q-gram at every position as one 64-bit number."""
    n = len(data) - Q + 1
    data = np.ascontiguousarray(data)
    return np.ndarray((max(n, 0),), "<u8", data, strides=(1,)) if n > 0 else np.zeros(0, "<u8")


def slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)


def in_word(raw: bytes) -> bool:
    """Whether the one character in ``raw`` can be inside a word."""
    c = raw.decode("utf-8", "replace")[:1]
    return c.isalnum() and not any(lo <= ord(c) <= hi for lo, hi in UNSPACED)


def char_at(data: bytes, i: int) -> bytes:
    """The character that starts at byte ``i``."""
    j = i + 1
    while j < len(data) and data[j] & 0xC0 == 0x80:
        j += 1
    return data[i:j]


def char_before(data: bytes, i: int) -> bytes:
    """The character that ends before byte ``i``."""
    j = max(i - 1, 0)
    while j > 0 and data[j] & 0xC0 == 0x80:
        j -= 1
    return data[j:i]


class ShortItems:
    """Items of fewer than ``MIN_BYTES`` bytes, found by equal bytes between word borders."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.ids: dict[bytes, list[int | None]] = {}
        for i, b in items:
            self.ids.setdefault(b, []).append(i)
        # up to Q bytes at an item's start decide where it is compared: for each number of them codes, sieve, and the items' lengths by code
        lengths: dict[int, dict[int, set[int]]] = {}
        for b in self.ids:
            lengths.setdefault(min(len(b), Q), {}).setdefault(int.from_bytes(b[:Q], "little"), set()).add(len(b))
        self.heads = {}
        for n, by_code in lengths.items():
            code = np.array(sorted(by_code), np.uint64)
            sieve = np.zeros(1 << FILTER_BITS, bool)
            sieve[slot(code)] = True
            self.heads[n] = code, sieve, [sorted(by_code[c]) for c in code.tolist()]

    def find(self, part: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, list[int | None], int, int]]:
        """(text, item ids, start, end) of every occurrence, those of one item by start."""
        if not self.ids:
            return
        raw = part.tobytes()
        for a, b in windows(len(part), SCAN_BYTES * 2, MIN_BYTES):
            last = b if b == len(part) else b - MIN_BYTES      # later starts belong to the next window
            codes = codes_at(np.concatenate([part[a:b], np.zeros(Q, np.uint8)]))[:last - a]
            for n, (code, sieve, lengths) in self.heads.items():
                own = codes if n == Q else codes & np.uint64((1 << 8 * n) - 1)
                at = np.flatnonzero(sieve[slot(own)])
                which = np.minimum(np.searchsorted(code, own[at]), len(code) - 1)
                same = code[which] == own[at]
                at, which = at[same], which[same]
                doc = np.searchsorted(starts, at + a, "right") - 1
                for s, k, d in zip((at + a).tolist(), which.tolist(), doc.tolist(), strict=True):
                    lo, hi = int(starts[d]), int(starts[d + 1])
                    for e in (s + m for m in lengths[k]):
                        if e <= hi and (ids := self.ids.get(raw[s:e])) and self.apart(raw, s, e, lo, hi):
                            yield d, ids, s - lo, e - lo

    @staticmethod
    def apart(raw: bytes, s: int, e: int, lo: int, hi: int) -> bool:
        """Whether neither end of s..e lies inside a word of the text lo..hi."""
        return not (s > lo and in_word(char_at(raw, s)) and in_word(char_before(raw, s))) and \
            not (e < hi and in_word(char_before(raw, e)) and in_word(char_at(raw, e)))


def runs(item: bytes, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of ``words`` words of a folded item that has more.

    In scripts without blanks each character is a word.
    """
    text = item.decode("utf-8", "replace")
    at = [m.span() for m in WORD.finditer(text)] if words else []
    if len(at) <= words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    point = np.frombuffer(text.encode("utf-32-le"), "<u4")
    byte = np.concatenate(([0], np.cumsum(1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))))
    starts, ends = byte[np.array(at)].T
    return starts[:len(at) - words + 1], ends[words - 1:]


class ItemIndex:
    """Q-grams of a block of items: where each occurs, and each item's budget and bound."""

    def __init__(self, items: list[tuple[int | None, str]], edit_rate: float = EDIT_RATE, segment_words: int = 0):
        held = [(i, prepared(t)) for i, t in items]
        self.short = ShortItems([(i, t) for i, b in held if len(b) < MIN_BYTES and (t := b.tobytes().strip(b" "))])
        held = [(i, b) for i, b in held if len(b) >= MIN_BYTES]
        self.ids = [i for i, _ in held]
        self.texts = [b.tobytes() for _, b in held]
        m = np.array([len(b) for _, b in held], np.int64)
        # the budget never exceeds what leaves the lemma a bound of one q-gram
        self.budget = np.minimum((m * edit_rate).astype(np.int64), m // Q - 1)
        self.bound = m + 1 - Q * (self.budget + 1)
        self.length = m
        codes = [codes_at(b) for _, b in held]
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        # runs of words: their range in the item, budget and bound; those of item i are seg_first[i] to seg_first[i + 1]
        segs = [runs(t, segment_words) for t in self.texts]
        self.seg_first = np.concatenate(([0], np.cumsum([len(a) for a, _ in segs]))).astype(np.int64)
        self.seg_start, self.seg_end = (np.concatenate([x[k] for x in segs]) if segs else np.zeros(0, np.int64) for k in (0, 1))
        size = self.seg_end - self.seg_start
        self.seg_budget = np.maximum(np.minimum((size * edit_rate).astype(np.int64), size // Q - 1), 0)
        self.seg_bound = np.maximum(size + 1 - Q * (self.seg_budget + 1), 1)
        kept = self._without_common(code, item, place)
        code, item, place = code[kept], item[kept], place[kept]
        order = np.argsort(code, kind="stable")
        self.code, self.first = np.unique(code[order], return_index=True)
        self.first = np.append(self.first, len(code))
        self.item, self.place = item[order], place[order]
        self.sieve = np.zeros(1 << FILTER_BITS, bool)
        self.sieve[slot(self.code)] = True
        self.reach = int((m + self.budget).max(initial=0))
        self.least = int(self.bound.min(initial=1 << 30))
        self.seg_reach, self.seg_least = int((size + self.seg_budget).max(initial=0)), int(self.seg_bound.min(initial=1 << 30))
        # an item's bands for runs are as wide as its largest budget asks; a band needs its least bound
        some = np.flatnonzero(np.diff(self.seg_first))
        self.seg_step, self.item_least = np.ones(len(held), np.int64), np.full(len(held), 1 << 30)
        if len(some):
            self.seg_step[some] = np.maximum.reduceat(self.seg_budget, self.seg_first[some]) + 1
            self.item_least[some] = np.minimum.reduceat(self.seg_bound, self.seg_first[some])

    def _without_common(self, code: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which (q-gram, item, place) to search by: common q-grams go where the bounds of the item and of all
        its runs, which become less by the places that went, allow it."""
        kept = np.ones(len(code), bool)
        each, at, n = np.unique(code, return_inverse=True, return_counts=True)
        common = np.flatnonzero(n > max(COMMON, 2 * len(self.ids)))
        if not len(common):
            return kept
        start = np.concatenate(([0], np.cumsum(np.bincount(item, minlength=len(self.ids)))))  # an item's places follow each other
        left, seg_left = np.maximum(1, self.bound // 3), np.maximum(1, self.seg_bound // 3)
        for c in common[np.argsort(-n[common], kind="stable")]:
            of = np.flatnonzero(at == c)
            for i, own in zip(*runs_of_equal(item[of]), strict=True):
                go = of[own]
                bound = self.bound[i] - len(go)
                seg = slice(self.seg_first[i], self.seg_first[i + 1])
                lost = np.searchsorted(place[go], self.seg_end[seg] - Q, "right") - np.searchsorted(place[go], self.seg_start[seg])
                if bound >= left[i] and (self.seg_bound[seg] - lost >= seg_left[seg]).all():
                    kept[go] = False
                    self.bound[i] = bound
                    self.seg_bound[seg] -= lost
        return kept

    def matches(self, data: np.ndarray, doc: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(position, item, place in item) of shared q-grams that can be part of an occurrence; None if more than ``most``."""
        codes = codes_at(data)
        at = np.flatnonzero(self.sieve[slot(codes)])
        if not len(at) or not len(self.code):
            return (np.zeros(0, np.int64),) * 3
        which = np.minimum(np.searchsorted(self.code, codes[at]), len(self.code) - 1)
        same = (self.code[which] == codes[at]) & (doc[at] == doc[at + Q - 1])
        at, which = at[same], which[same]
        live = self.dense(at, self.reach, self.least) | self.dense(at, self.seg_reach, self.seg_least)
        at, which = at[live], which[live]
        per = self.first[which + 1] - self.first[which]
        if most is not None and per.sum() > most:
            return None
        entry = np.repeat(self.first[which], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        return np.repeat(at, per), self.item[entry], self.place[entry]

    @staticmethod
    def dense(at: np.ndarray, reach: int, least: int) -> np.ndarray:
        """Matching positions that can be part of an occurrence: one has ``least`` of them within ``reach`` bytes on one side or the other."""
        right = np.searchsorted(at, at + reach, "right") - np.arange(len(at))
        return at <= np.maximum.accumulate(np.where(right >= least, at + reach, -1))

    def run_bands(self, at: np.ndarray, item: np.ndarray, place: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(document, item, first diagonal, runs) of the diagonal bands in which runs of the item reach their bound."""
        has = self.item_least[item] < 1 << 30
        at, item, place = at[has], item[has], place[has]
        if not len(at):
            return
        band = (at - place) // self.seg_step[item]
        low = int(band.min()) - 1
        wide = int(band.max()) - low + 1
        key = (doc[at] * len(self.ids) + item) * wide + (band - low)
        key, place = np.concatenate([key, key - 1]), np.concatenate([place, place])
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        new = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
        many = np.flatnonzero(np.diff(new) >= self.item_least[key[new[:-1]] // wide % len(self.ids)])
        for x, y in zip(new[many].tolist(), new[many + 1].tolist(), strict=True):
            di, b = divmod(int(key[x]), wide)
            d, i = divmod(di, len(self.ids))
            of = np.arange(self.seg_first[i], self.seg_first[i + 1])
            own = np.unique(place[x:y])
            count = np.searchsorted(own, self.seg_end[of] - Q, "right") - np.searchsorted(own, self.seg_start[of])
            if len(full := of[count >= self.seg_bound[of]]):
                yield d, i, (b + low) * int(self.seg_step[i]), full

    def bands(self, at: np.ndarray, item: np.ndarray, place: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, first diagonal) of the diagonal bands that reach the item's bound."""
        step = self.budget[item] + 1
        band = (at - place) // step
        if not len(at):
            return (np.zeros(0, np.int64),) * 3
        low = int(band.min()) - 1
        wide = int(band.max()) - low + 1
        # document, item and band in one number: at most 2**23 * 2**17 * 2**23 for a scanned piece
        key = (doc[at] * len(self.ids) + item) * wide + (band - low)
        key, at, place = np.concatenate([key, key - 1]), np.concatenate([at, at]), np.concatenate([place, place])
        order = np.argsort(key, kind="stable")
        key, at, place = key[order], at[order], place[order]

        def counted(full: np.ndarray | None, value: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            """Bands, and how many matches, or different values, each has."""
            k = key if full is None else key[full]
            if value is not None:
                v = value[full]
                o = np.lexsort((v, k))
                k, v = k[o], v[o]
                k = k[np.concatenate(([True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])))] if len(k) else k
            new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
            return k[new], np.diff(np.append(new, len(k)))

        bands, count = counted(None, None)
        for value in (place, at):  # each place, and each position, is a match once
            bands = bands[count >= self.bound[bands // wide % len(self.ids)]]
            bands, count = counted(np.isin(key, bands), value)
        di, b = np.divmod(bands, wide)
        d, i = np.divmod(di, len(self.ids))
        full = count >= self.bound[i]
        return d[full], i[full], (b[full] + low) * (self.budget[i[full]] + 1)


def runs_of_equal(x: np.ndarray) -> tuple[list[int], list[slice]]:
    """The values of a sorted array and where each stands."""
    new = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return x[new].tolist(), [slice(a, b) for a, b in zip(new.tolist(), [*new[1:].tolist(), len(x)], strict=True)]


def align(pattern: np.ndarray, text: np.ndarray, width: int, free: bool) -> tuple[int, int]:
    """Least edits of the pattern against a part of ``text``, and where that part ends.

    Cell c of a row stands for text position row + c; only ``width`` cells are
    kept. With ``free`` the part may start anywhere, else at the beginning.
    """
    far = 1 << 20
    cells = np.arange(width + 1)
    padded = np.full(len(pattern) + width + 1, 256, np.int16)
    padded[:min(len(text), len(padded))] = text[:len(padded)]
    row = np.where(cells <= len(text), 0 if free else cells, far)
    for i, p in enumerate(pattern):
        go = row + (padded[i:i + width + 1] != p)
        go[:-1] = np.minimum(go[:-1], row[1:] + 1)
        row = np.minimum.accumulate(go - cells) + cells
        row[cells + i + 1 > len(text)] = far
    best = int(row.argmin())
    return int(row[best]), best + len(pattern)


def likely(asked: list[tuple[bytes, bytes, int, int, int]], together: int = 256) -> Iterator[int]:
    """Which of the questions to ``occurrence`` have an answer; ``align`` for many of them at once."""
    order = sorted(range(len(asked)), key=lambda n: len(asked[n][0]))
    for x in range(0, len(order), together):
        some = order[x:x + together]
        width = max(hi - lo + 2 * k + 1 for _, _, lo, hi, k in (asked[n] for n in some))
        m = np.array([len(asked[n][0]) for n in some])
        size = np.array([len(asked[n][1]) for n in some])[:, None]
        pattern = np.full((len(some), m.max()), -1, np.int16)
        padded = np.full((len(some), max(m.max() + width + 1, size.max())), 256, np.int16)
        for r, n in enumerate(some):
            pattern[r, :m[r]] = np.frombuffer(asked[n][0], np.uint8)
            padded[r, :size[r, 0]] = np.frombuffer(asked[n][1], np.uint8)
        cells, far = np.arange(width + 1, dtype=np.int32), np.int32(1 << 20)
        row = np.where(cells <= size, np.int32(0), far)
        for i in range(m.max()):
            go = row + (padded[:, i:i + width + 1] != pattern[:, i:i + 1])
            go[:, :-1] = np.minimum(go[:, :-1], row[:, 1:] + 1)
            row = np.minimum.accumulate(go - cells, axis=1) + cells
            row[cells + (i + 1) > size] = far
            for r in np.flatnonzero(m == i + 1):
                if row[r].min() <= asked[some[r]][4]:
                    yield some[r]


def occurrence(pattern: bytes, text: bytes, lo: int, hi: int, budget: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the pattern where its first byte lies about lo..hi of the text, or None."""
    a = max(0, lo - budget)
    b = min(len(text), hi + len(pattern) + budget)
    part = text[a:b]
    exact = part.find(pattern)
    if exact >= 0:
        return a + exact, a + exact + len(pattern), 0
    p, t = np.frombuffer(pattern, np.uint8), np.frombuffer(part, np.uint8)
    edits, end = align(p, t, hi - lo + 2 * budget + 1, True)
    if edits > budget:
        return None
    back, length = align(p[::-1], t[:end][::-1], 2 * budget + 1, False) if budget else (edits, len(pattern))
    return (a + end - length, a + end, edits) if back == edits else (a + max(0, end - len(pattern)), a + end, edits)


def scan(index: ItemIndex, arr: pa.Array) -> Iterator[list[tuple[int | None, int, int, int]]]:
    """For each text the occurrences (item, start, end, edits), byte offsets in UTF-8."""
    data, offsets = text_bytes(arr)
    for lo, hi in row_blocks(offsets, SCAN_BYTES):
        part = folded(data[offsets[lo]:offsets[hi]])
        whole_starts = offsets[lo:hi + 1] - offsets[lo]
        source = np.flatnonzero(single_blanks(part, whole_starts))
        part, starts = part[source], np.searchsorted(source, whole_starts)
        found: list[list] = [[] for _ in range(hi - lo)]
        pieces: list[set] = [set() for _ in range(hi - lo)]
        overlap = index.reach * 4 + 64
        todo = list(windows(len(part), SCAN_BYTES * 2, overlap))[::-1]
        while todo:
            a, b = todo.pop()
            doc = np.repeat(np.arange(hi - lo), np.diff(np.clip(starts, a, b)))
            found_here = index.matches(part[a:b], doc, MOST_PAIRS if b - a > 4 * overlap else None)
            if found_here is None:  # too many matches to hold: the halves share what the windows share
                todo += [(a + x, a + y) for x, y in windows(b - a, (b - a + overlap) // 2 + 1, overlap)][::-1]
                continue
            at, item, place = found_here

            def around(d: int, a=a, b=b) -> tuple[bytes, int]:
                """The text as far as the window has it, and where that part starts in the text."""
                p = max(a, int(starts[d]))
                return part[p:min(b, int(starts[d + 1]))].tobytes(), p - int(starts[d])

            for d, i, diag in zip(*index.bands(at, item, place, doc), strict=True):
                text, base = around(d)
                first = int(a + diag - starts[d] - base)
                hit = occurrence(index.texts[i], text, first, first + 2 * int(index.budget[i]) + 2, int(index.budget[i]))
                if hit:
                    found[d].append((int(i), base + hit[0], base + hit[1], hit[2]))
            asked, told = [], []
            for d, i, diag, of in index.run_bands(at, item, place, doc):
                text, base = around(d)
                step, held = int(index.seg_step[i]), [h for h in found[d] if h[0] == i]
                for j in of.tolist():
                    s, e, k = int(index.seg_start[j]), int(index.seg_end[j]), int(index.seg_budget[j])
                    first = int(a + diag - starts[d] - base) + s
                    if any(h[1] <= base + first + 2 * step and base + first + e - s <= h[2] + 2 * step for h in held):
                        continue    # part of an occurrence of the whole item
                    c = max(0, first - k)
                    asked.append((index.texts[i][s:e], text[c:max(c, first + 2 * step + e - s + k)], first - c, first - c + 2 * step, k))
                    told.append((d, i, base + c, s, e))
            for at in likely(asked):
                d, i, base, s, e = told[at]
                hit = occurrence(*asked[at])
                if hit:
                    pieces[d].add((i, base + hit[0], base + hit[1], hit[2], s, e))
        brief: list[list] = [[] for _ in range(hi - lo)]
        ends: dict[tuple, int] = {}
        for d, ids, s, e in index.short.find(part, starts):
            for i in ids:
                if ends.get((d, i), 0) <= s:  # of overlapping occurrences of one item the first
                    ends[d, i] = e
                    brief[d].append((i, s, e, 0))
        for d, (hits, runs_of, more) in enumerate(zip(found, pieces, brief, strict=True)):
            hits = apart(hits)
            if runs_of:
                hits = passages(index, runs_of, hits, part[starts[d]:starts[d + 1]].tobytes()) + hits
            hits = [(index.ids[i], s, e, k) for i, s, e, k in sorted(hits, key=lambda h: (h[1], h[0]))] + more
            # back to places in the text as it stands
            yield [(i, int(source[starts[d] + s] - whole_starts[d]), int(source[starts[d] + e - 1] + 1 - whole_starts[d]), k) for i, s, e, k in hits]


def windows(n: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Pieces of 0..n of at most ``size`` (or twice the overlap), neighbours sharing ``overlap``."""
    size = max(size, 2 * overlap)
    a = 0
    while True:
        b = min(n, a + size)
        yield a, b
        if b == n:
            return
        a = b - overlap


def apart(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping occurrences of one item the one with the fewest edits."""
    out: list[tuple[int, int, int, int]] = []
    for h in sorted(set(hits), key=lambda h: (h[3], h[1], h[2], h[0])):
        if not any(o[0] == h[0] and o[1] < h[2] and h[1] < o[2] for o in out):
            out.append(h)
    return sorted(out, key=lambda h: (h[1], h[0]))


def passages(index: ItemIndex, pieces: set, wholes: list[tuple[int, int, int, int]], text: bytes) -> list[tuple[int, int, int, int]]:
    """Regions made of runs that overlap along the text and the item; none that overlaps an occurrence of the whole item.

    A region's edits are those of the part of the item that it quotes.
    """
    out: list[tuple[int, int, int, int]] = []
    for i in sorted({x[0] for x in pieces}):
        taken = [h for h in wholes if h[0] == i]
        own = sorted(x for x in pieces if x[0] == i and not any(h[1] < x[2] and x[1] < h[2] for h in taken))
        chains: list[list] = []
        for x in own:
            last = chains[-1][-1] if chains else None
            if last and x[1] < last[2] and abs(x[1] - x[4] - last[1] + last[4]) <= 2 * index.seg_step[i]:
                chains[-1].append(x)
            else:
                chains.append([x])
        for chain in chains:
            s, e = min(x[4] for x in chain), max(x[5] for x in chain)
            pattern, budget = index.texts[i][s:e], min(sum(x[3] for x in chain), (e - s) // 4)
            hit = occurrence(pattern, text, chain[0][1], chain[0][1], budget)
            out += [(i, *hit)] if hit else apart([x[:4] for x in chain])
    return apart(out)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of at most ``block_bytes`` (one item at least), one block on the driver at a time.

    An item without an id is left to an item with one that has the same text.
    """
    block, size = [], 0
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), whole(text_col).alias("t")).distinct()
    named = items.where("i is not null")
    items = named.union(items.where("i is null").join(named.select("t"), "t", "left_anti").select("i", "t"))
    for r in items.orderBy("i", "t").toLocalIterator():
        n = len(r["t"].encode("utf-8"))
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += n
    yield block


def finder(held: Broadcast):
    @F.arrow_udf(HIT)
    def find(texts: pa.Array) -> pa.Array:
        rows = [[dict(zip(HIT_FIELDS, h, strict=True)) for h in hits] for hits in scan(shared(held), texts)]
        return pa.array(rows, pa.list_(pa.struct([(f, pa.int64() if f == "item_id" else pa.int32()) for f in HIT_FIELDS])))

    return find


def mark_occurrences(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", hits_col: str = "hits", item_col: str = "item_id",
                     item_text: str = "text", edit_rate: float = EDIT_RATE, block_bytes: int = BLOCK_BYTES,
                     segment_words: int = 0) -> DataFrame:
    """``docs`` plus an array of the benchmark items found in each whole text.

    Elements are struct(item_id, start, end, edits) with byte offsets in the
    UTF-8 text. With ``segment_words`` regions that quote a part of an item are
    found as well: one for overlapping runs of so many words, each within the
    edit rate; their edits are those of the part quoted. Null and empty texts have none. Items of fewer than 32 bytes,
    without white space at their ends, are found without edits and between
    word borders. Items with a null id are found as well; where an item with
    an id has the same text, only that one is reported. Repeated items are
    found once. Rows, repeated ones too, and other columns stay.
    """
    if hits_col in docs.columns:
        raise ValueError(f"column {hits_col} exists")
    spark, parts, out = docs.sparkSession, [], docs
    for block in item_blocks(benchmark, item_col, item_text, block_bytes):
        held = share(spark, ItemIndex(block, edit_rate, segment_words))

        parts.append(fresh(out, f"_hits{len(parts)}"))
        out = out.withColumn(parts[-1], finder(held)(F.col(text_col).cast("string")))
        if len(parts) % 8 == 0:  # so many scans in one stage would hold all their blocks at once
            out = stash(out)
    return out.withColumn(hits_col, F.flatten(F.array(*parts))).drop(*parts)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per occurrence: ``doc_id, item_id, start, end, edits, passage``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hit = mark_occurrences(src, benchmark, "text", "hits", **options).select("doc_id", F.encode("text", "UTF-8").alias("raw"), F.explode("hits").alias("h"))
    passage = F.decode(F.expr("substring(raw, h.start + 1, h.end - h.start)"), "UTF-8")
    return hit.select("doc_id", "h.item_id", "h.start", "h.end", "h.edits", passage.alias("passage"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents in which no benchmark item occurs, with their own columns."""
    c = fresh(docs, "_hits")
    return mark_occurrences(docs, benchmark, text_col, c, **options).where(F.size(c) == 0).drop(c)
