"""Operator 5: removal of repeated byte strings, by ranks of ever longer strings.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
earlier (in a smaller document, or earlier in the same one). As in prefix
doubling, the start positions are named by the string that follows them, the
strings grow from round to round, positions whose name has become unique leave,
and the rounds end once the names reach ``LENGTH`` bytes. Two changes make this
fit documents of any number, where (position, rank) pairs of all positions
would be tens of times the input in every round:

* Start positions are taken in units that a string decides alone, so equal
  strings always have corresponding units: chunks between content-defined
  boundaries; then runs of starts that share their anchor (the ``GRAM``-byte
  string with the least hash of those in the following ``LENGTH`` bytes); then
  groups of ``GROUP`` starts at a fixed distance to the anchor; then single
  starts. Few anchors are chosen, about two of ``LENGTH - GRAM`` positions.
* A unit has two names: one for the bytes that all its strings share (the
  key) and one for all bytes they cover. A unit whose key is unique holds no
  repeated string. Of units alike in both names the first one in order stays
  for them all and the starts of the others are repeated ones. What is first
  but shares its key with a different unit goes on to the next, finer round.

Names are 64-bit hashes: a polynomial modulo 2**64 and, for all bytes that a
unit covers, two polynomials of unrelated bases modulo the prime 2**31 - 1 side
by side. The first alone would take some long strings for equal whatever its
base (differences of the form D * prod(1 - BASE**e), e growing powers of two,
vanish modulo 2**64); modulo a prime they do not. Units are equal when both
names are. Counting a key combines map-side; the joins on keys are
plain shuffle joins that AQE can split, so neither a string that a third of the
documents has nor a text of one repeated byte gathers in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import bounded_batches, mix64, row_blocks, stash, text_bytes, whole
from kassa.llm.shingles import BASE, UNDO, byte_values, powers

LENGTH = 100
GRAM = 32
CHUNK_BITS = 9
GROUP = 8
PIECE = 1 << 19                     # a power of two
ADDRESS_BITS = 63                   # of a document's number and a place in it together
BROADCAST_BYTES = 64 << 20
PRIME = np.uint64((1 << 31) - 1)
PRIME_BASES = (1_318_699_271, 947_512_563)
UNIT = "k long, m long, addr long, n int, o int"


def folded(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for x < 2**62."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.minimum(x, x - PRIME)  # x - PRIME wraps round when x is the smaller


_TABLES: dict[int, np.ndarray] = {}


def prime_powers(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo the prime, at least ``n`` of them; kept between pieces."""
    table = _TABLES.get(base)
    if table is None or len(table) < n:
        table = np.ones(1, np.uint64)
        while len(table) < n:
            table = np.concatenate([table, folded(table * np.uint64(pow(base, len(table), int(PRIME))))])
        _TABLES[base] = table
    return table[:n]


class Ranges:
    """Two hashes of unlike kinds of any byte range of a piece of text."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.back = powers(UNDO, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        values = mix64(byte_values() + np.uint64(1))
        np.cumsum(values[data] * powers(BASE, n), out=self.sums[1:])
        self.prime_sums = []
        for base in PRIME_BASES:
            s = np.zeros(n + 1, np.uint64)
            small = mix64(byte_values() + np.uint64(base)) >> np.uint64(34)
            np.cumsum(folded(small[data] * prime_powers(base, n)), out=s[1:])
            self.prime_sums.append(s)

    def name(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = mix64((end - start).astype(np.uint64) + np.uint64(which))
        if not which:
            return mix64((self.sums[end] - self.sums[start]) * self.back[start] + size)
        two = [folded(folded(s[end] - s[start]) * prime_powers(pow(base, -1, int(PRIME)), len(s))[start])
               for s, base in zip(self.prime_sums, PRIME_BASES, strict=True)]
        return mix64((two[0] << np.uint64(32) | two[1]) + size)


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        v = np.minimum(v[:-k], v[k:])
        k *= 2
    return np.minimum(v[:len(v) - (width - k)], v[width - k:]) if k < width else v


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first text, place of the first byte in its text); long texts come in overlapping pieces."""
    for lo, hi in row_blocks(offsets, PIECE):
        part = data[offsets[lo]:offsets[hi]]
        if len(part) <= PIECE:
            yield part, offsets[lo:hi + 1] - offsets[lo], lo, 0
            continue
        for a in range(0, len(part) - LENGTH + 1, PIECE - LENGTH + 1):
            sub = part[a:a + PIECE]
            yield sub, np.array([0, len(sub)]), lo, a


def starts_of(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all strings of ``length`` bytes within one text, and their texts."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if len(doc) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    p = np.flatnonzero(doc[:len(doc) - length + 1] == doc[length - 1:])
    return p, doc[p]


def chunk_units(data, offsets, length, gram, base, taken):
    p, d = starts_of(offsets, length)
    if not len(p):
        return None
    r = Ranges(data)
    cut = r.name(0, p, p + min(gram, length)) >> np.uint64(64 - CHUNK_BITS) == 0
    new = cut | np.concatenate(([True], (d[1:] != d[:-1])))
    i = np.flatnonzero(new)
    n = np.diff(np.append(i, len(p)))
    lo, hi = p[i], p[i] + n - 1 + length
    return d[i], lo, n, r.name(0, lo, hi), r.name(1, lo, hi), np.zeros(len(i), np.int64)


def anchor_units(data, offsets, length, gram, base, taken):
    p, d = starts_of(offsets, length)
    if not len(p):
        return None
    r = Ranges(data)
    at = np.arange(len(data) - gram + 1)
    grams = r.name(0, at, at + gram)
    mask = np.uint64(2 * PIECE - 1)
    least = sliding_least((grams & ~mask) | at.astype(np.uint64), length - gram + 1)
    a = (least[p] & mask).astype(np.int64)
    free = ~taken(p)
    p, d, a = p[free], d[free], a[free]
    if not len(p):
        return None
    i = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1))))
    n = np.diff(np.append(i, len(p)))
    lo = p[i]
    return d[i], lo, n, grams[a[i]], r.name(1, lo, lo + n - 1 + length), a[i] - lo


def mapped(units, length: int, gram: int, bits: int):
    """mapInArrow function: (id, text, ranges) -> units, leaving out the starts in ``ranges``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            spans = batch.column(2) if batch.num_columns > 2 else None
            for part, off, first, base in pieces(data, offsets):
                got = units(part, off, length, gram, base, starts_in(spans, off, first, base))
                if got:
                    d, lo, n, k, m, o = got
                    addr = (ids[first + d].astype(np.int64) << bits) | (lo - off[d] + base)
                    yield batch_of(k, m, addr, n, o)
    return run


def batch_of(k, m, addr, n, o) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(m.view(np.int64)), pa.array(addr),
                                       pa.array(n.astype(np.int32)), pa.array(o.astype(np.int32))], ["k", "m", "addr", "n", "o"])


def flat_ranges(spans: pa.Array | None, first: int, rows: int):
    """(row, place, n, o) of the ranges of some rows."""
    if spans is None:
        return (np.zeros(0, np.int64),) * 4
    data, offsets = text_bytes(spans.slice(first, rows))
    flat = np.frombuffer(data.tobytes(), "<i4").astype(np.int64).reshape(-1, 3)
    return (np.repeat(np.arange(rows), np.diff(offsets) // 12), *flat.T)


def starts_in(spans, off, first, base):
    """Function: which of some start positions of a piece lie in its texts' ranges."""
    row, place, n, _ = flat_ranges(spans, first, len(off) - 1)
    marks = np.zeros(int(off[-1]) + 1, np.int32)
    lo = off[row] + np.clip(place - base, 0, off[row + 1] - off[row])
    hi = off[row] + np.clip(place + n - base, 0, off[row + 1] - off[row])
    np.add.at(marks, lo, 1)
    np.add.at(marks, hi, -1)
    inside = np.cumsum(marks) > 0
    return lambda p: inside[p]


def finer(groups: bool, length: int, bits: int):
    """mapInArrow function: (id, text, open units) -> groups of starts, or single starts.

    The units' bytes are cut out of the text first, so a long text costs what
    its open units cost.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = text_bytes(batch.column(1))
            row, place, n, o = flat_ranges(batch.column(2), 0, batch.num_rows)
            size = n - 1 + length
            ends = np.cumsum(size)
            for lo, hi in row_blocks(np.concatenate(([0], ends)), PIECE):
                rw, pl, nn, oo, sz = row[lo:hi], place[lo:hi], n[lo:hi], o[lo:hi], size[lo:hi]
                begin = np.concatenate(([0], np.cumsum(sz)))[:-1]
                within = np.arange(int(sz.sum())) - np.repeat(begin, sz)
                r = Ranges(data[np.repeat(offsets[rw] + pl, sz) + within])
                unit = np.repeat(np.arange(hi - lo), nn)
                step = np.arange(len(unit)) - np.repeat(np.cumsum(nn) - nn, nn)
                p = begin[unit] + step                      # start in the cut-out bytes
                dist = oo[unit] - step                      # from the start to the anchor
                if not groups:
                    addr = (ids[rw[unit]] << bits) | (pl[unit] + step)
                    yield batch_of(r.name(0, p, p + length), r.name(1, p, p + length), addr, np.ones(len(p)), dist)
                    continue
                g = dist // GROUP
                i = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]) | (g[1:] != g[:-1]))))
                count = np.diff(np.append(i, len(p)))
                core = p[i] + dist[i] - GROUP * g[i]        # what all strings of the group share
                addr = (ids[rw[unit[i]]] << bits) | (pl[unit[i]] + step[i])
                yield batch_of(r.name(0, core, core + length - GROUP + 1), r.name(1, p[i], p[i] + count - 1 + length), addr, count, dist[i])
    return run


def resolve(units: DataFrame, last: bool = False, chunks: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(repeated, open): starts found earlier elsewhere, and units that need a finer round.

    For chunks the key says nothing about uniqueness, so ``open`` is None: all
    that is not repeated goes on.
    """
    units = stash(units)  # counted and joined: names are reckoned once
    shared = units.groupBy("k").agg(F.count(F.lit(1)).alias("c"), (F.min("m") != F.max("m")).alias("mixed")).where("c > 1").select("k", "mixed")
    cand = stash(units.join(stash(shared), "k"))
    first = stash(cand.groupBy("k", "m").agg(F.min("addr").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("k", "m", "first"))
    placed = cand.join(first, ["k", "m"], "left")
    repeated = stash(placed.where("addr <> first").select("addr", "n"))
    if last or chunks:
        return repeated, None
    return repeated, stash(placed.where("mixed and (first is null or addr = first)").select("addr", "n", "o"))


def packed(merge: bool):
    """mapInArrow function: (id, list of ranges) -> (id, ranges as 32-bit triples), touching ranges made one with ``merge``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            row = np.repeat(np.arange(len(size)), size)
            place, n, o = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("place", "n", "o"))
            order = np.lexsort((place, row))
            row, place, n, o = row[order], place[order], n[order], o[order]
            if merge and len(row):
                # no start is in two ranges, so ranges touch when one ends where the next begins
                new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + n[:-1]))))
                n = np.add.reduceat(n, new)
                row, place, o = row[new], place[new], o[new]
            flat = np.stack([place, n, o], axis=1).astype("<i4")
            at = np.searchsorted(row, np.arange(len(size) + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([flat[x:y].tobytes() for x, y in zip(at, at[1:], strict=False)], pa.binary())], ["_id", "spans"])
    return run


def by_document(rows: DataFrame, bits: int) -> DataFrame:
    """``_id, spans``: the ranges (place, n, o) of each document; without ``o`` those that touch are one."""
    merge = "o" not in rows.columns
    o = F.lit(0).alias("o") if merge else F.col("o")
    place = F.col("addr").bitwiseAND((1 << bits) - 1).cast("int").alias("place")
    lists = rows.groupBy(F.shiftright("addr", bits).alias("_id")).agg(F.collect_list(F.struct(place, "n", o)).alias("spans"))
    return lists.mapInArrow(packed(merge), "_id long, spans binary")


def beside(docs: DataFrame, rows: DataFrame, how: str, bits: int) -> DataFrame:
    """Documents with their ranges. The ranges are broadcast while small, else both sides shuffle."""
    spans = stash(by_document(rows, bits))
    size = spans.agg(F.coalesce(F.sum(F.length("spans") + 64), F.lit(0))).first()[0]
    spans = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    return docs.join(spans, docs["id"] == spans["_id"], how).select("id", "text", "spans")


def repeated_starts(docs: DataFrame, bits: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``addr, n``: runs of starts of strings that also start earlier. ``docs``: id (unique, not negative), text.

    An address is the id, then ``bits`` bits for the place in the text.
    """
    chunks, _ = resolve(docs.mapInArrow(mapped(chunk_units, length, gram, bits), UNIT), chunks=True)
    anchors, left = resolve(beside(docs, chunks, "left", bits).mapInArrow(mapped(anchor_units, length, gram, bits), UNIT))
    groups, left = resolve(beside(docs, left, "inner", bits).mapInArrow(finer(True, length, bits), UNIT))
    single, _ = resolve(beside(docs, left.drop("o"), "inner", bits).mapInArrow(finer(False, length, bits), UNIT), last=True)
    return chunks.union(anchors).union(groups).union(single)


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None, int]:
    """Documents as (id, text) with usable ids, (id, doc_id) where they had to be given anew, and the bits of a place.

    The longest text decides the bits of a place; ids have the others. Ids are
    used as they are when they are distinct, not null and in range; else rows
    are numbered in the order of id and text (nulls first).
    """
    src = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    integer = dict(src.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint")
    number = F.col("doc_id").cast("long") if integer else F.lit(None).cast("long")
    found = src.agg(F.max(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("rows"), F.count(number).alias("ids"),
                    F.min(number).alias("least"), F.max(number).alias("most")).first()
    bits = max(1, int(found["size"] or 0).bit_length())
    most = 1 << (ADDRESS_BITS - bits)
    if integer and found["ids"] == found["rows"] and (not found["rows"] or found["least"] >= 0 and found["most"] < most):
        ids = src.select(F.col("doc_id").cast("long").alias("id"))
        if ids.groupBy("id").count().where("count > 1").isEmpty():
            return src.select(F.col("doc_id").cast("long").alias("id"), "text"), None, bits
    if found["rows"] > most:
        raise ValueError(f"{found['rows']} documents of up to {found['size']} bytes have more addresses than {ADDRESS_BITS} bits")
    # equal rows are ordered too, so that a row repeated very often is dealt over several ranges
    order = ["doc_id", F.xxhash64("text"), "tie"]
    ordered = stash(src.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions("doc_id", F.xxhash64("text"), "text", "tie")
                       .withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()))
    sizes = {r["part"]: (r["first"], r["n"]) for r in ordered.groupBy("part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    shift, total = {}, 0
    for part in sorted(sizes):
        shift[part] = sizes[part][0] - total
        total += sizes[part][1]
    lower = F.create_map(*[F.lit(x) for kv in shift.items() for x in kv])[F.col("part")] if shift else F.lit(0)
    given = stash(ordered.select((F.col("seq") - lower).cast("long").alias("id"), "doc_id", "text"))
    return given.select("id", "text"), given.select("id", "doc_id"), bits


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: ``doc_id, n_bytes, spans, kept``.

    ``spans`` are the maximal removed runs (start, end) in bytes of the UTF-8
    text, ``kept`` the remaining bytes (binary: a run may begin within a
    character). Null text is empty; texts shorter than ``length`` lose nothing.
    Rows that share an id are ordered by a hash of their text, equal rows one
    after the other, so the second of them repeats the first. An empty table
    gives no rows.
    """
    if not GROUP < length - gram or gram > length:
        raise ValueError("length must exceed gram by more than a group of starts")
    bounded_batches(docs.sparkSession)
    src, renamed, bits = numbered(docs, id_col, text_col)
    found = beside(src, repeated_starts(src, bits, length, gram), "left", bits)

    @F.arrow_udf("struct<spans:array<struct<start:int,end:int>>,kept:binary>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        data, offsets = text_bytes(texts)
        rows = []
        for i in range(len(texts)):
            body = data[offsets[i]:offsets[i + 1]]
            _, place, n, _ = flat_ranges(spans, i, 1)
            if not len(place):
                rows.append({"spans": [], "kept": body.tobytes()})
                continue
            marks = np.zeros(len(body) + 1, np.int64)
            np.add.at(marks, place, 1)
            np.add.at(marks, place + n - 1 + length, -1)
            gone = np.concatenate(([False], np.cumsum(marks)[:-1] > 0, [False]))
            edge = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)
            rows.append({"spans": [{"start": int(a), "end": int(b)} for a, b in edge], "kept": body[~gone[1:-1]].tobytes()})
        return pa.array(rows, pa.struct([("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())]))

    out = found.select("id", F.octet_length("text").cast("long").alias("n_bytes"), cut("text", "spans").alias("c"))
    if renamed is None:
        out = out.withColumnRenamed("id", "doc_id")
    else:
        out = out.join(renamed, "id").drop("id")
    return out.select("doc_id", "n_bytes", "c.spans", "c.kept")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    out = cut_repeats(docs, id_col, text_col, **options)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
