"""Operator 9: removal of lines that many documents share.

1. Every line is reduced to a key (stripped, A-Z lower-cased) and two 64-bit
   hashes of it. Each document gives every distinct key once; a count that
   combines map-side finds the keys that reach the document threshold.
2. Those keys are split into shards by hash. Each shard becomes a minimal
   perfect hash (levels of bit arrays: a key that shares its bit goes on to
   the next level, and the rank of its bit is its slot) that indexes a compact
   array of 64-bit fingerprints and one of counts. A shard is built in one
   task; the number of shards grows with the number of keys.
3. Documents probe the arrays: slot by hash, then fingerprint. Lines do not
   join anything and text does not move.

The arrays are broadcast while they are within ``BROADCAST_BYTES`` (about five
million shared lines). Beyond it the shards stay a table, and the documents'
distinct hashes are sent to them, a bounded slice of a shard's probes at a time.

Only keys that reach the threshold are indexed: a key below it is kept whether
it is found or not. A kept line is lost only if it meets a slot whose
fingerprint equals its own by chance (2**-64 for each probe).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from kassa.llm.common import bounded_batches, fresh, mix64, stash, whole

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_KEYS = 1 << 17
BROADCAST_BYTES = 64 << 20
PROBE_SLICE = 1 << 16
# --- fixed values: the characters stripped from a line's ends ----------------
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(STRIPPED)), UPPER, LOWER)


def lines_of(text_col: str) -> Column:
    return F.split(whole(text_col), "\n", -1)


def line_hashes(text_col: str, min_chars: int = MIN_CHARS) -> Column:
    """For each line the two hashes of its key; null for keys below ``min_chars``."""
    def one(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.length(key) >= min_chars,
                      F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(9), key).alias("h2")))
    return F.transform(lines_of(text_col), one)


def shared_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, n_docs`` of the keys found in at least ``min_docs`` documents (rows)."""
    each = docs.select(F.explode(F.array_distinct(F.filter(line_hashes(text_col, min_chars), lambda h: h.isNotNull()))).alias("h"))
    return (each.groupBy(F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"))
                .agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs))


class PerfectHash:
    """Minimal perfect hash of distinct (h1, h2) pairs with fingerprint and count arrays."""

    SLACK = 2

    def __init__(self, words: list[np.ndarray], sizes: list[int], prints: np.ndarray, counts: np.ndarray):
        self.words, self.sizes, self.prints, self.counts = words, sizes, prints, counts
        self.ranks, total = [], 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.ranks.append(total + np.concatenate(([0], np.cumsum(ones)[:-1])))
            total += int(ones.sum())

    @staticmethod
    def place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        turn = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return mix64(h1 ^ mix64(h2 + turn)) % np.uint64(size)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray) -> PerfectHash:
        words, sizes, order = [], [], []
        left = np.arange(len(h1))
        while len(left):
            size = -(-cls.SLACK * len(left) // 64) * 64
            at = cls.place(h1[left], h2[left], len(words), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            fits = alone[at]
            mine = left[fits]
            order.append(mine[np.argsort(at[fits])])
            left = left[~fits]
        slots = np.concatenate(order) if order else np.zeros(0, np.int64)
        return cls(words, sizes, h2[slots], counts[slots])

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Count of each probed pair; 0 where the pair is not indexed."""
        out = np.zeros(len(h1), np.int64)
        left = np.arange(len(h1))
        for level, (w, size, rank) in enumerate(zip(self.words, self.sizes, self.ranks, strict=True)):
            if not len(left):
                break
            at = self.place(h1[left], h2[left], level, size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (w[word] >> bit) & np.uint64(1) == 1
            below = w[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            slot = rank[word[hit]] + np.bitwise_count(below)
            mine = left[hit]
            same = self.prints[slot] == h2[mine]
            out[mine[same]] = self.counts[slot[same]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.prints), *self.sizes], "<i8")
        return b"".join([head.tobytes(), *(w.tobytes() for w in self.words), self.prints.astype("<u8").tobytes(),
                         self.counts.astype("<u4").tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        levels, n = np.frombuffer(raw, "<i8", 2)
        sizes, at, words = np.frombuffer(raw, "<i8", levels, 16).tolist(), 16 + 8 * int(levels), []
        for s in sizes:
            words.append(np.frombuffer(raw, "<u8", s // 64, at))
            at += s // 8
        return cls(words, sizes, np.frombuffer(raw, "<u8", n, at), np.frombuffer(raw, "<u4", n, at + 8 * int(n)))


def shard_of(h1: np.ndarray, shards: int) -> np.ndarray:
    return (h1 >> np.uint64(32)) % np.uint64(shards)


def build_index(shared: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int, int]:
    """Table (shard, arrays) of the shared lines, the number of shards, and the arrays' bytes."""
    shared = stash(shared)
    shards = max(1, -(-shared.count() // shard_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ph = PerfectHash.build(pdf["h1"].to_numpy().view(np.uint64), pdf["h2"].to_numpy().view(np.uint64),
                               np.minimum(pdf["n_docs"].to_numpy(), 2**32 - 1))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "arrays": [ph.to_bytes()]})

    keyed = shared.withColumn("shard", F.pmod(F.shiftrightunsigned("h1", 32), F.lit(shards)))
    index = stash(keyed.groupBy("shard").applyInPandas(build, "shard long, arrays binary"))
    size = index.agg(F.coalesce(F.sum(F.length("arrays")), F.lit(0))).first()[0]
    return index, shards, int(size)


def probe_broadcast(index: DataFrame, shards: int):
    """Column function: which of an array of line hashes are indexed, by broadcast arrays."""
    held = index.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["arrays"]) for r in index.toLocalIterator()})
    opened: dict[int, PerfectHash] = {}

    @F.arrow_udf(ArrayType(BooleanType()))
    def probe(hashes: pa.Array) -> pa.Array:
        pairs = hashes.flatten()
        known = pairs.is_valid().to_numpy(zero_copy_only=False)
        h1 = pairs.field("h1").fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        h2 = pairs.field("h2").fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        found = np.zeros(len(pairs), bool)
        shard = shard_of(h1, shards)
        for s, raw in held.value.items():
            if s not in opened:
                opened[s] = PerfectHash.from_bytes(raw)
            mine = np.flatnonzero(known & (shard == s))
            found[mine] = opened[s].find(h1[mine], h2[mine]) > 0
        lengths = np.diff(hashes.offsets.to_numpy())
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(found))

    return probe


def found_by_shards(docs: DataFrame, hashes: str, row: str, index: DataFrame, shards: int) -> DataFrame:
    """``row, hit`` (positions of indexed lines) without a broadcast: probes travel to the shards.

    A shard's probes are split into slices by row, and each slice meets a copy
    of the shard's arrays, so a line that every document has is spread too.
    """
    probes = (docs.select(row, F.posexplode(hashes).alias("pos", "h")).where("h is not null")
                  .withColumn("shard", F.pmod(F.shiftrightunsigned("h.h1", 32), F.lit(shards))))
    counts = probes.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    slices = stash(counts.select("shard", F.ceil(F.col("n") / PROBE_SLICE).cast("int").alias("slices")))
    left = (probes.join(slices, "shard").withColumn("slice", F.pmod(F.xxhash64(row, "pos"), F.col("slices")))
                  .select("shard", "slice", row, "pos", "h.h1", "h.h2"))
    right = (index.join(slices, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "arrays")
                  .withColumn("slice", F.col("slice").cast("long")))

    def meet(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(l) or not len(r):
            return pd.DataFrame({row: [], "pos": []})
        n = PerfectHash.from_bytes(bytes(r["arrays"].iloc[0])).find(l["h1"].to_numpy().view(np.uint64), l["h2"].to_numpy().view(np.uint64))
        return l.loc[n > 0, [row, "pos"]]

    hits = (left.withColumn("slice", F.col("slice").cast("long")).groupBy("shard", "slice")
                .cogroup(right.groupBy("shard", "slice")).applyInPandas(meet, f"`{row}` long, pos int"))
    return hits.groupBy(row).agg(F.collect_set("pos").alias("hit"))


def drop_shared_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                      n_lines: str = "n_lines", n_dropped: str = "n_dropped",
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with the shared lines taken out of the text, plus the two line counts.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
    A-Z lower-cased. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` rows lose all their lines in every row; the others stay,
    joined by line feeds. Null and empty texts are one empty line, which stays
    (its key is too short). Repeated rows each count as a document. All other
    columns stay; an empty table stays empty.
    """
    for c in (n_lines, n_dropped):
        if c in docs.columns:
            raise ValueError(f"column {c} exists")
    bounded_batches(docs.sparkSession)
    index, shards, size = build_index(shared_lines(docs, text_col, min_docs, min_chars))
    drop = fresh(docs, "_drop")
    if size <= broadcast_bytes:
        marked = docs.withColumn(drop, probe_broadcast(index, shards)(line_hashes(text_col, min_chars)))
    else:
        row, own, hits_of = fresh(docs, "_row"), fresh(docs, "_hit_row"), fresh(docs, "_hit")
        numbered = stash(docs.withColumn(row, F.monotonically_increasing_id()))
        hashed = numbered.select(row, line_hashes(text_col, min_chars).alias("_h"))
        hits = found_by_shards(hashed, "_h", row, index, shards).select(F.col(row).alias(own), F.col("hit").alias(hits_of))
        marked = numbered.join(hits, F.col(row) == F.col(own), "left")
        marked = marked.withColumn(drop, F.transform(lines_of(text_col), lambda _, i: F.coalesce(F.array_contains(hits_of, i), F.lit(False))))
        marked = marked.drop(row, own, hits_of)
    kept = F.filter(lines_of(text_col), lambda _, i: ~F.element_at(drop, i + 1))
    # counts before the text is replaced: the lines come from the text column itself
    return (marked.withColumn(n_lines, F.size(drop).cast("long"))
                  .withColumn(n_dropped, F.size(F.filter(drop, lambda x: x)).cast("long"))
                  .withColumn(text_col, F.array_join(kept, "\n")).drop(drop))


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, kept_sha256``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = drop_shared_lines(src, "text", **options)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
