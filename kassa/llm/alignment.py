"""Operator 12: cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes. Where tokens of both end at one place a
group ends; tokens A and B of one group are linked. How many documents hold a
pair of ids linked is counted over the whole corpus, and every document learns
how its links stand in these counts.

**Runs.** A task turns its documents into (pair, document) records. When its
buffer is full, the records are sorted by pair, radix buckets of the A id
first, and spilled as one run: the distinct pairs of each bucket with the
number of documents become a row of zstd blocks, and which documents they are
stays in one further row. Pairs travel, documents do not, so a pair that every
document holds costs one entry for each run.

**Counting.** All runs of a bucket meet in one task, which merges them by a
heap over their blocks. At most ``fan`` runs meet; more are merged into longer
runs first, level by level. In the merged order all pairs of one A id are
neighbours, so its highest count is known as soon as they have passed. Each run
gets back, in its own order, its pairs' counts and whether they are the
highest; no key needs to return.

**Contributions.** A run's answers meet its document lists again and are added
up for each document.

Long texts are taken in pieces, cut where no token of either kind can span.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from kassa.llm.bpe import byte_alphabet
from kassa.llm.common import share, shared, stash, whole

BUCKETS = 512                # radix of the A id
FAN = 256                    # runs that meet in one merge
RUN_RECORDS = 2_000_000      # records (pair, document) of one run
RUN_DOCS = 1 << 20
BLOCK_KEYS = 1 << 15         # pairs of one zstd block
PIECE_CHARS, PART_TOKENS = 1 << 18, 1 << 18
MOST_LINKS = 1 << 21         # links written out at once
SPACE = "▁"
# --- fixed value: the split pattern of byte-level BPE vocabularies, for engines whose \s is Unicode's white space
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# --- zstd blocks of integers ----------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers >= 0, each in the smallest type that holds it, as one zstd frame."""
    out = []
    for x in arrays:
        x = x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))
        out += [struct.pack("<cq", x.dtype.char.encode(), len(x)), x.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(frame: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(frame), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<cq", raw, at)
        x = np.frombuffer(raw, np.dtype(kind.decode()), n, at + 9)
        out.append(x.astype(np.int64))
        at += 9 + x.nbytes
    return out


def write_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs and their counts as blocks of their own."""
    out = []
    for k in range(0, len(keys), BLOCK_KEYS):
        part = keys[k:k + BLOCK_KEYS]
        frame = pack(part[:1], np.diff(part), counts[k:k + BLOCK_KEYS])
        out += [struct.pack("<q", len(frame)), frame]
    return b"".join(out)


def read_run(blob: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(blob):
        n, = struct.unpack_from("<q", blob, at)
        first, steps, counts = unpack(blob[at + 8:at + 8 + n])
        yield np.cumsum(np.concatenate([first, steps])), counts
        at += 8 + n


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def merge_runs(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge: (keys, sums) in order, a block of each run in memory.

    The heap holds the last key of the block that each run stands in. Up to the
    smallest of them everything is at hand; then that run reads its next block.
    """
    runs = [read_run(b) for b in blobs]
    held, ends = [], []

    def read(k: int) -> None:
        block = next(runs[k], None)
        if block is not None:
            held.append([k, *block])
            heapq.heappush(ends, (int(block[0][-1]), k))

    for k in range(len(runs)):
        read(k)
    while ends:
        last, k = heapq.heappop(ends)
        closed = [k]
        while ends and ends[0][0] <= last:
            closed.append(heapq.heappop(ends)[1])
        keys, counts, rest = [], [], []
        for run, x, n in held:
            cut = int(np.searchsorted(x, last, side="right"))
            keys.append(x[:cut])
            counts.append(n[:cut])
            if cut < len(x):
                rest.append([run, x[cut:], n[cut:]])
        held[:] = rest
        yield summed(np.concatenate(keys), np.concatenate(counts))
        for c in closed:
            read(c)


def highest(keys: np.ndarray, counts: np.ndarray, shift: int) -> np.ndarray:
    """Whether a pair's count is the highest of its A id (``keys >> shift``, neighbours in the order)."""
    side = keys >> shift
    at = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    most = np.maximum.reduceat(counts, at)
    return counts == np.repeat(most, np.diff(np.append(at, len(keys))))


# --- the two tokenizers ---------------------------------------------------------

class Tokenizers:
    """Both vocabularies; the encoders are made where they are first used (Python workers)."""

    def __init__(self, json_path: str, model_path: str):
        with open(json_path, encoding="utf-8") as f:
            self.json = f.read()
        with open(model_path, "rb") as f:
            self.model = f.read()
        self.ready = False

    def open(self) -> Tokenizers:
        if self.ready:
            return self
        import sentencepiece
        import tiktoken

        spec, alphabet = json.loads(self.json), byte_alphabet()
        vocab, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        bytes_a = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if t not in special}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("ids of the first vocabulary are not in the order of its merges")
        self.encoding = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks={b: i for i, b in bytes_a.items()}, special_tokens={})

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        pieces = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        bytes_b = {i: bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(SPACE, " ").encode("utf-8") for i, p in enumerate(pieces)}
        self.space = self.pieces.piece_to_id(SPACE)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) or bytes_b[self.pieces.encode("a")[0]][:1] != b" ":
            raise ValueError("pieces of the second vocabulary span the ends of words, or no space comes first")
        self.size_a, self.size_b = max(bytes_a) + 1, len(pieces)
        self.bytes_a, self.bytes_b = ([of.get(i, b"") for i in range(n)] for of, n in ((bytes_a, self.size_a), (bytes_b, self.size_b)))
        self.len_a, self.len_b = (np.array([len(b) for b in of]) for of in (self.bytes_a, self.bytes_b))
        # decimal ids with the sign that follows them in the text of the groups
        self.said = [b"%d%c" % (i, c) for i in range(max(self.size_a, self.size_b)) for c in b",|;"]
        self.bits_b = max(1, int(self.size_b - 1).bit_length())
        self.ready = True
        return self

    def encode(self, text: str) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of both, for each piece of ``" " + text``; None for texts without tokens."""
        if not text:
            return None
        out = []
        for piece in pieces_of(" " + text):
            a = self.encoding.encode_ordinary(piece)
            b = self.pieces.encode(piece[1:]) or [self.space]  # puts its own space first
            raw = piece.encode("utf-8")
            if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                return None
            out.append((np.array(a, np.int64), np.array(b, np.int64)))
        return out


_WORD_START = re.compile(r"(?<=\S) ")


def pieces_of(text: str) -> Iterator[str]:
    """Pieces of about ``PIECE_CHARS``, cut before a space after another character, where tokens of both end."""
    at = 0
    while at < len(text):
        cut = _WORD_START.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class Radix:
    """Order of the pairs: bucket of the A id, A id, B id; as numbers ``place of A << bits | B``."""

    def __init__(self, size_a: int, bits_b: int, buckets: int):
        ids = np.arange(size_a)
        order = np.lexsort((ids, ids % buckets))
        self.place = np.empty(size_a, np.int64)
        self.place[order] = ids
        self.bits = bits_b
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(ids % buckets, minlength=buckets))]).astype(np.int64) << bits_b


# --- documents to runs ----------------------------------------------------------

class Spiller:
    """Collects documents of one task and turns them into runs."""

    def __init__(self, tok: Tokenizers, buckets: int, records: int):
        self.tok, self.radix, self.most = tok, Radix(tok.size_a, tok.bits_b, buckets), records
        self.doc_bits = RUN_DOCS.bit_length() - 1
        self._clear()

    def _clear(self) -> None:
        self.ids: list = []
        self.counts: list[np.ndarray] = []
        self.hashes: list = []
        self.begun: list[bool] = []
        self.records: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0
        self.pieces: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, doc_id, text: str) -> None:
        at = len(self.ids)
        self.ids.append(doc_id)
        self.counts.append(np.zeros(len(COUNTS), np.int64))
        pieces = self.tok.encode(text)
        self.hashes.append(None if pieces is None else hashlib.sha256())
        self.begun.append(False)
        for a, b in pieces or ():
            self.pieces.append((at, a, b))
            self.waiting += len(a)
            if self.waiting >= PART_TOKENS:
                self.align()

    def full(self) -> bool:
        return self.n >= self.most or len(self.ids) >= RUN_DOCS

    def align(self) -> None:
        """Groups, links and records of the pieces that wait."""
        if not self.pieces:
            return
        tok = self.tok
        docs = np.array([d for d, _, _ in self.pieces])
        na, nb = (np.array([len(p[k]) for p in self.pieces]) for k in (1, 2))
        a, b = (np.concatenate([p[k] for p in self.pieces]) for k in (1, 2))
        self.pieces, self.waiting = [], 0
        end_a, end_b = np.cumsum(tok.len_a[a]), np.cumsum(tok.len_b[b])
        ends = np.zeros((2, int(end_a[-1]) + 1), bool)
        ends[0, end_a] = ends[1, end_b] = True
        last_a, last_b = ends[1, end_a], ends[0, end_b]       # the group ends with this token
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        many_a, many_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        from_a, from_b = (np.concatenate([[0], np.cumsum(x)]) for x in (many_a, many_b))
        doc_a = np.repeat(docs, na)
        doc_g = doc_a[last_a]
        links = many_a * many_b
        first = int(docs[0])  # documents come in order
        sums = np.zeros((int(docs[-1]) - first + 1, len(COUNTS)), np.int64)
        for k, (of, x) in enumerate(((docs, na), (docs, nb), (doc_g, 1), (doc_g, links))):
            np.add.at(sums[:, k], of - first, x)
        for k, x in enumerate(sums):
            self.counts[first + k] += x
        self._hash(docs, na + nb, a, b, last_a, last_b, from_b[of_a], from_a[of_b + 1])
        self._links(a, b, of_a, many_a, many_b, from_a, from_b, links, doc_a, doc_g)

    def _hash(self, docs, sizes, a, b, last_a, last_b, before_a, before_b) -> None:
        """The groups as text: a group's A ids, then its B ids."""
        told = np.empty(len(a) + len(b), np.int64)
        told[np.arange(len(a)) + before_a] = a * 3 + last_a
        told[np.arange(len(b)) + before_b] = b * 3 + last_b * 2
        said, at = self.tok.said.__getitem__, 0
        for d, n in zip(docs.tolist(), sizes.tolist(), strict=True):
            if self.begun[d]:
                self.hashes[d].update(b";")
            self.begun[d] = True
            self.hashes[d].update(b"".join(map(said, told[at:at + n].tolist()))[:-1])
            at += n

    def _links(self, a, b, of_a, many_a, many_b, from_a, from_b, links, doc_a, doc_g) -> None:
        """Records (pair, document) with the number of links, a bounded number of links at a time."""
        total = np.concatenate([[0], np.cumsum(links)])
        g, groups = 0, len(links)
        while g < groups:
            h = max(g + 1, int(np.searchsorted(total, total[g] + MOST_LINKS, side="right")) - 1)
            x = slice(int(from_a[g]), int(from_a[h]))
            if h == g + 1 and links[g] > MOST_LINKS:
                self._long_group(a[x], b[int(from_b[g]):int(from_b[h])], int(doc_g[g]))
            else:
                times = many_b[of_a[x]]
                ends = np.cumsum(times)
                at = np.arange(int(ends[-1])) + np.repeat(from_b[of_a[x]] - ends + times, times)
                self._keep(np.repeat(self.radix.place[a[x]], times), b[at], np.repeat(doc_a[x], times), None)
            g = h

    def _long_group(self, a, b, doc: int) -> None:
        """A group of very many links: each pair of different ids once, with its number of links."""
        ids_a, n_a = np.unique(a, return_counts=True)
        ids_b, n_b = np.unique(b, return_counts=True)
        step = max(1, MOST_LINKS // len(ids_b))
        for k in range(0, len(ids_a), step):
            some, n = ids_a[k:k + step], n_a[k:k + step]
            self._keep(np.repeat(self.radix.place[some], len(ids_b)), np.tile(ids_b, len(some)), np.full(len(some) * len(ids_b), doc),
                       np.repeat(n, len(ids_b)) * np.tile(n_b, len(some)))

    def _keep(self, place, b, doc, times) -> None:
        code = ((place << self.radix.bits | b) << self.doc_bits) | doc
        if times is None:
            code.sort()
            at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            code, times = code[at], np.diff(np.append(at, len(code)))
        else:
            code, times = summed(code, times)
        self.records.append((code, times.astype(np.int64)))
        self.n += len(code)

    def spill(self, run: int) -> Iterator[dict]:
        """The run as rows: its documents first, then a row for each bucket that has pairs."""
        self.align()
        if not self.ids:
            return
        none = np.zeros(0, np.int64)
        code, times = summed(np.concatenate([none, *(r[0] for r in self.records)]), np.concatenate([none, *(r[1] for r in self.records)]))
        pair, doc = code >> self.doc_bits, code & (RUN_DOCS - 1)
        at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else none
        keys, held = pair[at], np.diff(np.append(at, len(pair)))
        digests = ["" if h is None else h.hexdigest() for h in self.hashes]
        yield {"run": run, "bucket": -1, "keys": None, "ids": self.ids, "counts": np.array(self.counts), "digests": digests, "docs": pack(held, doc, times)}
        cuts = np.searchsorted(keys, self.radix.starts)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            x = slice(cuts[k], cuts[k + 1])
            yield {"run": run, "bucket": k, "keys": write_run(keys[x], held[x])}
        self._clear()


def run_schema(id_type) -> StructType:
    item = StructType([StructField("doc_id", id_type), *(StructField(c, LongType()) for c in COUNTS), StructField("groups_sha256", StringType())])
    return StructType([StructField("run", LongType()), StructField("bucket", IntegerType()), StructField("keys", BinaryType()),
                       StructField("items", ArrayType(item)), StructField("docs", BinaryType())])


def to_runs(docs: DataFrame, held, buckets: int, records: int) -> DataFrame:
    """``doc_id, text`` as runs: ``run, bucket, keys, items, docs``."""
    schema = run_schema(docs.schema["doc_id"].dataType)

    def spilled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spiller = Spiller(shared(held).open(), buckets, records)
        task, number = TaskContext.get().partitionId() << 24, 0
        target = None

        def rows(run: int) -> Iterator[pa.RecordBatch]:
            waiting: list[dict] = []
            for r in spiller.spill(run):
                if r["bucket"] < 0:
                    columns = [pa.array(r["ids"], target["doc_id"]), *(pa.array(r["counts"][:, k]) for k in range(len(COUNTS))), pa.array(r["digests"], pa.string())]
                    items = pa.StructArray.from_arrays(columns, fields=[pa.field("doc_id", target["doc_id"]), *(pa.field(c, pa.int64()) for c in COUNTS),
                                                                        pa.field("groups_sha256", pa.string())])
                    yield batch([run], [-1], [None], pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items), [r["docs"]])
                else:
                    waiting.append(r)
            if waiting:
                yield batch([run] * len(waiting), [r["bucket"] for r in waiting], [r["keys"] for r in waiting], None, [None] * len(waiting))

        def batch(run, bucket, keys, items, held_docs) -> pa.RecordBatch:
            item = pa.list_(pa.struct([pa.field("doc_id", target["doc_id"]), *(pa.field(c, pa.int64()) for c in COUNTS), pa.field("groups_sha256", pa.string())]))
            return pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), pa.array(bucket, pa.int32()), pa.array(keys, pa.binary()),
                                               pa.nulls(len(run), item) if items is None else items, pa.array(held_docs, pa.binary())],
                                              ["run", "bucket", "keys", "items", "docs"])

        for b in batches:
            target = target or {"doc_id": b.schema.field("doc_id").type}
            for doc_id, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                spiller.add(doc_id.as_py(), text.as_py())
                if spiller.full():
                    yield from rows(task + number)
                    number += 1
        if target is not None:
            yield from rows(task + number)

    return docs.mapInArrow(spilled, schema)


# --- counting and answering -----------------------------------------------------

_MERGED = "run long, bucket int, keys binary"
_ANSWER = "run long, bucket int, keys binary, answers binary"


def merge_groups(runs: DataFrame, into: str) -> DataFrame:
    """Longer runs: ``run`` (= ``into``), ``bucket, keys``."""
    def merged(key, table):
        parts = list(merge_runs(table.column("keys").to_pylist()))
        blob = write_run(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return pa.table({"run": pa.array([key[1].as_py()], pa.int64()), "bucket": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([blob], pa.binary())})

    return runs.withColumn("into", F.expr(into)).groupBy("bucket", "into").applyInArrow(merged, _MERGED)


def answer_top(runs: DataFrame, bits: int, with_keys: bool) -> DataFrame:
    """Merges all runs of a bucket and answers each: count * 2 + (1 if the A id's highest), in the run's order."""
    def answered(key, table):
        blobs = table.column("keys").to_pylist()
        parts = list(merge_runs(blobs))
        keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        return told(table.column("run"), key[0].as_py(), blobs, keys, counts * 2 + highest(keys, counts, bits), with_keys)

    return runs.groupBy("bucket").applyInArrow(answered, _ANSWER)


def told(runs, bucket: int, blobs: list[bytes], keys: np.ndarray, answers: np.ndarray, with_keys: bool) -> pa.Table:
    back = [pack(np.concatenate([answers[np.searchsorted(keys, k)] for k, _ in read_run(b)])) for b in blobs]
    return pa.table({"run": runs, "bucket": pa.array([bucket] * len(back), pa.int32()),
                     "keys": pa.array(blobs if with_keys else [None] * len(back), pa.binary()), "answers": pa.array(back, pa.binary())})


def answer_below(runs: DataFrame, above: DataFrame, into: str, with_keys: bool) -> DataFrame:
    """Answers for the runs that were merged into those of ``above``."""
    both = (runs.select(F.col("run"), "bucket", "keys", F.expr(into).alias("into"), F.lit(None).cast("binary").alias("answers"))
                .unionByName(above.select(F.lit(None).cast("long").alias("run"), "bucket", "keys", F.col("run").alias("into"), "answers")))

    def answered(key, table):
        rows = table.to_pylist()
        top = next(r for r in rows if r["run"] is None)
        keys = np.concatenate([k for k, _ in read_run(top["keys"])])
        own = [r for r in rows if r["run"] is not None]
        return told(pa.array([r["run"] for r in own], pa.int64()), key[0].as_py(), [r["keys"] for r in own], keys, unpack(top["answers"])[0], with_keys)

    return both.groupBy("bucket", "into").applyInArrow(answered, _ANSWER)


def answers(runs: DataFrame, bits: int, fan: int) -> DataFrame:
    """``run, bucket, answers`` for every run and bucket."""
    n = runs.select("run").distinct().count()
    levels, into = [runs], []
    while n > fan:
        n = -(-n // fan)
        # run numbers have gaps on the first level and none above
        into.append(f"pmod(xxhash64(run), {n})" if len(into) == 0 else f"run % {n}")
        levels.append(stash(merge_groups(levels[-1], into[-1])))
    out = answer_top(levels[-1], bits, len(levels) > 1)
    for k in range(len(levels) - 2, -1, -1):
        out = answer_below(levels[k], stash(out), into[k], k > 0)
    return out.select("run", "bucket", "answers")


def contributions(runs: DataFrame, replies: DataFrame) -> DataFrame:
    """Per document: its own columns with ``n_best`` and ``count_sum``."""
    homes = runs.where("bucket < 0").select("run", "bucket", "items", "docs")
    id_type = runs.schema["items"].dataType.elementType["doc_id"].dataType
    schema = StructType([StructField("doc_id", id_type), *(StructField(c, LongType()) for c in (*COUNTS, "n_best", "count_sum")), StructField("groups_sha256", StringType())])

    def added(table):
        table = table.sort_by("bucket").combine_chunks()
        items = table.column("items").chunk(0).slice(0, 1).flatten()
        held, doc, times = unpack(table.column("docs")[0].as_py())
        replies = [unpack(x)[0] for x in table.column("answers").to_pylist()[1:]]
        reply = np.repeat(np.concatenate([np.zeros(0, np.int64), *replies]), held)
        best, total = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        np.add.at(best, doc, times * (reply & 1))
        np.add.at(total, doc, times * (reply >> 1))
        return pa.table({"doc_id": items.field("doc_id"), **{c: items.field(c) for c in COUNTS}, "n_best": best, "count_sum": total,
                         "groups_sha256": items.field("groups_sha256")})

    return homes.unionByName(replies, allowMissingColumns=True).groupBy("run").applyInArrow(added, schema)


def align_tokens(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int | None = None, fan: int = FAN, run_records: int = RUN_RECORDS) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A is the byte-level vocabulary at ``json_path`` on a space and the text, B
    the sentencepiece model at ``model_path`` on the text. ``n_best`` counts
    links whose pair is in as many documents as any pair of its A id,
    ``count_sum`` adds up all links' counts. Null and empty texts, and texts
    that a vocabulary does not give back byte by byte, have no tokens: zeros
    and an empty digest. All rows stay, repeated ones count as documents of
    their own, and null ids are carried. Other columns are ignored. An empty
    table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    tok = Tokenizers(json_path, model_path)
    held = share(spark, tok)
    bits = tok.open().bits_b
    buckets = buckets or max(BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = stash(to_runs(docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole(text_col).alias("text")), held, buckets, run_records))
    pairs = runs.where("bucket >= 0").select("run", "bucket", "keys")
    return contributions(runs, answers(pairs, bits, fan))
