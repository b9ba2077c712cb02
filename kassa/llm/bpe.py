"""Operator 3: byte-level BPE by a tokenization automaton.

**Compilation.** Start from one state with an arc to itself for every byte:
all byte strings, split into single bytes. Each merge ``u v -> w`` is a gadget
put into the automaton in merge order: after ``u`` the arc ``v`` must vanish
(the pair would have been merged) and from every state with an arc ``u`` an
arc ``w`` leads to where ``u v`` led. All arcs of one label end in one state,
so a gadget adds exactly one state: a copy of the state after ``u`` without
its ``v`` arc. The result is deterministic, and the label sequences it accepts
are exactly the tokenizations that BPE makes.

A copied state differs from its origin by one arc, so a state is stored as
(origin, removed arc, birth) and an arc younger than the state exists there
exactly when the arc of its left part does. The transition table is filled
from this on demand; the whole of it would have 2.5e9 cells.

**Encoding.** Words are cut by the tokenizer's split pattern. For every prefix
of a word there is exactly one accepted path, so one pass over the bytes,
moving through the vocabulary's byte table and the transition table, finds the
path (longest label first; a step back where the table has no arc). Distinct words are encoded once per Python worker (bounded cache).

**Decoding** emits the arcs' labels: each id's bytes.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from kassa.llm.common import fresh, share, shared, whole

# --- fixed value: the split pattern of byte-level BPE vocabularies ------------
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# the same for ASCII texts, which the standard library's engine splits faster
SPLIT_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
CACHE_WORDS, CACHE_CELLS = 75_000, 250_000


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """The compiled automaton: states, byte table of the vocabulary, labels."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        self.labels = dict(labels)
        self.special = special
        size = max(labels, default=0) + 1
        self.left = [-1] * size       # left part of a merged label
        self.made = [-1] * size       # merge that made the label; -1 for bytes
        self.dead = [False] * size    # labels that no tokenization uses
        self.after = [0] * size       # state after an arc with this label
        self.origin, self.removed, self.birth = [-1], [-1], [-1]
        basic = {t for t, b in labels.items() if len(b) == 1}
        for t in labels:
            self.dead[t] = t not in basic
        for i, (u, v, w) in enumerate(merges):
            self._gadget(i, u, v, w)
        self.step, self.token = [{}], [-1]
        for t, b in labels.items():
            if self.dead[t]:
                continue
            node = 0
            for x in b:
                nxt = self.step[node].get(x)
                if nxt is None:
                    nxt = self.step[node][x] = len(self.step)
                    self.step.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = t
        self.known = {b: t for t, b in labels.items() if not self.dead[t]}
        self.length = [len(labels.get(t, b"")) for t in range(size)]
        self.shorter = [-2] * size    # longest other label that begins a label
        for b, t in self.known.items():
            self.shorter[t] = next((self.known[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.known), -2)
        self._number_states()
        self.table: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _gadget(self, i: int, u: int, v: int, w: int) -> None:
        p, r = self.after[u], self.after[v]
        if self.dead[u] or self.dead[v] or not self.has_arc(p, v):
            return
        self.origin.append(p)
        self.removed.append(v)
        self.birth.append(i)
        self.left[w], self.made[w], self.dead[w], self.after[w] = u, i, False, r
        self.after[u] = len(self.origin) - 1

    def has_arc(self, state: int, label: int) -> bool:
        """Whether the state has an arc with this label, by the gadgets that made both."""
        if self.dead[label]:
            return False
        while True:
            if self.made[label] >= 0 and self.made[label] >= self.birth[state]:
                label = self.left[label]
            elif state == 0:
                return True
            elif label == self.removed[state]:
                return False
            else:
                state = self.origin[state]

    def _number_states(self) -> None:
        """Number the states so that a state's copies, and theirs, have the numbers after its own.

        A label vanishes at most once on the way to a state, so the ranges of
        the states that removed it are disjoint and one search finds the range
        a state may lie in.
        """
        copies: list[list[int]] = [[] for _ in self.origin]
        for state in range(1, len(self.origin)):
            copies[self.origin[state]].append(state)
        self.number, last, todo = [0] * len(self.origin), [0] * len(self.origin), [(0, False)]
        count = 0
        while todo:
            state, done = todo.pop()
            if done:
                last[state] = count - 1
                continue
            self.number[state] = count
            count += 1
            todo.append((state, True))
            todo += [(c, False) for c in copies[state]]
        gone: dict[int, list[tuple[int, int, int]]] = {}
        for state in range(1, len(self.origin)):
            gone.setdefault(self.removed[state], []).append((self.number[state], last[state], self.birth[state]))
        self.gone = {label: tuple(zip(*sorted(ranges), strict=True)) for label, ranges in gone.items()}

    def fast_has_arc(self, state: int, label: int) -> bool:
        """The same as ``has_arc`` by searching: no state on the way here removed the label, nor,
        before the label was made, its left part, and so on."""
        if self.dead[label]:
            return False
        at, before = self.number[state], len(self.made)
        while label >= 0:
            ranges = self.gone.get(label)
            if ranges:
                k = bisect_right(ranges[0], at) - 1
                if k >= 0 and at <= ranges[1][k] and ranges[2][k] <= before:
                    return False
            before = self.made[label]
            label = self.left[label]
        return True

    def encode_bytes(self, word: bytes) -> tuple[int, ...]:
        """The labels of the one accepted path, by search from the longest label down.

        Every prefix has one path only, so a place that led nowhere is never tried again.
        """
        whole = self.known.get(word)
        if whole is not None:
            return (whole,)
        n = len(word)
        step, token, table, after, size, shorter = self.step, self.token, self.table, self.after, len(self.left), self.shorter
        length = self.length
        path: list[int] = []
        tried = bytearray(n + 1)
        at, state, t = 0, 0, -1
        while at < n:
            if t == -1:  # longest label from here
                node = 0
                for j in range(at, n):
                    node = step[node].get(word[j], -1)
                    if node < 0:
                        break
                    if token[node] >= 0:
                        t = token[node]
            while t >= 0:
                end = at + length[t]
                if not tried[end]:
                    cell = state * size + t
                    ok = table.get(cell)
                    if ok is None:
                        ok = table[cell] = self.fast_has_arc(state, t)
                    if ok:
                        break
                t = shorter[t]
            if t >= 0:
                path.append(t)
                at, state, t = end, after[t], -1
            else:  # back to the label before, and on to a shorter one
                tried[at] = 1
                last = path.pop()
                at -= length[last]
                state = after[path[-1]] if path else 0
                t = shorter[last]
                if t < 0:
                    t = -2
        return tuple(path)

    def encode(self, text: str, split) -> bytes:
        """Ids of a whole text as 32-bit numbers; the vocabulary's added tokens are cut out first."""
        words, older, out = self.words, self.older, []
        for piece in self._pieces(text):
            if isinstance(piece, int):
                out.append(array("i", (piece,)).tobytes())
                continue
            found = split(piece)
            got = list(map(words.get, found))
            if None in got:
                for k, x in enumerate(got):
                    if x is None:
                        w = found[k]
                        x = words.get(w)
                        if x is None:
                            x = words[w] = older.get(w) or array("i", self.encode_bytes(w.encode("utf-8"))).tobytes()
                        got[k] = x
            out.append(b"".join(got))
        return b"".join(out)

    def _pieces(self, text: str) -> list:
        pieces: list = [text]
        for content, i in self.special.items():
            cut: list = []
            for p in pieces:
                if isinstance(p, int) or content not in p:
                    cut.append(p)
                    continue
                for k, part in enumerate(p.split(content)):
                    cut += [i, part] if k else [part]
            pieces = cut
        return pieces

    def decode(self, ids) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")

    def trim(self) -> None:
        """Keeps the caches bounded: words not met since the last time are forgotten."""
        if len(self.words) > CACHE_WORDS:
            self.words, self.older = {}, self.words
        if len(self.table) > CACHE_CELLS:
            self.table.clear()


def load_automaton(path: str) -> Automaton:
    """Compile the automaton of a tokenizers JSON file (byte-level BPE)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("not a plain byte-level BPE file")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("added tokens with stripping or word limits are not supported")
    vocab, alphabet = model["vocab"], byte_alphabet()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    labels = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if t not in special}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    auto = Automaton(labels, merges, special)
    auto.labels |= {i: c.encode("utf-8") for c, i in special.items()}
    return auto


def splitter():
    """Function text -> words of the split pattern."""
    ascii_words, words = re.compile(SPLIT_ASCII).findall, regex.compile(SPLIT).findall
    return lambda text: ascii_words(text) if text.isascii() else words(text)


class Codec:
    """Spark columns that encode and decode with one compiled automaton.

    The automaton is broadcast: its size is that of the vocabulary, whatever
    the corpus. Null text is the empty text; null ids are no ids.
    """

    def __init__(self, spark: SparkSession, path: str):
        held = share(spark, load_automaton(path))

        def encoded(texts: pa.Array) -> pa.Array:
            auto, split = shared(held), splitter()
            out, at = [], [0]
            for t in texts:
                ids = auto.encode(t.as_py() or "", split)
                auto.trim()
                out.append(ids)
                at.append(at[-1] + len(ids) // 4)
            flat = pa.Array.from_buffers(pa.int32(), at[-1], [None, pa.py_buffer(b"".join(out))])
            return pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat)

        def decoded(lists: pa.Array) -> pa.Array:
            auto = shared(held)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = lengths.cumsum().tolist()
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            return pa.array([auto.decode(flat[b - n:b].tolist()) for b, n in zip(ends, lengths.tolist(), strict=True)], pa.string())

        @F.arrow_udf(ArrayType(IntegerType(), False))
        def encode(texts: pa.Array) -> pa.Array:
            return encoded(texts)

        @F.arrow_udf(StringType())
        def decode(lists: pa.Array) -> pa.Array:
            return decoded(lists)

        @F.arrow_udf(StructType([StructField("ids", ArrayType(IntegerType(), False)), StructField("text", StringType())]))
        def round_trip(texts: pa.Array) -> pa.Array:
            ids = encoded(texts)
            return pa.StructArray.from_arrays([ids, decoded(ids)], ["ids", "text"])

        self._encode, self._decode, self._round_trip = encode, decode, round_trip

    def ids(self, text: str) -> Column:
        return self._encode(whole(text))

    def text(self, ids: str) -> Column:
        return self._decode(F.col(ids))

    def round_trip(self, text: str) -> Column:
        """struct(ids, text): a text's ids and what they decode to, in one worker that holds one automaton."""
        return self._round_trip(whole(text))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` plus the ids of each whole text (array of int).

    Null and empty texts have no ids. All rows, repeated ones too, and all
    columns stay; a column already named ``ids_col`` is refused.
    """
    if ids_col in docs.columns:
        raise ValueError(f"column {ids_col} exists")
    return docs.withColumn(ids_col, Codec(docs.sparkSession, path).ids(text_col))


def decode_documents(docs: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` plus the text that the ids stand for."""
    if text_col in docs.columns:
        raise ValueError(f"column {text_col} exists")
    return docs.withColumn(text_col, Codec(docs.sparkSession, path).text(ids_col))


def round_trip_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` plus the ids of each whole text and the text that they stand for."""
    clash = [c for c in (ids_col, decoded_col) if c in docs.columns]
    if clash:
        raise ValueError(f"columns {clash} exist")
    both = fresh(docs, "_both")
    out = docs.withColumn(both, Codec(docs.sparkSession, path).round_trip(text_col))
    return out.withColumns({ids_col: F.col(f"{both}.ids"), decoded_col: F.col(f"{both}.text")}).drop(both)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = round_trip_documents(src, path, "text", "ids", "decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
