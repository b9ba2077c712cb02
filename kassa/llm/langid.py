"""Operator 2: language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, made from its code point by
a hash, so no table of letters is needed. An n-gram of three letters is bound
into one vector: the first letter's vector permuted twice, the second's
permuted once and the third's are multiplied. A text is the bundle (sum) of
the vectors of all its n-grams, a language prototype the bundle of all texts
that are known to be in it; a document gets the language whose prototype has
the largest cosine with its own vector.

Prototypes are sums over all learnable documents, added up map-side in each
task; what reaches the driver is one vector for each language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import bounded_batches, mix64, row_blocks, text_bytes
from kassa.llm.quality import held_out

DIM = 1024
GAP = 32            # what stands for any run of non-letters
BLOCK_BYTES, BLOCK_ROWS, BLOCK_GRAMS = 1 << 20, 512, 8192
SHIFT = 21          # bits of a code point in an n-gram's code
NONE = "und"


def letter_vectors(points: np.ndarray, dim: int = DIM) -> np.ndarray:
    """A row of ``dim`` signs (+1, -1) for each code point."""
    part = np.arange(dim // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = mix64(mix64(points.astype(np.uint64)[:, None] + np.uint64(77)) + part)
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def gram_vectors(codes: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Bound vectors of n-grams given as packed code points."""
    low = (1 << SHIFT) - 1
    points = np.stack([codes >> 2 * SHIFT, codes >> SHIFT & low, codes & low])
    known, place = np.unique(points, return_inverse=True)
    v = letter_vectors(known, dim)
    a, b, c = place.reshape(points.shape)
    return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all n-grams of the texts, the text each belongs to, and which texts have letters.

    Texts are lower-cased; a run of non-letters counts as one gap, also at both ends.
    """
    parts = [np.frombuffer(("\n" + t.lower() + "\n").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sym = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    is_letter = letters[sym]
    before = np.concatenate(([False], is_letter[:-1]))
    edge = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
    stay = is_letter | before | edge
    sym = np.where(is_letter, sym, GAP)[stay].astype(np.int64)
    doc = doc[stay]
    has = np.zeros(len(texts), bool)
    has[doc[sym != GAP]] = True
    if len(sym) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    same = (doc[2:] == doc[:-2]) & (sym[1:-1] != GAP)
    codes = (sym[:-2] << 2 * SHIFT) | (sym[1:-1] << SHIFT) | sym[2:]
    return codes[same], doc[2:][same], has


def text_vectors(arr: pa.Array, letters: np.ndarray, dim: int = DIM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (vector of each text, whether it has a letter), in order."""
    data, offsets = text_bytes(arr)
    strings = arr.to_pylist()
    for lo, hi in row_blocks(offsets, BLOCK_BYTES):
        for i in range(lo, hi, BLOCK_ROWS):
            j = min(i + BLOCK_ROWS, hi)
            codes, doc, has = grams([s or "" for s in strings[i:j]], letters)
            place, known = pd.factorize(codes)
            out = np.zeros((j - i, dim), np.float64)
            for g in range(0, len(known), BLOCK_GRAMS):
                vec = gram_vectors(known[g:g + BLOCK_GRAMS], dim).astype(np.float32)
                mine = (place >= g) & (place < g + len(vec))
                counts = np.bincount(doc[mine] * len(vec) + place[mine] - g, minlength=(j - i) * len(vec))
                out += counts.reshape(j - i, len(vec)).astype(np.float32) @ vec
            yield out, has


def learn_prototypes(docs: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """Unit prototype of each language, from every row that ``where`` admits with a language."""
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = letter_table(), {}
        for batch in batches:
            langs, at = batch.column(1).to_pylist(), 0
            for vec, _ in text_vectors(batch.column(0), letters, dim):
                mine = np.array(langs[at:at + len(vec)], object)
                at += len(vec)
                for lang in set(mine):
                    sums[lang] = sums.get(lang, 0) + vec[mine == lang].sum(0)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([np.rint(sums[n]).astype(np.int64).tolist() for n in names], pa.list_(pa.int64()))], ["lang", "v"])

    bounded_batches(docs.sparkSession)
    rows = docs.where(where & F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    parts = rows.mapInArrow(bundle, "lang string, v array<long>").select("lang", F.posexplode("v").alias("d", "x"))
    total = parts.groupBy("lang", "d").agg(F.sum(F.col("x").cast("double")).alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in total.collect():  # languages x DIM numbers
        out.setdefault(r["lang"], np.zeros(dim))[r["d"]] = r["x"]
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def predictor(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM):
    """Column function text -> struct(lang, score)."""
    names = sorted(prototypes)
    held = docs.sparkSession.sparkContext.broadcast((names, np.stack([prototypes[n] for n in names]) if names else np.zeros((0, dim)), {}))

    @F.arrow_udf("lang string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        names, proto, kept = held.value
        if "letters" not in kept:
            kept["letters"] = letter_table()
        langs: list[str] = []
        scores: list[float] = []
        for vec, has in text_vectors(texts, kept["letters"], dim):
            norm = np.linalg.norm(vec, axis=1)
            ok = has & (norm > 0) & bool(names)
            cos = vec @ proto.T / np.where(norm > 0, norm, 1)[:, None] if names else np.zeros((len(vec), 1))
            best = cos.argmax(1)
            langs += [names[b] if o else NONE for b, o in zip(best, ok, strict=True)]
            scores += np.where(ok, np.clip(cos[np.arange(len(vec)), best], 0, 1), 0).tolist()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` plus struct(lang, score) of each whole text.

    ``und`` with score 0 for a null text, one without a letter, and when no
    language was learned. Equal cosines go to the first language by name.
    Repeated rows get equal answers; an empty table stays empty.
    """
    if out_col in docs.columns:
        raise ValueError(f"column {out_col} exists")
    return docs.withColumn(out_col, predictor(docs, prototypes)(F.col(text_col).cast("string")))


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``; learned from rows not held out."""
    prototypes = learn_prototypes(docs, ~held_out(id_col), text_col, lang_col)
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return identify(src, prototypes).select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
