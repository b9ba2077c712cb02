"""Hyperdimensional profiles against a plain bundle, and held-out accuracy."""
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kassa.llm import langid as L

SF = "/root/testdata/sf0.01"


def plain_vector(text, dim=L.DIM):
    out, gap = np.zeros(dim), L.GAP
    sym = [gap]
    for c in text.lower():
        if c.isalpha():
            sym.append(ord(c))
        elif sym[-1] != gap:
            sym.append(gap)
    if sym[-1] != gap:
        sym.append(gap)
    for a, b, c in zip(sym, sym[1:], sym[2:], strict=False):
        if b != gap:
            va, vb, vc = L.letter_vectors(np.array([a, b, c]), dim).astype(int)
            out += np.roll(va, 2) * np.roll(vb, 1) * vc
    return out


TEXTS = ["", "123 !", "a", "Der die das, und  Straße!", "été à l'école", "日本語 テキスト", "x" * 50, "İstanbul", None, "one two\nthree"]


def test_vectors(monkeypatch):
    for rows, grams in ((512, 8192), (2, 3)):
        monkeypatch.setattr(L, "BLOCK_ROWS", rows)
        monkeypatch.setattr(L, "BLOCK_GRAMS", grams)
        parts = list(L.text_vectors(pa.array(TEXTS), L.letter_table()))
        got, has = np.concatenate([v for v, _ in parts]), np.concatenate([h for _, h in parts])
        assert np.array_equal(got, [plain_vector(t or "") for t in TEXTS])
        assert has.tolist() == [any(c.isalpha() for c in t or "") for t in TEXTS]


def test_letters_are_nearly_orthogonal():
    v = L.letter_vectors(np.arange(97, 123)).astype(int)
    dots = v @ v.T / L.DIM
    assert (np.diag(dots) == 1).all() and np.abs(dots - np.eye(26)).max() < 0.2


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables absent")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.language_report(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.98


def test_prototypes_are_exact_sums(frame):
    rows = [(i, t, "l1" if i % 2 else "l2") for i, t in enumerate(TEXTS)] + [(50, "ignored", None)]
    got = L.learn_prototypes(frame(rows), F.lit(True))
    for lang in ("l1", "l2"):
        want = sum(plain_vector(t or "") for _, t, x in rows if x == lang)
        assert np.allclose(got[lang], want / np.linalg.norm(want))
    assert sorted(got) == ["l1", "l2"]


def test_odd_rows(frame):
    learn = [i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    rows = [(learn[0], "the of and", "en"), (learn[1], "der die das", "de"), (learn[2], "the of and", "en"), (learn[3], "!!", "xx"),
            (100, None, "en"), (101, "", None), (102, "42 ...", "de"), (103, "THE AND", None), (103, "THE AND", None), (None, "die das", None), (104, "das " * 60_000, None)]
    got = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in L.language_report(frame(rows)).collect()}
    assert {(100, "und", False), (101, "und", False), (102, "und", False), (103, "en", True), (None, "de", True), (104, "de", True)} <= got
    assert L.language_report(frame([])).count() == 0
    assert {r["lang_pred"] for r in L.language_report(frame([(1, "text", None)])).collect()} == {"und"}
