"""The byte-level network: plain forward pass, gradients, held-out accuracy, odd rows."""
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from kassa.llm import quality as Q
from kassa.llm.common import text_bytes

SF = "/root/testdata/sf0.01"


def plain_repeats(raw, start):
    """Share of the bytes of each span that equal the byte at each distance before, byte by byte."""
    at = lambda i: raw[i] if 0 <= i < len(raw) else Q.PAD
    each = [[sum(at(i) != Q.PAD and at(i) == at(i - lag) for i in range(start, start + span)) / span for span in Q.SPANS] for lag in range(1, Q.LAGS + 1)]
    return [max(x) for x in zip(*each, strict=True)] + [x for row in each for x in row]


def plain_score(model, text):
    """One text, chunk by chunk."""
    emb, w, b, u, c = model.p
    raw = list(text.encode())
    count = 1 + max(0, -(-(len(raw) - Q.WIDTH) // Q.STRIDE))
    pad = raw + [Q.PAD] * (Q.WIDTH + Q.STRIDE * count)
    tops = np.max([np.concatenate([*(emb[x] for x in pad[k * Q.STRIDE:k * Q.STRIDE + Q.WIDTH]), plain_repeats(raw, k * Q.STRIDE)]) @ w for k in range(count)], axis=0) + b
    return float(1 / (1 + np.exp(-(np.maximum(tops, 0) @ u + c[0]))))


TEXTS = ["", "a", "x" * 16, "x" * 17, "y" * 24, "é" * 40, "some words " * 30, "z" * 5000, "", "tail"]


def test_whole_texts_are_scored(monkeypatch):
    model = Q.ByteConvNet()
    want = [plain_score(model, t) for t in TEXTS]
    for step, block in ((8192, 1 << 20), (7, 64)):
        monkeypatch.setattr(Q, "SLICE", step)
        monkeypatch.setattr(Q, "BLOCK_BYTES", block)
        assert np.allclose(model.score(*text_bytes(pa.array(TEXTS))), want, atol=1e-5)


def test_gradients_follow_the_loss():
    model, y = Q.ByteConvNet(3), np.array([1, 0, 1], np.float32)
    texts = [b"first text that is fine", b"%%% second *** text !!", b"a third one"]  # an empty text sits on the kink of ReLU
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))

    def loss():
        s = model.score(np.frombuffer(b"".join(texts), np.uint8), offsets)
        return float(-np.mean(y * np.log(s) + (1 - y) * np.log(1 - s)))

    model.p = [p.astype(np.float64) for p in model.p]
    grads = model._gradients(texts, y)
    rng = np.random.default_rng(0)
    for which, p in enumerate(model.p):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in p.shape)
            if which == 0:
                at = (int(rng.choice(list(texts[1]))), at[1])
            old = p[at]
            p[at] = old + 1e-3
            up = loss()
            p[at] = old - 1e-3
            down = loss()
            p[at] = old
            decay = 1e-4 * old if which in (1, 3) else 0
            assert abs((up - down) / 2e-3 + decay - grads[which][at]) < 2e-3


def repeated_words(text):
    """Share of adjacent words that are equal."""
    w = (text or "").lower().split()
    return sum(a == b for a, b in zip(w, w[1:], strict=False)) / max(1, len(w) - 1)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="driver test tables absent")
def test_held_out_recall_by_kind(spark):
    """Junk that repeats ordinary words is found as well as other junk, and clean texts are left alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = Q.quality_report(docs, labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    again = [r["predicted"] == 0 for r in out if r["quality"] == 0 and repeated_words(r["text"]) > 0.3]
    other = [r["predicted"] == 0 for r in out if r["quality"] == 0 and repeated_words(r["text"]) <= 0.3]
    clean = [r["predicted"] == 1 for r in out if r["quality"] == 1]
    print("recall", np.mean(again), len(again), np.mean(other), len(other), np.mean(clean), len(clean))
    assert len(again) > 30 and np.mean(again) >= 0.9 and np.mean(other) >= 0.95 and np.mean(clean) >= 0.97


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables absent")
def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = Q.quality_report(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    clean = [r for r in held if r["quality"] == 1]
    assert np.mean([r["predicted"] for r in clean]) > 0.97


def test_odd_rows_and_labels(spark, frame):
    df = frame([(1, None), (2, ""), (3, "good text " * 20), (4, "bad *** " * 20), (4, "bad *** " * 20), (None, "x"), (6, "z" * 300_000)])
    kinds = "doc_id long, quality int, extra string"
    for rows in ([], [(3, 1, ""), (4, 1, "")], [(3, None, ""), (None, 0, ""), (5, 0, ""), (4, 0, ""), (4, 1, "")], [(3, 1, ""), (4, 0, ""), (6, 0, ""), (2, 1, "")]):
        got = Q.quality_report(df, spark.createDataFrame(rows, kinds)).collect()
        assert len(got) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
        assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert {r["score"] for r in Q.quality_report(df, spark.createDataFrame([], kinds)).collect()} == {0.5}
    assert Q.quality_report(frame([]), spark.createDataFrame([], kinds)).count() == 0


def test_held_out_labels_are_not_learned(spark, frame):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 == 1]
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, quality int")
    sample = Q.training_sample(frame([(i, f"text {i}") for i in range(40)]), labels).collect()
    assert {r["_id"] for r in sample} == set(range(40)) - set(ids)
    assert Q.training_sample(frame([(i, f"text {i}") for i in range(40)]), labels, rows=5).count() == 5


def test_keep_good_keeps_columns(frame):
    df = frame([(1, "a"), (2, None)])
    model = Q.ByteConvNet()
    model.constant = 0.7
    assert Q.keep_good(df, model).columns == df.columns and Q.keep_good(df, model).count() == 2
    with pytest.raises(ValueError):
        Q.score_quality(df, model)
