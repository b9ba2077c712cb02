"""Operator 1: quality classifier, a byte-level convolutional network in numpy.

A text is read as UTF-8 bytes and cut into overlapping chunks of ``WIDTH``
bytes, one every ``STRIDE`` bytes, so that the chunks cover the whole text
(the last is padded). Each byte has a learned vector. A chunk also shows how its
text repeats itself: for each distance up to ``LAGS``, which share of the next
16 and of the next 64 bytes equals the byte so far before it, and the largest of
these shares; so words that no labelled text had can be seen to come again and
again. Learned filters look at
both in every chunk; each filter keeps its largest answer over all chunks (max
pooling), and a logistic layer combines these into one probability.

The model is fitted on the driver with a bounded sample of labelled rows:
``SAMPLE_ROWS`` rows in the order of a hash of their id, of at most
``SAMPLE_BYTES`` bytes each. Scoring reads every whole text, in slices of
``SLICE`` chunks; what it holds besides is some ten bytes for each byte of the
longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kassa.llm.common import fresh, row_blocks, share, shared, stash, text_bytes, whole

WIDTH, STRIDE, EMBED, FILTERS = 16, 8, 8, 32
LAGS, SPANS = 24, (16, 64)
GAP = max(LAGS, WIDTH, *SPANS)  # padding between texts, so that none sees another
PAD = 256
SLICE = 4096
BLOCK_BYTES = 1 << 20
SAMPLE_ROWS, SAMPLE_BYTES = 2500, 65536
EPOCHS, BATCH, RATE = 10, 32, 0.01


def held_out(id_col: str) -> Column:
    """Whether crc32(id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chunk_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each chunk in the padded buffer, first chunk of each text, start of each text there."""
    lengths = np.diff(offsets)
    per = 1 + np.maximum(0, -(-(lengths - WIDTH) // STRIDE))
    first = np.concatenate(([0], np.cumsum(per)))
    place = offsets[:-1] + GAP * np.arange(1, len(lengths) + 1)
    within = np.arange(first[-1]) - np.repeat(first[:-1], per)
    return np.repeat(place, per) + STRIDE * within, first, place


def padded(data: np.ndarray, offsets: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The texts one after another, with GAP pad symbols before, between and after them."""
    n = len(offsets) - 1
    out = np.full(len(data) + GAP * (n + 1), PAD, np.uint16)
    for i, p in enumerate(place.tolist()):
        out[p:p + offsets[i + 1] - offsets[i]] = data[offsets[i]:offsets[i + 1]]
    return out


def repeats(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each start (ascending), distance and span the share of the span's bytes that equal the byte so far before
    them; first the largest share of each span."""
    a, n = int(starts[0]), int(starts[-1] - starts[0]) + max(SPANS)
    part = buf[a - LAGS:a + n]
    here, at = part[LAGS:], starts - a
    real = here != PAD
    out = np.empty((len(starts), LAGS + 1, len(SPANS)), np.float32)
    sums = np.zeros(n + 1, np.int32)
    for lag in range(1, LAGS + 1):
        np.cumsum((here == part[LAGS - lag:LAGS - lag + n]) & real, out=sums[1:])
        for k, span in enumerate(SPANS):
            out[:, lag, k] = (sums[at + span] - sums[at]) * np.float32(1 / span)
    out[:, 0] = out[:, 1:].max(1)
    return out.reshape(len(starts), -1)


def repeats_at(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The same for starts in any order."""
    near = buf[starts[:, None] + np.arange(-LAGS, max(SPANS))]
    here = near[:, LAGS:]
    real = here != PAD
    out = np.empty((len(starts), LAGS + 1, len(SPANS)), np.float32)
    for lag in range(1, LAGS + 1):
        same = (here == near[:, LAGS - lag:near.shape[1] - lag]) & real
        for k, span in enumerate(SPANS):
            out[:, lag, k] = same[:, :span].sum(1) * np.float32(1 / span)
    out[:, 0] = out[:, 1:].max(1)
    return out.reshape(len(starts), -1)


class ByteConvNet:
    """embedding and repetition -> filters over chunks -> ReLU -> max over chunks -> logistic."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.p = [rng.normal(0, 0.5, (257, EMBED)).astype(f),
                  rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED + (LAGS + 1) * len(SPANS), FILTERS)).astype(f),
                  np.zeros(FILTERS, f), rng.normal(0, 0.3, FILTERS).astype(f), np.zeros(1, f)]
        self.p[0][PAD] = 0
        self.constant: float | None = None

    def pooled(self, data: np.ndarray, offsets: np.ndarray, where: bool = False):
        """Max of each filter over each text's chunks; with ``where`` also the chunks' bytes and repetition there."""
        emb, w, b, _, _ = self.p
        starts, first, place = chunk_starts(offsets)
        buf = padded(data, offsets, place)
        n = len(offsets) - 1
        top = np.full((n, FILTERS), -np.inf, np.float32)
        at = np.zeros((n, FILTERS), np.int64) if where else None
        span = np.arange(WIDTH)
        for lo in range(0, len(starts), SLICE):
            hi = min(lo + SLICE, len(starts))
            x = emb[buf[starts[lo:hi, None] + span]].reshape(hi - lo, -1) @ w[:WIDTH * EMBED]
            x += repeats(buf, starts[lo:hi]) @ w[WIDTH * EMBED:]
            d0, d1 = np.searchsorted(first, lo, "right") - 1, np.searchsorted(first, hi - 1, "right")
            cuts = np.maximum(first[d0:d1], lo) - lo
            best = np.maximum.reduceat(x, cuts, axis=0)
            if where:
                for k, (c, e) in enumerate(zip(cuts, [*cuts[1:], hi - lo], strict=True)):
                    arg = c + x[c:e].argmax(0)
                    better = best[k] > top[d0 + k]
                    at[d0 + k][better] = starts[lo + arg[better]]
            top[d0:d1] = np.maximum(top[d0:d1], best)
        top += b
        return (top, buf[at[..., None] + span], repeats_at(buf, at.reshape(-1)).reshape(n, FILTERS, -1)) if where else top

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        z = np.zeros(len(offsets) - 1, np.float32)
        for lo, hi in row_blocks(offsets, BLOCK_BYTES):
            part = self.pooled(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            z[lo:hi] = np.maximum(part, 0) @ self.p[3] + self.p[4]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -60, 60)))

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 11) -> ByteConvNet:
        if not len(labels) or labels.min() == labels.max():
            self.constant = float(labels[0]) if len(labels) else 0.5
            return self
        rng = np.random.default_rng(seed)
        m = [np.zeros_like(p) for p in self.p]
        v = [np.zeros_like(p) for p in self.p]
        step, total = 0, EPOCHS * -(-len(texts) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), BATCH):
                pick = order[lo:lo + BATCH]
                grads = self._gradients([texts[i] for i in pick], labels[pick])
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for p, g, a, s in zip(self.p, grads, m, v, strict=True):
                    a += 0.1 * (g - a)
                    s += 0.001 * (g * g - s)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-7)
        return self

    def _gradients(self, texts: list[bytes], y: np.ndarray) -> list[np.ndarray]:
        emb, w, _, u, c = self.p
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        top, seen, again = self.pooled(np.frombuffer(b"".join(texts), np.uint8), offsets, where=True)
        act = np.maximum(top, 0)
        score = 1 / (1 + np.exp(-np.clip(act @ u + c, -30, 30)))
        err = ((score - y) / len(y)).astype(np.float32)
        back = err[:, None] * u * (top > 0)                       # text x filter
        x = np.concatenate([emb[seen].reshape(len(y), FILTERS, -1), again], axis=2)  # text x filter x inputs
        dw = np.einsum("nfk,nf->kf", x, back)
        dx = (back[..., None] * w[:WIDTH * EMBED].T).reshape(-1, EMBED)
        de = np.zeros_like(emb)
        np.add.at(de, seen.reshape(-1), dx)
        de[PAD] = 0
        decay = 1e-4
        return [de, dw + decay * w, back.sum(0), act.T @ err + decay * u, np.array([err.sum()], np.float32)]


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``rows`` pairs (text, y) of labelled documents that are not held out.

    Of an id with several texts the least is taken. Ids with contradicting labels and null labels are left out.
    """
    y = (labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("_id"))
               .agg(F.min(label_col).alias("y"), F.max(label_col).alias("_y")).where("y = _y and _id is not null"))
    texts = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("text")).where(F.octet_length("text") <= most_bytes)
    # the sample is drawn among ids alone; only its own texts move
    chosen = stash(texts.select("_id").join(y, "_id").select("_id", "y").distinct().orderBy(F.xxhash64("_id"), "_id").limit(rows))
    return texts.join(F.broadcast(chosen), "_id").groupBy("_id", "y").agg(F.min("text").alias("text")).select("_id", "text", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, **options) -> ByteConvNet:
    sample = training_sample(docs, labels, **options).orderBy("_id").collect()  # bounded: rows x bytes of the sample
    return ByteConvNet().fit([r["text"].encode("utf-8") for r in sample], np.array([r["y"] for r in sample], np.float32))


def scorer(spark: SparkSession, model: ByteConvNet):
    held = share(spark, model)  # 6,500 numbers, whatever the corpus

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared(held).score(*text_bytes(texts)), pa.float64())

    return score


def score_quality(docs: DataFrame, model: ByteConvNet, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` plus the probability that a text's label is 1, over its whole text.

    Null and empty texts are one chunk of padding. Without labelled rows every
    score is 0.5; with labels of one kind only, that label. Rows are scored
    one by one: repeated rows have equal scores, an empty table stays empty.
    """
    if score_col in docs.columns:
        raise ValueError(f"column {score_col} exists")
    return docs.withColumn(score_col, scorer(docs.sparkSession, model)(F.col(text_col).cast("string")))


def keep_good(docs: DataFrame, model: ByteConvNet, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, with their own columns."""
    c = fresh(docs, "_score")
    return score_quality(docs, model, text_col, c).where(F.col(c) >= least).drop(c)


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    model = fit_quality(docs, labels, id_col=id_col, text_col=text_col)
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    out = score_quality(src, model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
