"""Near-duplicate classes against all pairs, and the sampling against the similarity it estimates."""
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kassa.llm import near_dedup as N
from kassa.llm.components import connected_components
from kassa.llm.shingles import shingle_blocks


def weights(texts, words=N.WORDS):
    """Exact TF-IDF shingle weights of each text, with the bucketed document frequencies."""
    sets = []
    for t in texts:
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in t.split()]
        sets.append(Counter(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else Counter())
    hashed = []
    for t in texts:
        (_, _, _, sh, n), = list(shingle_blocks(pa.array([t])))
        hashed.append(dict(zip(sh.tolist(), n.tolist(), strict=True)))
    assert [sorted(x.values()) for x in sets] == [sorted(x.values()) for x in hashed]
    df = Counter(h >> (64 - N.DF_BITS) for x in hashed for h in x)
    return [{h: n * np.log1p(len(texts) / df[h >> (64 - N.DF_BITS)]) for h, n in x.items()} for x in hashed]


def similarity(a, b):
    keys = a.keys() | b.keys()
    total = sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / total if total else 0.0


def brute(rows, least=N.LEAST):
    texts = [t or "" for _, t in rows]
    w = weights(texts)
    comp = list(range(len(rows)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if texts[i] == texts[j] or similarity(w[i], w[j]) >= least:
                a, b = top(i), top(j)
                comp[max(a, b)] = min(a, b)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(d)
    return {i: (min((d for d in groups[top(i)] if d is not None), default=None), len(groups[top(i)])) for i in range(len(rows))}


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(2)
    rows = []
    for g in range(12):
        base = prose(rng.choice([30, 80, 200]), seed=g)
        for _ in range(rng.choice([1, 2, 6, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 12])):
                w[rng.randrange(len(w))] = prose(1, seed=rng.random())[0]
            rows.append((len(rows) * 7 % 1000, " ".join(w)))
    rows += [(2001, None), (2002, ""), (2003, " \n"), (2004, "short"), (2005, "Short"), (2006, "two words"), (2007, "a b c d e"), (2008, "A B C D E"),
             (2009, rows[0][1].upper()), (None, rows[1][1]), (2010, "same word " * 400), (2011, "same word " * 401), (2012, " ".join(prose(20_000, seed=77)))]
    return rows


@pytest.mark.parametrize("block", [512, 2])
def test_classes(frame, corpus, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    out = N.near_duplicates(frame(corpus))
    assert out.columns == ["doc_id", "class_id", "class_size", "kept", "text_sha256"]
    got = {(r["doc_id"], r["text_sha256"]): (r["class_id"], r["class_size"]) for r in out.collect()}
    want = brute(corpus)
    assert got == {(d, hashlib.sha256((t or "").encode()).hexdigest()): want[i] for i, (d, t) in enumerate(corpus)}
    kept = [r["class_id"] for r in out.where("kept").collect()]
    assert sorted(kept) == sorted({c for c, _ in want.values()})


def test_a_large_group_of_copies(frame, prose, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    base = prose(60, seed=1)
    rows = []
    for i in range(150):
        w = list(base)
        if i % 3:
            w[i % 60] = f"new{i % 50}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(prose(40, seed=500 + i))) for i in range(30)]
    want = brute(rows)
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in N.near_duplicates(frame(rows)).collect()}
    assert got == {d: want[i] for i, (d, _) in enumerate(rows)}


def test_draws_estimate_the_similarity(prose):
    base = prose(300, seed=9)
    texts = [" ".join(base)]
    for k in (3, 10, 25, 60):
        w = list(base)
        for i in range(k):
            w[i * 300 // k] = f"new{i}"
        texts.append(" ".join(w))
    exact = weights(texts)
    (_, _, doc, sh, n), = list(shingle_blocks(pa.array(texts)))
    lookup = {h: v for x in exact for h, v in x.items()}
    first = {d: exact[d] for d in range(len(texts))}
    draws = N.sketch(doc, sh, np.array([first[d][h] for d, h in zip(doc.tolist(), sh.tolist(), strict=True)]), len(texts), samples=2000)
    assert lookup
    for d in range(1, len(texts)):
        assert abs((draws[0] == draws[d]).mean() - similarity(exact[0], exact[d])) < 0.05


def test_one_of_each_stays(frame, corpus):
    rows = [*corpus, corpus[3], corpus[3]]
    df = frame(rows)
    out = N.drop_near_duplicates(df)
    assert out.columns == df.columns
    want = {c for c, _ in brute(rows).values()}
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(want)
    assert N.drop_near_duplicates(frame([])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 201), (201, 200), (200, 201)] + [(300, 301 + i) for i in range(50)]
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100, 200: 200, 201: 200, **dict.fromkeys(range(300, 351), 300)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_columns_named_like_its_own(spark, frame, corpus):
    """A table may have columns of the names that the operators use for joins."""
    from pyspark.sql import functions as F

    from kassa.llm.line_dedup import drop_shared_lines
    from kassa.llm.url_reputation import judge_urls
    df = frame([(1, "one two three four five six\nshared line"), (2, "one two three four five six\nshared line"), (3, "other\nshared line")])
    taken = df.withColumns({c: F.lit("x") for c in ("_gone_sha", "_gone_id", "_sha", "_hit", "_hit_row", "_row", "_drop", "_blocked", "_rule")})
    out = N.drop_near_duplicates(taken)
    assert out.columns == taken.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    for most in (1 << 26, 0):
        lines = drop_shared_lines(taken, min_docs=3, n_lines="lines_before", n_dropped="lines_gone", broadcast_bytes=most)
        assert [r["lines_gone"] for r in lines.collect()] == [1, 1, 1] and set(taken.columns) <= set(lines.columns)
    pages = taken.select(F.col("doc_id").alias("page_id"), F.lit("http://a.net/x").alias("url"), "_blocked", "_rule")
    judged = judge_urls(pages, spark.createDataFrame([(1, 0)], "page_id long, bad int"))
    assert judged.columns[:4] == pages.columns and {r["verdict"] for r in judged.collect()} == {"block"}
