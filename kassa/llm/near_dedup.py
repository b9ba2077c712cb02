"""Operator 7: near-duplicate documents by improved consistent weighted sampling.

1. A text's word shingles are weighted by TF-IDF. Document frequencies are
   counted over all documents into ``2**DF_BITS`` hash buckets of shingles, a
   table of fixed size: ordinary shingles get nearly equal weights, those that
   a noticeable share of all documents has get less.
2. Improved consistent weighted sampling draws ``SAMPLES`` pairs (shingle,
   level) from each text; two texts agree in a draw with a probability equal
   to their weighted Jaccard similarity. Equal texts are one class from here.
3. The draws are banded. Classes that share a band are candidates; those whose
   sketches agree in fewer than ``LEAST_AGREE`` draws are not (a pair of
   similarity 0.8 passes both with a probability of about 0.9998).
4. Candidates are verified by their exact weighted Jaccard similarity, in
   rounds: first each class's most alike candidate, then, where two blocks of
   a bucket meet, all pairs whose classes the links found so far have not
   joined. A pair inside one component cannot change the result, so no link
   between components is lost. Candidate pairs never become rows: a group of
   blocks gives its best pairs, and at last its links.

Buckets are cut into blocks of ``BLOCK`` classes and compared block by block,
so no task holds a bucket. Components are found by rounds over tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from kassa.llm.common import bounded_batches, fresh, mix64, share, shared, stash, whole
from kassa.llm.components import connected_components
from kassa.llm.shingles import WORDS, shingle_blocks

LEAST = 0.8
DF_BITS = 18
ROWS, BANDS = 4, 16
SAMPLES = ROWS * BANDS
LEAST_AGREE = 36
BLOCK = 256
STEP = 16384
ROUNDS = 2
BROADCAST_BYTES = 64 << 20


def bucket_of(sh: np.ndarray) -> np.ndarray:
    return (sh >> np.uint64(64 - DF_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text_col: str, words: int = WORDS) -> np.ndarray:
    """IDF of each shingle bucket over all documents: ln(1 + N / (documents' shingles in it))."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << DF_BITS, np.int64)
        for batch in batches:
            for _, _, _, sh, _ in shingle_blocks(batch.column(0), words):
                total += np.bincount(bucket_of(sh), minlength=len(total))
        some = np.flatnonzero(total)
        for lo in range(0, len(some), 65536):
            part = some[lo:lo + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["bucket", "n"])

    bounded_batches(docs.sparkSession)
    src = docs.select(whole(text_col).alias("text"))
    found = src.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # 2**DF_BITS rows at most
    df = np.ones(1 << DF_BITS)
    df[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return np.log1p(docs.count() / df).astype(np.float32)


def sketch(doc: np.ndarray, sh: np.ndarray, weight: np.ndarray, texts: int, samples: int = SAMPLES) -> np.ndarray:
    """A row of ``samples`` draws for each text; equal numbers are equal draws. Entries are ordered by text.

    For each draw every shingle has r, c ~ Gamma(2, 1) and beta ~ U(0, 1) from
    its hash; t = floor(ln w / r + beta), and the shingle with the least
    ln c - r (t - beta) - r is drawn, at level t. The minimum names both.
    """
    f = np.float32
    out = np.full((texts, samples), np.inf, f)
    lnw = np.log(weight).astype(f)
    seeds = mix64(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    low24, scale, half = np.uint64(0xFFFFFF), f(2**-24), f(2**-25)

    def uniform(bits: np.ndarray, shift: int) -> np.ndarray:
        return ((bits >> np.uint64(shift)) & low24).astype(f) * scale + half

    for lo in range(0, len(sh), STEP):
        x, lw, d = sh[lo:lo + STEP], lnw[lo:lo + STEP], doc[lo:lo + STEP]
        first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        rows = d[first]
        for j in range(samples):
            a = mix64(x ^ seeds[j])
            b = mix64(a + np.uint64(0x9E3779B97F4A7C15))
            r = -np.log(uniform(a, 40) * uniform(a, 16))
            c = -np.log(uniform(b, 40) * uniform(b, 16))
            beta = (a & np.uint64(0xFFFF)).astype(f) * f(2**-16)
            key = np.log(c) - r * (np.floor(lw / r + beta) - beta) - r
            out[rows, j] = np.minimum(out[rows, j], np.minimum.reduceat(key, first))
    return out.view(np.uint32)


def sketcher(spark: SparkSession, idf: np.ndarray, words: int = WORDS):
    """Column function text -> sketch bytes; null for a text without words."""
    held = share(spark, idf)

    @F.arrow_udf("binary")
    def draw(texts: pa.Array) -> pa.Array:
        out: list[bytes | None] = []
        for lo, hi, doc, sh, n in shingle_blocks(texts, words):
            has = np.zeros(hi - lo, bool)
            has[doc] = True
            rows = sketch(doc, sh, n * shared(held)[bucket_of(sh)], hi - lo)
            out += [r.tobytes() if h else None for r, h in zip(rows, has, strict=True)]
        return pa.array(out, pa.binary())

    return draw


def vectoriser(spark: SparkSession, idf: np.ndarray, words: int = WORDS):
    """Column function text -> its weighted shingles as bytes (sorted hashes, then float weights)."""
    held = share(spark, idf)

    @F.arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        out: list[bytes] = []
        for lo, hi, doc, sh, n in shingle_blocks(texts, words):
            w = (n * shared(held)[bucket_of(sh)]).astype("<f4")
            at = np.searchsorted(doc, np.arange(hi - lo + 1))
            out += [sh[a:b].tobytes() + w[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
        return pa.array(out, pa.binary())

    return vector


def weighted_jaccard(x: bytes, y: bytes) -> float:
    m, n = len(x) // 12, len(y) // 12
    a, b = np.frombuffer(x, "<u8", m), np.frombuffer(y, "<u8", n)
    v, w = np.frombuffer(x, "<f4", m, 8 * m).astype(float), np.frombuffer(y, "<f4", n, 8 * n).astype(float)
    at = np.searchsorted(b, a)
    at[at == n] = 0
    same = b[at] == a if n else np.zeros(m, bool)
    common = np.minimum(v[same], w[at[same]]).sum()
    total = v.sum() + w.sum() - common
    return float(common / total) if total else 0.0


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast when its rows are known to take little; else left to a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def open_pairs(band: int, same_block: bool, left: np.ndarray, right: np.ndarray, node: np.ndarray, comp: np.ndarray,
               codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right, agreeing draws) that are candidates and not in one component yet.

    A pair that shares several bands belongs to the first of them.
    """
    cl, cr = codes[left], codes[right]
    agree = np.zeros((len(left), len(right)), np.int16)
    for d in range(SAMPLES):
        agree += cl[:, d, None] == cr[None, :, d]
    ok = (agree >= LEAST_AGREE) & (comp[left][:, None] != comp[right][None, :])
    if same_block:
        ok &= node[left][:, None] < node[right][None, :]
    p, q = np.nonzero(ok)
    for e in range(band):
        e4 = slice(e * ROWS, (e + 1) * ROWS)
        new = ~(cl[p, e4] == cr[q, e4]).all(1)
        p, q = p[new], q[new]
    return left[p], right[q], agree[p, q].astype(np.int32)


def each_group(band: pa.Array, i: pa.Array, j: pa.Array, rows: pa.Array) -> Iterator[tuple]:
    """For each group its rows' nodes and flat values, and its open pairs."""
    flat = rows.flatten()
    node, x, comp = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("node", "x", "comp"))
    codes = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint32).reshape(-1, SAMPLES)
    at = np.concatenate(([0], np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))))
    for g, (k, bi, bj) in enumerate(zip(band.to_pylist(), i.to_pylist(), j.to_pylist(), strict=True)):
        s = np.arange(at[g], at[g + 1])
        yield node, comp, open_pairs(k, bi == bj, s[x[s] == bi], s[x[s] == bj], node, comp, codes)


def pair_lists(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a, _ in found]))).astype(np.int32)
    cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 2
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(cols, ["a", "b"]))


PAIRS = ArrayType(StructType([StructField("a", LongType()), StructField("b", LongType())]))


@F.arrow_udf(PAIRS)
def most_alike(band: pa.Array, i: pa.Array, j: pa.Array, rows: pa.Array) -> pa.Array:
    """In each group the most alike open pair of every class (ties: the least partner)."""
    out = []
    for node, _, (p, q, agree) in each_group(band, i, j, rows):
        one, other, n = np.concatenate([p, q]), np.concatenate([q, p]), np.concatenate([agree, agree])
        order = np.lexsort((node[other], -n, one))
        first = order[np.concatenate(([True], one[order][1:] != one[order][:-1]))] if len(order) else order
        a, b = node[one[first]], node[other[first]]
        out.append((np.minimum(a, b), np.maximum(a, b)))
    return pair_lists(out)


@F.arrow_udf(ArrayType(LongType()))
def with_open_pairs(band: pa.Array, i: pa.Array, j: pa.Array, rows: pa.Array) -> pa.Array:
    """The classes of each group that have an open pair in it."""
    return pa.array([np.unique(np.concatenate([node[p], node[q]])) for node, _, (p, q, _) in each_group(band, i, j, rows)], pa.list_(pa.int64()))


def linked(least: float):
    @F.arrow_udf(PAIRS)
    def links(band: pa.Array, i: pa.Array, j: pa.Array, rows: pa.Array) -> pa.Array:
        """Of each group's open pairs those that are similar enough, none between components already joined by others."""
        vector = rows.flatten().field("vector")
        out = []
        for node, comp, (p, q, agree) in each_group(band, i, j, rows):
            tops: dict[int, int] = {}

            def top(c: int, tops=tops) -> int:
                while c in tops:
                    c = tops[c]
                return c

            held, a, b = {}, [], []
            for m in np.argsort(-agree, kind="stable"):
                x, y = int(p[m]), int(q[m])
                cx, cy = top(comp[x]), top(comp[y])
                if cx == cy:
                    continue
                for z in (x, y):
                    if z not in held:
                        held[z] = vector[z].as_py()
                if weighted_jaccard(held[x], held[y]) >= least:
                    tops[max(cx, cy)] = min(cx, cy)
                    a.append(node[x])
                    b.append(node[y])
            out.append((np.array(a, np.int64), np.array(b, np.int64)))
        return pair_lists(out)

    return links


def band_members(classes: DataFrame) -> DataFrame:
    """``key, band, blocks, x, node``: classes (node, sketch) by the bands they share with others."""
    bands = classes.select("node", "sketch", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    key = F.xxhash64("band", F.expr(f"substring(sketch, band * {4 * ROWS} + 1, {4 * ROWS})"))
    slim = stash(bands.select("node", "band", key.alias("key")))
    shared = stash(slim.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    return stash(slim.join(shared, "key").select("key", "band", blocks.alias("blocks"), "node")
                     .withColumn("x", F.pmod(F.xxhash64("node"), "blocks").cast("int")))


def labelled(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``node, comp, sketch``: a class that no link has joined is its own component."""
    if labels is None:
        return classes.select("node", F.col("node").alias("comp"), "sketch")
    own = labels.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
    return classes.join(own, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("_comp", "node").alias("comp"), "sketch")


GROUP = ["key", "band", "i", "j"]


def block_rows(members: DataFrame, classes: DataFrame) -> DataFrame:
    """A row for each class and pair of blocks of its bucket; every pair of blocks meets once, a block with itself too."""
    return members.join(classes, "node").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "band", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "node", "comp", "sketch")


def gathered(rows: DataFrame, *more: str) -> DataFrame:
    """The rows of each group as a list: those of two blocks, whatever the bucket's size."""
    return rows.groupBy(*GROUP).agg(F.collect_list(F.struct("node", "x", "comp", "sketch", *more)).alias("rows"))


def similar(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is at least ``least``, with ``similarity``."""
    left = vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    right = vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"))

    @F.arrow_udf("double")
    def measure(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([weighted_jaccard(a, b) for a, b in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.float64())

    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", measure("va", "vb").alias("similarity")).where(F.col("similarity") >= least)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, words: int = WORDS) -> DataFrame:
    """One row per document row: ``doc_id, class_id, class_size, kept, text_sha256``.

    Documents are of one class when a chain of pairs with a weighted Jaccard
    similarity of at least ``least`` over TF-IDF word shingles (or of equal
    texts) joins them. ``class_id`` is the class's least id; one row of the
    class with that id is ``kept``. Texts of fewer words than a shingle are one
    shingle; texts without words (null and empty too) are alike only when
    equal. Null ids come after all others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    idf = document_frequencies(src, "text", words)
    sha = F.unhex(F.sha2("text", 256))
    rows = stash(src.select("doc_id", sha.alias("sha"), sketcher(spark, idf, words)(F.col("text")).alias("sketch")))
    classes = stash(rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("sketch").alias("sketch"))
                        .withColumn("node", F.monotonically_increasing_id()))
    sketches = classes.where("sketch is not null").select("node", "sketch")
    members = band_members(sketches)
    wanted = stash(classes.join(members.select("node").distinct(), "node").select("node", "sha", F.col("first").alias("doc_id")))
    found = (src.withColumn("sha", sha).alias("d").join(small_side(wanted, 96).alias("w"), (F.col("d.sha") == F.col("w.sha")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
                .select("w.node", "d.text"))
    vectors = stash(found.select("node", vectoriser(spark, idf, words)(F.col("text")).alias("vector")).dropDuplicates(["node"]))
    labels, links = None, None
    for turn in range(ROUNDS + 1):
        rows_now = block_rows(members, labelled(sketches, labels))
        if turn < ROUNDS:
            best = gathered(rows_now).select(F.explode(most_alike("band", "i", "j", "rows")).alias("p")).select("p.*").distinct()
            new = similar(best, vectors, least).select("a", "b")
        else:
            rows_now = stash(rows_now)
            open_rows = gathered(rows_now).select(*GROUP, F.explode(with_open_pairs("band", "i", "j", "rows")).alias("node"))
            last = rows_now.join(stash(open_rows), [*GROUP, "node"]).join(vectors, "node")
            new = gathered(last, "vector").select(F.explode(linked(least)("band", "i", "j", "rows")).alias("p")).select("p.*")
        links = stash(new if links is None else links.union(new))
        labels = connected_components(links)
    comp = classes.join(labels, "node", "left").select("sha", "first", "n", F.coalesce("comp", "node").alias("comp"))
    comp = stash(comp)
    heads = stash(comp.groupBy("comp").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"),
                                           F.min_by("sha", F.struct(F.col("first").isNull(), "first", "sha")).alias("head")))
    member = stash(comp.join(heads, "comp").select("sha", "class_id", "class_size", (F.col("sha") == F.col("head")).alias("leads")))
    out = rows.select("doc_id", "sha").join(member, "sha")
    return out.select("doc_id", "class_id", "class_size", (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, words: int = WORDS) -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; columns stay.

    Of repeated rows (equal id and text) one stays.
    """
    found = stash(near_duplicates(docs, id_col, text_col, least, words))
    h, g, n = fresh(docs, "_sha"), fresh(docs, "_gone_sha"), fresh(docs, "_gone_id")
    marked = docs.withColumn(h, F.sha2(whole(text_col), 256))
    gone = found.where(~F.col("kept")).select(F.col("text_sha256").alias(g), F.col("doc_id").alias(n))
    on = (F.col(h) == F.col(g)) & F.col(id_col).eqNullSafe(F.col(n))
    out = marked.join(small_side(gone, 160), on, "left_anti")
    twice = found.where("kept").groupBy("text_sha256", "doc_id").count().where("count > 1")
    if not twice.isEmpty():
        out = out.dropDuplicates([h, id_col])
    return out.drop(h)
