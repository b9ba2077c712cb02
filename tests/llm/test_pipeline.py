"""The pipeline's stages, each against a plain version on the stage's own input."""
import os

import pytest

import corpus_pipeline as P
from kassa.llm.common import stash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables absent")


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in P.STAGES:
        after = stash(stage(spark, docs, SF))
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order():
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "bpe"]


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] == before.columns
        assert after.dtypes == before.dtypes


def test_quality_keeps_clean_documents(spark, steps):
    before, after = steps[0]
    kept, labels = set(rows(after)), {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert kept < set(rows(before))
    good = [i for i in rows(before) if labels.get(i) == 1]
    bad = [i for i in rows(before) if labels.get(i) == 0]
    assert sum(i in kept for i in good) > 0.97 * len(good)
    assert sum(i in kept for i in bad) < 0.3 * len(bad)


def test_lines(steps):
    from test_line_dedup import key
    before, after = map(rows, steps[1])
    docs: dict = {}
    for i, t in before.items():
        for k in {key(x) for x in (t or "").split("\n")}:
            docs[k] = docs.get(k, 0) + 1
    want = {i: "\n".join(x for x in (t or "").split("\n") if not (key(x) and docs[key(x)] >= 10)) for i, t in before.items()}
    assert after == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[1][1].collect())


def test_one_of_each_class(steps):
    from test_near_dedup import brute
    before, after = map(rows, steps[2])
    assert set(after) == {c for c, _ in brute(sorted(before.items())).values()}
    assert all(before[i] == t for i, t in after.items())


def test_no_benchmark_item_is_left(spark, steps):
    before, after = map(rows, steps[3])
    fold = lambda t: "".join(" " if c in "\t\n\r\x0b\x0c" else c.lower() for c in t)
    items = [fold(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, t in before.items() if any(x in fold(t) for x in items)}
    assert set(before) - set(after) == leaks


def test_tokens(steps):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = rows(steps[4][0]), {r["doc_id"]: r for r in steps[4][1].collect()}
    assert after.keys() == before.keys()
    for i, t in before.items():
        assert list(after[i]["token_ids"]) == tok.encode(t, add_special_tokens=False).ids and after[i]["round_trip"]


def test_run_is_the_chain(spark, steps):
    want = {r["doc_id"]: r["n_tokens"] for r in steps[-1][1].collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in P.run(spark, SF).collect()} == want


def test_odd_rows(spark, tmp_path):
    """Null, empty, repeated and very long rows, and empty tables, go through every stage."""
    docs = spark.createDataFrame([(1, None, "en", "a", None), (2, "", None, None, 0), (3, "one two three four five six", "en", "a", 27), (3, "one two three four five six", "en", "a", 27),
                                  (None, "text without an id", "en", "b", 18), (5, "long " * 50_000, "en", "b", 250_000)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, kinds in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for _, stage in P.STAGES:
            now = stash(stage(spark, now, str(tmp_path)))
        assert now.count() == (4 if start is docs else 0)
