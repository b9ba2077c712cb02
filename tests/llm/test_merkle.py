"""The nested rollup against the tree built plainly with hashlib."""
import hashlib
import zlib
from collections import Counter

import pytest

from kassa.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, key string, idx long, n long, node string, path string, block long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root and, for each node, its steps [(left, right)]."""
    steps, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, p in enumerate(place):
            run, j = runs[p // 3], p % 3
            steps[k].append(("".join(run[:j]), "".join(run[j + 1:])))
            place[k] = p // 3
        nodes = [h(*r) for r in runs]
    return (nodes[0] if nodes else None), steps


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sub = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub[g] = tree([leaf(r) for r in groups[g]])
    root, above = tree([sub[g][0] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        for r, own in zip(groups[g], sub[g][1], strict=True):
            cut = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                cut = (*r[:4], r[4].replace("\n", ""))
            folded = leaf(cut)
            for a, b in own + up:
                folded = h(a, folded, b)
            out.append((r[0], leaf(r), sub[g][0], root, h(*(a + b for a, b in own + up)), folded, folded == root))
    return Counter(out)


def make(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "x", "p", 3) for r in rows], COLUMNS).repartition(3)


def found(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(map(tuple, df.collect()))


def rows_of(sizes, start=0):
    out, i = [], start
    for g, n in sizes.items():
        for _ in range(n):
            out.append((i, g, "en" if i % 3 else None, i * 7, f"text {i}\nwith lines" if i % 5 else "flat"))
            i += 1
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2}, {"a": 3}, {"a": 4}, {"a": 28, None: 9, "": 10, "é": 1, "z": 27, "Z": 2}])
def test_small_trees(spark, sizes):
    rows = rows_of(sizes)
    assert found(merkle.manifest_report(make(spark, rows))) == brute(rows)


def test_several_blocks_and_passes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rows = rows_of({"hot": 100, None: 31} | {f"s{k}": 1 + k % 4 for k in range(12)})
    assert found(merkle.manifest_report(make(spark, rows))) == brute(rows)


def test_more_than_a_block(spark):
    rows = rows_of({"hot": 300, "b": 243, "c": 244, "d": 1})
    got = merkle.manifest_report(make(spark, rows))
    assert found(got) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, "a", "en", 4, "x\ny"), (1, "a", "en", 4, "x\ny"), (1, "a", None, 4, "x\ny"), (None, "a", "en", 4, "x"), (None, None, None, None, None),
            (None, None, None, None, None), (2, None, "", 0, ""), (3, None, "", 0, None), (4, "b", "de", 3, "1:x"), (5, "b", "de", 3, "\n" * 50), (6, "b", "x", -1, "ü\n😀" * 3000)]
    assert found(merkle.manifest_report(make(spark, rows))) == brute(rows)


def test_one_row_repeated_more_often_than_a_block(spark):
    rows = [(7, "a", "en", 1, "same\ntext")] * 500 + rows_of({"a": 5}, 100)
    assert found(merkle.manifest_report(make(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert merkle.manifest_report(make(spark, [])).count() == 0


def test_changed_values_change_the_root(spark):
    rows = rows_of({"a": 30, "b": 5})
    root = make(spark, rows).transform(merkle.manifest).first()["root"]
    for k, v in ((2, "xx"), (3, None), (4, "other")):
        other = [(*r[:k], v, *r[k + 1:]) if r[0] == 17 else r for r in rows]
        assert make(spark, other).transform(merkle.manifest).first()["root"] != root


def test_general_fields_and_no_joins_in_the_proofs(spark):
    df = spark.createDataFrame([(i, f"p{i % 2}", f"v{i}") for i in range(20)], "path long, node string, key string")
    out = merkle.manifest(df, id_col="path", group_col="node", fields=["path", "key"])
    assert out.count() == 20 and out.select("root").distinct().count() == 1
    from pyspark.sql import functions as F
    assert out.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Join" not in plan and "Python" not in plan
