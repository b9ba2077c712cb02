"""Block naming against grouping by the text itself."""
import hashlib
from collections import Counter

import pytest

from kassa.llm.exact_dedup import exact_duplicates


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            first = i == keep and not kept
            kept = kept or first
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def found(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_groups(frame, block):
    rows = [(1, "abcdef"), (2, "abcdef"), (3, "abcdeg"), (4, "abc"), (5, ""), (6, None), (7, "a\nb\r\n c"), (8, "a\nb\r\n c"),
            (9, "é" * 7), (10, "é" * 7), (11, "é" * 8), (12, "abcabc"), (13, "abc" * 3), (14, "abcabc"), (20, "x" * 9000), (21, "x" * 9000),
            (22, "x" * 9001), (30, " abc"), (31, "😀" * 5), (32, "😀" * 5)]
    assert found(exact_duplicates(frame(rows), block_chars=block)) == brute(rows)


def test_repeated_rows_and_null_ids(frame):
    rows = [(1, "same"), (1, "same"), (1, "other"), (None, "same"), (None, "alone"), (2, "other"), (2, "third")]
    assert found(exact_duplicates(frame(rows), block_chars=2)) == brute(rows)


def test_empty_table(frame):
    assert exact_duplicates(frame([])).count() == 0


def test_one_hot_group(frame):
    rows = [(i, "hot text " * 50 if i % 3 else f"text {i} " * 60) for i in range(300)]
    assert found(exact_duplicates(frame(rows), block_chars=64)) == brute(rows)


def test_no_python_on_the_main_path(frame):
    plan = exact_duplicates(frame([(1, "a"), (2, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
