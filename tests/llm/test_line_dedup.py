"""Line removal against counting in Python, by both ways of probing."""
import hashlib
from collections import Counter

import numpy as np
import pytest

from kassa.llm.line_dedup import PerfectHash, drop_shared_lines, line_digests


def key(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)


def brute(rows, least):
    docs = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and docs[key(x)] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


ROWS = ([(i, f"Own line {i}\n \tShared LINE\x0b\n\n{'Hot' if i % 3 else 'cold'}") for i in range(30)]
        + [(100, None), (101, ""), (102, "\n"), (103, "shared line"), (104, "ÉCOLE\nécole"), (105, "Shared line\nshared LINE"), (106, "a\r\nb\r"),
           (107, "x" * 100_000 + "\nshared line"), (5, "Own line 5"), (5, "Own line 5"), (None, "shared line\nlast")]
        + [(200 + i, " nbsp\nÉcole") for i in range(9)] + [(300, " nbsp")])


@pytest.mark.parametrize("most", [1 << 20, 0])
@pytest.mark.parametrize("least", [2, 10])
def test_lines(frame, least, most):
    got = Counter(map(tuple, line_digests(frame(ROWS), min_docs=least, broadcast_bytes=most).collect()))
    assert got == brute(ROWS, least)


def test_columns_stay(frame):
    df = frame(ROWS)
    out = drop_shared_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert drop_shared_lines(frame([])).count() == 0
    with pytest.raises(ValueError):
        drop_shared_lines(df.withColumnRenamed("n", "n_lines"))


def test_perfect_hash():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(0, 2**64, (2, 20_000), dtype=np.uint64)
    h1[:50] = h1[0]                                     # equal first halves
    n = np.arange(1, 20_001)
    ph = PerfectHash.from_bytes(PerfectHash.build(h1, h2, n).to_bytes())
    assert (ph.find(h1, h2) == n).all()
    assert sum(map(len, ph.words)) * 64 < 20_000 * 5    # bits a key
    assert not ph.find(*rng.integers(0, 2**64, (2, 50_000), dtype=np.uint64)).any()
    none = PerfectHash.build(h1[:0], h2[:0], n[:0])
    assert not none.find(h1, h2).any()
