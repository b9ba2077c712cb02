"""Repeated strings against a set of all strings seen before."""
import hashlib
import random

import pytest

from kassa.llm import suffix_dedup
from kassa.llm.suffix_dedup import cut_repeats, repeat_digests


def brute(rows, length):
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for q in range(len(b)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gam", "délta", "x", "é", "longerword"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(8)]
    rows = []
    for i in range(40):
        t = rng.choice(base)
        if rng.random() < 0.7:
            a = rng.randrange(len(t) + 1)
            t = t[:a] + rng.choice(["", "z", " qq ", "é" * rng.randint(0, 130), "a" * rng.randint(0, 300)]) + t[a + rng.randrange(5):] + rng.choice(base)[:rng.randint(0, 400)]
        rows.append((i * 3, t))
    return [*rows, (1000, "a" * 500), (1001, ""), (1002, "a" * 99), (1003, "a" * 100), (1004, "ab" * 200), (1005, None)]


@pytest.mark.parametrize(("length", "gram"), [(100, 32), (40, 16)])
def test_removed_bytes(frame, length, gram):
    rows = corpus(length)
    got = sorted(map(tuple, repeat_digests(frame(rows), length=length, gram=gram).collect()), key=repr)
    assert got == brute(rows, length)


def test_texts_longer_than_a_piece(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    rows = corpus(3)
    assert sorted(map(tuple, repeat_digests(frame(rows)).collect()), key=repr) == brute(rows, 100)


def test_repeated_and_null_ids(frame):
    t = "".join(map(str, range(80)))
    rows = [(None, t), (1, t), (1, t), (2, "x" + t), (-5, "only here " * 3)]
    got = sorted(map(tuple, repeat_digests(frame(rows)).collect()), key=repr)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == brute(order, 100)


def test_empty_and_bad_arguments(frame):
    assert repeat_digests(frame([])).count() == 0
    with pytest.raises(ValueError):
        cut_repeats(frame([]), length=30, gram=28)


def colliding_pair():
    """Texts that differ in 32 bytes in the way that a polynomial modulo 2**64 cannot see."""
    rng = random.Random(1)
    one = [rng.choice("abcdefgh ") for _ in range(16_072)]
    two = list(one)
    for k in range(32):
        at = 100 + sum(512 << j for j in range(5) if k >> j & 1)
        one[at], two[at] = ("x", "y") if bin(k).count("1") % 2 else ("y", "x")
    return "".join(one), "".join(two)


def test_names_that_collide_modulo_a_power_of_two():
    import numpy as np
    one, two = (suffix_dedup.Ranges(np.frombuffer(t.encode(), np.uint8)) for t in colliding_pair())
    ends = np.array([0]), np.array([16_072])
    assert one.name(0, *ends) == two.name(0, *ends)
    assert one.name(1, *ends) != two.name(1, *ends)


@pytest.mark.parametrize("filler", [None, "a"])
def test_texts_that_collide_modulo_a_power_of_two(frame, filler):
    one, two = colliding_pair()
    if filler:
        one, two = ("".join(c if c in "xy" else filler for c in t) for t in (one, two))
    rows = [(1, one), (2, two), (3, one)]
    assert sorted(map(tuple, repeat_digests(frame(rows)).collect()), key=repr) == brute(rows, 100)


def test_names_do_not_depend_on_the_place():
    import numpy as np
    data = np.frombuffer(b"0123" * 50_000 + b"abc" * 3, np.uint8)
    r = suffix_dedup.Ranges(data)
    at = np.array([0, 4, 199_996])
    for which in (0, 1):
        assert len(set(r.name(which, at, at + 4).tolist())) == 1
        assert len(set(r.name(which, np.arange(4), np.arange(4) + 7).tolist())) == 4


def test_one_row_repeated_often(frame):
    t = "".join(map(str, range(60)))
    rows = [(5, t)] * 90 + [(6, t + "end")]
    assert sorted(map(tuple, repeat_digests(frame(rows)).collect()), key=repr) == brute(rows, 100)


def test_ids_as_large_as_the_texts_allow(frame):
    t = "".join(map(str, range(60)))
    for top in (2**62, 2**40, 2**55):
        rows = [(top + k, t + str(k)) for k in range(3)] + [(1, t)]
        assert sorted(map(tuple, repeat_digests(frame(rows)).collect()), key=repr) == brute(sorted(rows), 100)
