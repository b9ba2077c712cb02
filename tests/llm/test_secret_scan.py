"""The ledger's findings against Python's own regular expressions, and what it scans."""
import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kassa.llm.secret_scan import BASE, RULES, Ledger, Rule, scan_secrets, secret_report

PLAIN = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
}
KEY = "0123456789abcdef" * 2


def spans_of(text):
    out = []
    for k, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return [(kind, a, b) for a, k, kind, b in sorted(out)]


def brute(rows):
    out = []
    for i, t in rows:
        s = spans_of(t)
        said = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        n = Counter(k for k, _, _ in s)
        out.append((i, *(n[k] for k in BASE), hashlib.sha256(said([x for x in s if x[0] in BASE]).encode()).hexdigest(), said(s)))
    return Counter(out)


TEXTS = [
    "", None, "nothing here", "password = hunter22", "PassWord='abc123'", 'api_key": "x"', "apikey:abcdef API_KEY = abcdef,token=",
    "secret=token:abcdefg", "token: x secret=abcdef", "token==abcdef", "tokentoken:  ==abcde", "paſſword=abcdefgh", "toKen=abcdefgh",
    "AKIA" + "A" * 15, "AKIA" + "B" * 16, "AKIAKIA" + "9" * 30, "xAKIA" + "C" * 40 + "y AKIA" + "D" * 16, "akia" + "e" * 24,
    "é😀" * 3 + KEY + "😀" + KEY[:23] + "g" + KEY[:24], KEY * 40, f"secret: {KEY} {KEY}", f"token={KEY}\ntoken=\n{KEY}",
    "-----BEGIN RSA PRIVATE KEY-----\n-----BEGIN PRIVATE KEY-----", "ghp_" + "a1B2" * 9, "ghp_" + "a1B2" * 8, "xoxb-123456-7890-abcdefg",
    "eyJhbGciOi.eyJzdWIi.sig-_", "token = eyJhbGciOi.eyJzdWIi.sig-_ " * 5,
]


def test_texts(frame):
    rows = list(enumerate(TEXTS)) + [(100 + i, t) for i, t in enumerate(TEXTS[3:9] * 3)] + [(None, "password:secret1"), (3, TEXTS[3])]
    got = secret_report(frame(rows))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_very_many_matches(frame):
    rows = [(1, f"é{KEY} token={KEY[:8]}\n" * 3000), (2, "word " * 200_000 + KEY), (3, "token=abcdef " * 600)]
    assert Counter(map(tuple, secret_report(frame(rows)).collect())) == brute(rows)


def test_random_pieces(frame):
    import random
    rng = random.Random(3)
    bits = ["password", "token", "=", ":", " ", "'", '"', "abcdef", "AKIA", "ABCDEFGH12345678", KEY[:12], KEY, "é", "\n", "_", "key", "api", "😀", "."]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(400)]
    assert Counter(map(tuple, secret_report(frame(rows)).collect())) == brute(rows)


def test_empty_table(frame):
    assert secret_report(frame([])).count() == 0


def test_hot_blob(frame):
    rows = [(i, f"token={KEY}" if i % 3 else f"text {i} password={i:06d}") for i in range(600)]
    assert Counter(map(tuple, secret_report(frame(rows)).collect())) == brute(rows)


def test_paths_by_a_shuffle_join(frame, monkeypatch):
    from kassa.operators import joins
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_BYTES", 0)
    rows = [(i, f"token={KEY}" if i % 3 else f"text {i} password={i:06d}") for i in range(300)]
    assert Counter(map(tuple, secret_report(frame(rows)).collect())) == brute(rows)


@pytest.fixture
def history(spark):
    def make(rows):
        return spark.createDataFrame(rows, "path string, version int, text string, blob string, spans string, todo string")
    return make


def row(path, version, text):
    return (path, version, text, "b", "s", "t")


def test_only_unseen_pairs_are_scanned(spark, history, tmp_path):
    path = f"file://{tmp_path}/ledger"
    v1 = history([row("a", 1, "password=abcdef"), row("b", 1, "clean"), row("c", 1, "password=abcdef")])
    first = Ledger(spark, path, RULES[:2])
    assert first.unseen(v1).count() == 2  # a and c are one blob
    scan_secrets(v1, first, ["path", "version"])
    assert first.unseen(v1).count() == 0
    v2 = history([row("a", 1, "password=abcdef"), row("a", 2, "rotated"), row("d", 1, "clean"), row("e", 1, f"password=ghijkl {KEY}")])
    todo = {r["text"]: r["todo"] for r in first.unseen(v2).collect()}
    assert todo == {"rotated": ["assign@1", "access@1"], f"password=ghijkl {KEY}": ["assign@1", "access@1"]}
    got = {(r["path"], r["version"]): [tuple(s) for s in r["spans"]] for r in scan_secrets(v2, first, ["path", "version"]).collect()}
    assert got == {("a", 1): [("assign", 0, 15)], ("a", 2): [], ("d", 1): [], ("e", 1): [("assign", 0, 15)]}
    # a further rule is run alone, on all blobs
    more = Ledger(spark, path, RULES[:3])
    assert {tuple(r["todo"]) for r in more.unseen(v2).collect()} == {("hex@1",)}
    got = {(r["path"], r["version"]): [tuple(s) for s in r["spans"]] for r in scan_secrets(v2, more, ["path", "version"]).collect()}
    assert got[("e", 1)] == [("assign", 0, 15), ("hex", 16, 16 + len(KEY))]
    # a new version of a rule replaces what the old one found
    newer = Ledger(spark, path, [Rule("assign", r"password=([a-z]+)", 1, 1, version=2)])
    assert newer.unseen(v2).select("todo").distinct().count() == 1
    got = {(r["path"], r["version"]): [tuple(s) for s in r["spans"]] for r in scan_secrets(v2, newer, ["path", "version"]).collect()}
    assert got[("e", 1)] == [("assign", 0, 15)]
    # findings reach every path that ever had the blob
    both = v1.unionByName(v2)
    assert more.paths(both, ["path", "version"]).where(F.size("spans") > 0).count() == 4


def test_no_python_on_the_main_path(spark, frame):
    docs = frame([(1, "password=abcdef"), (2, "b")])
    ledger = Ledger(spark)
    plans = [ledger.unseen(docs), scan_secrets(docs, ledger), secret_report(docs)]
    for p in plans:
        said = p._jdf.queryExecution().toString()
        assert "Python" not in said and "Arrow" not in said
