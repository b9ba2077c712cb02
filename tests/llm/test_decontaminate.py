"""Q-gram filtering against edit distance computed plainly."""
import random

import pytest

from kassa.llm import decontaminate as D


@pytest.fixture(scope="module")
def items(prose):
    return [(i, " ".join(prose(30, seed=100 + i)).capitalize() + ".") for i in range(12)]


def edited(text, edits, rng):
    s = list(text)
    for _ in range(edits):
        p = rng.randrange(len(s))
        what = rng.random()
        if what < 0.4:
            s[p] = rng.choice("wxyz")
        elif what < 0.7:
            s.insert(p, rng.choice("wxyz"))
        else:
            del s[p]
    return "".join(s)


def distance_in(pattern, text):
    """Least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(last + (p != t), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_within_budget_found_and_beyond_not(spark, frame, items, prose):
    rng = random.Random(4)
    rows, want = [], set()
    for n in range(60):
        i, t = rng.choice(items)
        most = int(len(t) * D.EDIT_RATE)
        body = edited(t, rng.choice([0, 1, most // 2, most, most + 3, 3 * most]), rng)
        body = body.upper() if n % 5 == 0 else body.replace(" ", "\n") if n % 5 == 1 else body
        text = " ".join(prose(rng.randint(0, 40), seed=n)) + " " + body + " " + " ".join(prose(20, seed=n + 500))
        rows.append((n, text))
        for k, item in items:
            if k == i and distance_in(item.lower(), text.lower().replace("\n", " ")) <= most:
                want.add((n, k))
    got = D.contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    texts = dict(rows)
    for r in got:
        assert texts[r["doc_id"]].encode()[r["start"]:r["end"]].decode() == r["passage"]
        assert distance_in(dict(items)[r["item_id"]].lower(), r["passage"].lower().replace("\n", " ")) == r["edits"]


def test_blocks_pieces_and_odd_rows(spark, frame, items, monkeypatch):
    monkeypatch.setattr(D, "SCAN_BYTES", 600)
    long = "filler words " * 300
    rows = [(1, None), (2, ""), (3, long + items[0][1] + long + items[1][1]), (4, items[2][1] * 2), (4, items[2][1] * 2), (None, items[3][1]), (6, "clean " * 50)]
    bench = spark.createDataFrame([*items, (None, items[0][1]), (50, None), (51, "short"), items[2]], "item_id long, text string")
    want = sorted([(3, 0), (3, 1), (4, 2), (4, 2), (4, 2), (4, 2), (None, 3)], key=repr)
    for block in (1 << 20, 300):
        got = D.contaminated(frame(rows), bench, block_bytes=block).collect()
        assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == want
    clean = D.clean_documents(frame(rows), bench)
    assert clean.columns == frame(rows).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 6]


def test_accents_fold(spark, frame):
    item = "Élève à l'école de Noël, où çà et là l'été s'achève déjà."
    hit = D.contaminated(frame([(1, "avant " + item.upper() + " après")]), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r["item_id"], r["edits"]) for r in hit] == [(7, 0)]


def test_empty_tables(spark, frame, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(frame([(1, "text")]), none).count() == 0
    assert D.contaminated(frame([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert D.clean_documents(frame([(1, "text")]), none).count() == 1


def test_short_items_and_null_ids(spark, frame, monkeypatch):
    monkeypatch.setattr(D, "SCAN_BYTES", 100)
    bench = spark.createDataFrame([(1, "What is the capital of France?"), (2, " Paris\n"), (3, "7"), (4, "ha ha"), (5, "été"), (6, "首都"), (7, "  "), (None, "no id, short"),
                                   (None, "an item without an id that is not short at all"), (None, "Paris"), (8, " Paris"), (9, "Paris")], "item_id long, text string")
    rows = [(1, "so: what is the\nCAPITAL of france? paris."), (2, "what is the capital of francs? parish 77 sha ha"), (3, "7 is 7; ha ha ha ha, ha"), (4, "l'ÉTÉ, étés"),
            (5, "日本の首都は東京"), (6, "x " * 90 + "Paris" + " x" * 90 + " paris"), (7, "no id, short"), (8, "an item without an id that is not short at all"), (9, "what is the capital"), (10, ""),
            (11, "of France?"), (12, "comparison"), (13, "paris")]
    got = D.contaminated(frame(rows, 1), bench).collect()
    texts = dict(rows)
    for r in got:
        assert texts[r["doc_id"]].encode()[r["start"]:r["end"]].decode() == r["passage"] and r["edits"] == 0
    paris = [(d, i) for d in (1, 6, 6, 13) for i in (2, 8, 9)]
    want = [(1, 1), (3, 3), (3, 3), (3, 4), (3, 4), (4, 5), (5, 6), (7, None), (8, None), *paris]
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == sorted(want, key=repr)
    assert sorted(r["doc_id"] for r in D.clean_documents(frame(rows), bench).collect()) == [2, 9, 10, 11, 12]


def test_passages_of_items(spark, frame, prose, monkeypatch):
    item = prose(59, seed=1)
    other = " ".join(prose(40, seed=2))
    body = lambda n, words: other + " " + " ".join(words) + " " + " ".join(prose(30, seed=n))
    swapped = item[:20] + ["wxyz"] + item[21:40] + ["zyxw"] + item[41:59]
    rows = [(1, body(11, item[5:50])), (2, body(12, [w.upper() for w in item[30:43]])), (3, body(13, item[10:18])), (4, body(14, item)), (5, body(15, swapped)),
            (6, body(16, item[:20] + prose(60, seed=5) + item[25:45])), (7, body(17, prose(50, seed=6))), (8, "日本語の文章を十三文字以上引用した")]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "これは日本語の文章を十三文字以上引用したものです、たぶん")], "item_id long, text string")
    plain = {r["doc_id"] for r in D.contaminated(frame(rows), bench).collect()}
    assert plain <= {4, 5}
    for scan_bytes in (2 << 20, 700):
        monkeypatch.setattr(D, "SCAN_BYTES", scan_bytes)
        got = D.contaminated(frame(rows), bench, segment_words=13).collect()
        hits = sorted((r["doc_id"], r["item_id"], r["passage"].lower(), r["edits"]) for r in got)
        assert [(d, i) for d, i, _, _ in hits] == [(1, 1), (2, 1), (4, 1), (5, 1), (6, 1), (6, 1), (8, 2)]
        for d, quoted in ((1, item[5:50]), (2, item[30:43]), (4, item)):
            (passage,) = (p for n, _, p, _ in hits if n == d)
            assert " ".join(quoted) in passage and len(passage) <= len(" ".join(quoted)) + 30
    left = D.clean_documents(frame(rows), bench, segment_words=13).collect()
    assert sorted(r["doc_id"] for r in left) == [3, 7]


def flat(text):
    """Folded as the operator documents it, for ASCII texts: lower case, a run of white space is one blank."""
    import re
    return re.sub(r"[ \t-\r]+", " ", text.lower())


def least_edits(pattern, text):
    """Least edits of the pattern against any part of the text, by rows."""
    import numpy as np
    t = np.frombuffer(text.encode(), np.uint8)
    cells = np.arange(len(t) + 1)
    row = np.zeros(len(t) + 1, np.int64)
    for i, p in enumerate(pattern.encode(), 1):
        new = np.concatenate([[i], np.minimum(row[:-1] + (t != p), row[1:] + 1)])
        row = np.minimum.accumulate(new - cells) + cells
    return int(row.min())


def budget(size):
    return max(min(int(size * D.EDIT_RATE), size // D.Q - 1), 0)


def quoted(item, text, words):
    """Whether the item, or any run of so many of its words, is in the text within its edit budget."""
    item, text = flat(item), flat(text)
    if least_edits(item, text) <= budget(len(item)):
        return True
    w = item.split(" ")
    return any(least_edits(r, text) <= budget(len(r)) for r in (" ".join(w[i:i + words]) for i in range(len(w) - words + 1)))


@pytest.mark.parametrize("scan_bytes", [2 << 20, 900])
def test_passages_with_edits_by_brute_force(spark, frame, prose, monkeypatch, scan_bytes):
    """The registered mode against edit distance for every run of words."""
    monkeypatch.setattr(D, "SCAN_BYTES", scan_bytes)
    rng = random.Random(8)
    bench = [(i, " ".join(prose(rng.randint(14, 45), seed=900 + i))) for i in range(6)]
    rows = []
    for n in range(36):
        i, t = rng.choice(bench)
        w = t.split(" ")
        a = rng.randrange(max(1, len(w) - 12))
        part = " ".join(w[a:a + rng.choice([8, 12, 13, 14, 20, 45])])
        part = edited(part, rng.choice([0, 0, 1, 2, 4, 6, 9, 14]), rng)
        rows.append((n, " ".join(prose(12, seed=n)) + " " + part + " \n " + " ".join(prose(12, seed=n + 300))))
    want = {(n, i) for n, text in rows for i, t in bench if quoted(t, text, 13)}
    got = D.contaminated(frame(rows), spark.createDataFrame(bench, "item_id long, text string"), segment_words=13).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and 8 < len(want) < 36


def code(n, seed):
    """Indented source code with rulers, much of it alike."""
    rng = random.Random(seed)
    lines = []
    for _ in range(n):
        depth = "    " * rng.randint(0, 6)
        lines.append(depth + rng.choice(["return None", "for i in range(10):", "if x is not None:", f"value_{rng.randint(0, 999)} = self.read({rng.randint(0, 99)})",
                                         "# " + "-" * rng.randint(20, 60), f"raise ValueError('bad {rng.randint(0, 999)}')", "self.items.append(i)", f"total += {rng.randint(0, 9999)}"]))
    return "\n".join(lines)


@pytest.mark.parametrize("words", [0, 13])
def test_source_code(spark, frame, words, monkeypatch):
    """Runs of blanks and rulers match each other everywhere; the result is that of plain edit distance."""
    monkeypatch.setattr(D, "MOST_PAIRS", 5000)
    monkeypatch.setattr(D, "COMMON", 8)
    rng = random.Random(5)
    bench = [(i, code(14, 50 + i)) for i in range(25)]
    rows = [(n, code(30, n) + "\n" + code(1, 999)) for n in range(12)]
    rows += [(100 + n, code(10, 200 + n) + "\n" + edited(bench[n][1], rng.choice([0, 3, 12, 40]), rng) + "\n" + code(10, 300 + n)) for n in range(10)]
    rows += [(200, bench[3][1].replace("    ", "\t")), (201, " " * 3000), (202, "# " + "-" * 3000)]
    limit = words or 10**9
    want = {(n, i) for n, text in rows for i, t in bench if quoted(t, text, limit)}
    got = D.contaminated(frame(rows), spark.createDataFrame(bench, "item_id long, text string"), segment_words=words).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and (200, 3) in want
    texts = dict(rows)
    for r in got:
        assert texts[r["doc_id"]].encode()[r["start"]:r["end"]].decode() == r["passage"]


def test_code_against_code_in_bounded_time_and_memory():
    """Snippets of the standard library against its files: quick, and the matches held stay few."""
    import glob
    import os
    import time

    import pyarrow as pa
    files = [open(f, errors="replace").read() for f in sorted(glob.glob(os.path.dirname(os.__file__) + "/*.py"))[:80]]
    files = [f for f in files if len(f) > 5000]
    rng = random.Random(1)
    bench = []
    for k in range(164):
        f = rng.choice(files)
        a = rng.randrange(len(f) - 600)
        bench.append((k, f[a:a + 600]))
    index = D.ItemIndex(bench, segment_words=13)
    text = "".join(files)[:300_000]
    began = time.process_time()
    (hits,) = D.scan(index, pa.array([text]))
    assert time.process_time() - began < 30
    inside = {k for k, t in bench if t in text}
    assert inside and inside <= {h[0] for h in hits}
