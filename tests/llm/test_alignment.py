"""Alignment against both libraries on whole texts, counted in plain dictionaries."""
import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from kassa.llm import alignment as A
from kassa.llm.bpe import byte_alphabet
from kassa.llm.queries import PIECES, tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    tok = tokenizers.Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    alphabet = byte_alphabet()
    with open(tokenizer_path(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    bytes_a = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if all(c in alphabet for c in t)}

    def bytes_b(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return None
        a = [(i, bytes_a[i]) for i in tok.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes_b(i)) for i in model.encode(text)]
        raw = (" " + text).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return None
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
        both = sorted(ends[0] & ends[1])
        out = [([], []) for _ in both]
        for k, side in enumerate((a, b)):
            at = 0
            for i, x in side:
                at += len(x)
                out[np.searchsorted(both, at)][k].append(i)
        return out

    def brute(rows):
        cut = [(i, groups(t)) for i, t in rows]
        counts = Counter()
        for _, g in cut:
            counts.update({(x, y) for a, b in g or () for x in a for y in b})
        most = defaultdict(int)
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        out = []
        for i, g in cut:
            links = [(x, y) for a, b in g or () for x in a for y in b]
            said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
            out.append((i, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), len(links),
                        sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), "" if g is None else hashlib.sha256(said.encode()).hexdigest()))
        return Counter(out)
    return brute


def aligned(df, **kw):
    got = A.align_tokens(df, tokenizer_path(), tokenizer_path(PIECES), **kw)
    assert got.columns == COLUMNS
    return Counter(map(tuple, got.collect()))


ODD = ["", None, " ", "  ", "\n", "\n\n x", "a  b   c", " lead and trail ", "tab\tand\r\nline \n end", "▁ piece ▁x", "<|endoftext|> <s> </s> <unk> <0x41>", "naïve café déjà",
       "日本語のテキスト 한국어 текст", "😀😀 👩‍👩‍👧 é́", "x" * 500, "ab" * 300 + " " + "9" * 100, "\x00\x01 \x7f", " nbsp em　 wide", "I'll don't we've", "=" * 70, "…—“quoted”",
       "ſ K ﬁ ﷺ", "\x1c\x1d \x85   x", "a​b ﻿c"]


def test_odd_texts(frame, plain):
    rows = list(enumerate(ODD)) + [(None, "null id"), (3, "again"), (3, "again")]
    assert aligned(frame(rows)) == plain(rows)


def test_random_texts(frame, plain, prose):
    rng = random.Random(5)
    chars = "abcdefgh  \n\t.,'ABC012éß漢😀 -_"
    rows = [(i, "".join(rng.choices(chars, k=rng.randint(0, 200)))) for i in range(150)]
    rows += [(1000 + i, " ".join(prose(60, i % 20))) for i in range(60)]
    assert aligned(frame(rows)) == plain(rows)


@pytest.mark.parametrize("fan", [2, 3])
def test_many_small_runs_merged_on_several_levels(frame, plain, prose, monkeypatch, fan):
    monkeypatch.setattr(A, "BLOCK_KEYS", 7)
    rows = [(i, " ".join(prose(30, i % 25)) + (" same words end here" if i % 3 else "")) for i in range(120)]
    assert aligned(frame(rows), fan=fan, run_records=300, buckets=5) == plain(rows)


def test_pieces_of_long_texts(frame, plain, prose, monkeypatch):
    long = " ".join(prose(4000, 1)) + "\n  " + "z" * 3000 + " \t " + " ".join(prose(500, 2))
    rows = [(1, long), (2, "short text"), (3, long[:5000]), (4, long + " ▁")]
    want = plain(rows)
    assert aligned(frame(rows)) == want
    monkeypatch.setattr(A, "PIECE_CHARS", 50)
    monkeypatch.setattr(A, "PART_TOKENS", 180)
    monkeypatch.setattr(A, "MOST_LINKS", 20)
    assert aligned(frame(rows)) == want


def test_one_hot_text(frame, plain):
    rows = [(i, "the very same words" if i % 3 else f"text number {i}") for i in range(240)]
    assert aligned(frame(rows)) == plain(rows)


def test_empty_table(frame):
    assert aligned(frame([])) == Counter()
    assert aligned(frame([(1, None), (2, "")])) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_merge_of_runs(monkeypatch):
    monkeypatch.setattr(A, "BLOCK_KEYS", 4)
    rng = np.random.default_rng(1)
    runs, want = [], Counter()
    for _ in range(9):
        keys = np.unique(rng.integers(0, 60, rng.integers(1, 40)))
        counts = rng.integers(1, 1 << 40, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        runs.append(A.write_run(keys, counts))
    parts = list(A.merge_runs(runs))
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
