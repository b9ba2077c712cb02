"""The tokenization automaton against the tokenizers library."""
import hashlib
import random
from array import array

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from kassa.llm.bpe import Automaton, decode_documents, encode_documents, load_automaton, splitter, token_digests  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def auto():
    return load_automaton(PATH)


def texts():
    rng = random.Random(5)
    pool = [chr(c) for c in [*range(0x250), 0x2028, 0x3000, 0x1C, 0x1F, 0x4E00, 0x1F600, 0x301, 0xFF10, 0xE01]]
    out = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    out += ["".join(chr(rng.randrange(128)) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    out += ["".join(rng.choice("a b  \n\t'stredlmv1.") for _ in range(40)) for _ in range(600)]
    return out + ["", " ", "\n\n\n", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>c", "<|endoftext", "the" * 500, "a" * 3000, " " * 70]


def test_same_ids_and_text(auto, reference):
    split = splitter()
    for t in texts():
        want = reference.encode(t, add_special_tokens=False).ids
        assert array("i", auto.encode(t, split)).tolist() == want, t
        assert auto.decode(want) == reference.decode(want, skip_special_tokens=False) == t


def merged(word, ranks):
    parts = list(word)
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not pairs:
            return parts
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_search_equals_the_walk(auto):
    """Arcs by search against arcs by walking back through the gadgets."""
    rng = random.Random(8)
    for _ in range(20_000):
        state, label = auto.after[rng.randrange(50_000)], rng.randrange(50_000)
        assert auto.fast_has_arc(state, label) == auto.has_arc(state, label)


def test_gadgets_on_small_merge_lists():
    """Every word over two letters, for merge lists with repeats such as aa and abab."""
    import itertools
    lists = [["a a", "aa a"], ["a a", "aa aa"], ["a b", "ab a", "b a"], ["b a", "a b", "ab ab"], ["a a", "b b", "aa bb", "aabb aa"], ["a b", "ab ab", "abab ab", "b ab"]]
    for spec in lists:
        pairs = [tuple(m.split()) for m in spec]
        names = ["a", "b", *dict.fromkeys(x + y for x, y in pairs)]
        ids = {t: i for i, t in enumerate(names)}
        machine = Automaton({i: t.encode() for t, i in ids.items()}, [(ids[x], ids[y], ids[x + y]) for x, y in pairs], {})
        ranks = {p: k for k, p in enumerate(pairs)}
        for n in range(1, 9):
            for word in map("".join, itertools.product("ab", repeat=n)):
                assert [names[i] for i in machine.encode_bytes(word.encode())] == merged(word, ranks), (spec, word)


def test_documents(frame, reference):
    rows = list(enumerate([*texts()[:50], None, "", "x" * 200_000, "same", "same"]))
    rows.append((3, "again"))
    got = sorted(map(tuple, token_digests(frame(rows), PATH).collect()))

    def want(i, t):
        ids = reference.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return (i, len(ids), sha(",".join(map(str, ids))), sha(t or ""))

    assert got == sorted(want(*r) for r in rows)


def test_columns_stay(frame):
    df = frame([(1, "some text"), (2, None)])
    out = decode_documents(encode_documents(df, PATH), PATH)
    assert out.columns == [*df.columns, "token_ids", "decoded"]
    assert {r["decoded"] for r in out.collect()} == {"some text", ""}
    with pytest.raises(ValueError):
        encode_documents(df.withColumnRenamed("source", "token_ids"), PATH)
    assert encode_documents(frame([]), PATH).count() == 0
