"""Licence scan against plain Dice coefficients."""
import re

from kassa.llm.licenses import TEMPLATES, scan_licenses


def words(text):
    return [w for w in re.sub(r"[\W_]+", " ", text.lower()).split(" ") if w]


def grams(w):
    return set(zip(w, w[1:], strict=False))


def brute(rows, templates=TEMPLATES, least=0.8):
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        units = [(k, x, x) for k, x in enumerate(lines, 1)] + ([(0, None, t)] if len(lines) > 1 else [])
        for k, shown, unit in units:
            a = grams(words(unit))
            for name, text in templates:
                b = grams(words(text))
                if a and b and (dice := 2 * len(a & b) / (len(a) + len(b))) >= least:
                    out.append((i, k, name, round(dice, 12), shown))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "line", "license", "dice", "text"]
    return sorted(((r["doc_id"], r["line"], r["license"], round(r["dice"], 12), r["text"]) for r in df.collect()), key=repr)


MIT = dict(TEMPLATES)["MIT-text"]
ROWS = [(1, None), (2, ""), (3, "Released under the MIT License."), (4, "prose\n  RELEASED -- under *the* MIT   licence\nReleased under the mit license"),
        (5, MIT), (6, MIT.replace(", ", ",\n")), (7, MIT + " and more words that follow it here"), (7, MIT), (8, "This work is licensed under the GNU General Public License, version 3."),
        (None, "Licensed under CC BY-NC 4.0."), (9, "Licensed under CC BY-NC 4.0. " * 3), (10, "license " * 40_000), (11, "\n\n\n"), (12, "Élan\tlicence\nMIT")]


def test_scan(frame):
    want = brute(ROWS)
    assert found(scan_licenses(frame(ROWS))) == want and len(want) > 10


def test_other_templates_and_thresholds(frame):
    templates = [("a", "one two three four"), ("b", "one two three"), ("c", "one"), ("d", "")]
    rows = [(1, "one two three"), (2, "two three four five"), (3, "one two three four\none two"), (4, "one two one two one two three")]
    for least in (0.3, 0.5, 1.0):
        assert found(scan_licenses(frame(rows), templates=templates, least=least)) == brute(rows, templates, least)
    assert scan_licenses(frame(rows), templates=[("c", "one")]).count() == 0


def test_empty_table_and_plan(frame):
    assert scan_licenses(frame([])).count() == 0
    plan = scan_licenses(frame(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_windows(rows, templates=TEMPLATES, least=0.8):
    units, out = brute(rows, templates, least), []
    for i, t in rows:
        lines = (t or "").split("\n")
        w = [(x, k) for k, line in enumerate(lines, 1) for x in words(line)]
        pairs = [((a, b), j, k) for (a, j), (b, k) in zip(w, w[1:], strict=False)]
        for name, text in templates:
            g = grams(words(text))
            own = {k for d, k, n, _, _ in units if d == i and n == name}
            found = []
            for s in range(len(pairs)):
                for e in range(s, min(len(pairs), s + int((2 - least) / least * len(g) + 1e-9))):
                    if pairs[s][0] in g and pairs[e][0] in g and not own & {0, *range(pairs[s][1], pairs[e][2] + 1)}:
                        a = {x for x, _, _ in pairs[s:e + 1]}
                        if (dice := 2 * len(a & g) / (len(a) + len(g))) >= least:
                            found.append((-dice, s, e))
            taken = []
            for d, s, e in sorted(found):
                if not any(s <= y and x <= e for x, y in taken):
                    taken.append((s, e))
                    out.append((i, pairs[s][1], name, round(-d, 12), "\n".join(lines[pairs[s][1] - 1:pairs[e][2]])))
    return sorted(units + out, key=repr)


def test_notices_across_and_within_lines(frame):
    import textwrap
    body = "\n".join(f"line {k} of some code that is not about any of it" for k in range(30))
    rows = [(1, "\n".join(textwrap.wrap(MIT, 78)) + "\n" + body), (2, body + "\n" + "\n".join("// " + x for x in textwrap.wrap(dict(TEMPLATES)["ISC-text"], 60))),
            (3, "Copyright 2020 X. All code here is released under the MIT License, see the file.\n" + body), (4, "x\nReleased under the MIT License.\n" + body + "\nit is released under\nthe MIT License too"),
            (5, body), (6, "Copyright 2020 X. All code here is released under the MIT License, see the file."), (7, None)]
    got = found(scan_licenses(frame(rows), windows=True))
    assert got == brute_windows(rows)
    assert {(d, n) for d, _, n, _, _ in got} == {(1, "MIT-text"), (2, "ISC-text"), (3, "MIT"), (4, "MIT"), (6, "MIT")} and len(got) > len(brute(rows)) == 1
    plan = scan_licenses(frame(rows), windows=True)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_lines_take_time_in_proportion(frame):
    """A row made of a line carries that line, not the document."""
    from kassa.llm.licenses import scan_licenses
    notice = "Released under the MIT License."
    rows = [(1, "\n".join(f"line {i} of a very long file" if i % 1000 else notice for i in range(30_000)))]
    for windows in (False, True):
        got = scan_licenses(frame(rows), windows=windows).where("license = 'MIT' and line > 0").collect()
        assert sorted(r["line"] for r in got) == list(range(1, 30_001, 1000)) and {r["text"] for r in got} == {notice}
