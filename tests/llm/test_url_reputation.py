"""URL verdicts against a plain reckoning in Python."""
import math
from collections import defaultdict

import pytest

from kassa.llm import url_reputation as U


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def strength(groups):
    g, n, s = len(groups), sum(a for a, _ in groups), sum(b for _, b in groups)
    if g < 2 or n <= g or s in (0, n):
        return 100.0
    ss, nn = sum(b * b / a for a, b in groups), sum(a * a for a, _ in groups)
    msb, msw, n0 = (ss - s * s / n) / (g - 1), (s - ss) / (n - g), (n - nn / n) / (g - 1)
    return 1 / min(0.99, max(0.001, (msb - msw) / (msb + (n0 - 1) * msw))) - 1


def posteriors(pages, outcomes):
    bad = {}
    for i, b in outcomes:
        if i is not None and b is not None:
            bad[i] = max(bad.get(i, 0), b)
    hosts = defaultdict(lambda: [0, 0])
    for i, url in pages:
        if i in bad:
            h = hosts[split_url(url)[0]]
            h[0] += 1
            h[1] += bad[i]
    dom = lambda h: ".".join(h.split(".")[-(3 if ".".join(h.split(".")[-2:]) in U.TWO_LABEL_SUFFIXES else 2):])
    suf = lambda h: ".".join(h.split(".")[-2:]) if ".".join(h.split(".")[-2:]) in U.TWO_LABEL_SUFFIXES else h.split(".")[-1]
    domains, suffixes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for h, (n, s) in hosts.items():
        for level, k in ((domains, dom(h)), (suffixes, suf(h))):
            level[k][0] += n
            level[k][1] += s
    n, s = sum(v[0] for v in suffixes.values()), sum(v[1] for v in suffixes.values())
    m = (s + 1) / (n + 2)
    kh, kd, ks = (strength(list(x.values())) for x in (hosts, domains, suffixes))
    ms = {k: (ks * m + s) / (ks + n) for k, (n, s) in suffixes.items()}
    md = {k: (kd * ms[suf(k)] + s) / (kd + n) for k, (n, s) in domains.items()}
    out = {}
    for h, (n, s) in hosts.items():
        a, b = kh * md[dom(h)] + s, kh * (1 - md[dom(h)]) + n - s
        out[h] = a / (a + b) - U.Z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return out


@pytest.fixture(scope="module")
def case(spark):
    pages = [(i, u) for i, u in enumerate([
        None, "", "no scheme", "http://", "http://A.Example.NET/en/x", "http://example.net/de/", "https://example.net?x=/en/", "https://x.example.com/de/1#/fr/",
        "ftp://www.foo.org/fr/?q", "http://org/fr/", "http://notnet/", "x://h/p://q/r", "http://Ünï.net/ÄB", "http://a.co.uk/de/", "//bad/path", "http://net"])]
    outcomes = []
    for k, (host, n, s) in enumerate([("spam.bad-site.com", 40, 39), ("www.bad-site.com", 30, 29), ("good.site.com", 50, 1), ("few.bad-site.com", 1, 0), ("few.site.com", 1, 1),
                                      ("shop.mixed.co.uk", 20, 10), ("spam.foo.co.uk", 25, 25)]):
        for j in range(n):
            i = 1000 * (k + 1) + j
            pages.append((i, f"http://{host}/p/{j}"))
            outcomes.append((i, int(j < s)))
    outcomes += [(1000, None), (None, 1), (3000, 0), (99_999, 1), (1001, 0)]
    pages += [(1000, "http://spam.bad-site.com/p/0"), (None, "http://good.site.com/"), (5, "http://unknown.example.org/")]
    frame = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in pages], "page_id long, url string, m string, _rule string, n int")
    return pages, outcomes, frame, spark.createDataFrame(outcomes, "page_id long, bad int")


def test_posteriors(case):
    pages, outcomes, df, known = case
    want = posteriors(pages, outcomes)
    got = {r["host"]: r["lower"] for r in U.host_reputation(df, known).collect()}
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)
    assert got["spam.bad-site.com"] > 0.5 > got["few.site.com"]


def test_verdicts(case):
    pages, outcomes, df, known = case
    lower = posteriors(pages, outcomes)
    want = []
    for i, u in pages:
        host, path = split_url(u)
        verdict, rule = rule_for(host, path)
        want.append((i, host, path, rule, verdict or ("block" if lower.get(host, 0) > U.MAX_BAD else "allow")))
    out = U.judge_urls(df, known)
    assert out.columns == [*df.columns, "host", "path", "rule", "verdict"]
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {v[4] for v in want if v[3] is None} == {"allow", "block"}


def test_same_as_sql(spark, case):
    """The SQL twin, on a table where hosts are blocked."""
    import duckdb

    from kassa.llm.queries import url_sql
    pages, outcomes, df, _ = case
    labels = spark.createDataFrame([(i, None if b is None else 1 - b, 0) for i, b in outcomes if i is not None and b is not None], "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url").toArrow())
    con.register("labels", labels.toArrow())
    got = U.url_verdicts(df, labels)
    want = con.execute(url_sql()).fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert got.where("rule is null and verdict = 'block'").count() > 50


def test_empty_tables(spark, case):
    _, _, df, _ = case
    none = spark.createDataFrame([], "page_id long, bad int")
    assert U.judge_urls(df.limit(0), none).count() == 0
    assert U.judge_urls(df, none).where("rule is null and verdict <> 'allow'").count() == 0
