import re
from collections import defaultdict

import pytest

from ridewise.llm.link_graph import filter_urls, host_edges, propagate

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
URLS = ["http://a.example.com/en/1", "https://WWW.Example.COM/en/2?x=://y", "http://www.example.com/de/", "http://x.net/es/3",
        "http://x.net/esx", "http://x.net/de/4", "http://good.org/a", "http://bad.org/", "nothing here", None, "", "ftp://b.com",
        "http://b.com/", "http://b.com/?q", "http://b.com?/en/", "http://com/", "http://xcom/", "://h.net/fr/", "http:///p", "a://b://c.com/",
        "http://far.org/", "http://u.net/fr/#f"]
HTML = {6: '<a href="http://b.com/1">x</a><a href=\'HTTPS://www.example.com\'>', 7: '<a href="http://x.net/de/1">', 12: '<a href="http://good.org/">' * 3,
        20: '<a href="/rel">', 5: None}


def pages(spark, rows=None):
    rows = [(i, u, HTML.get(i, "<p>")) for i, u in enumerate(URLS)] if rows is None else rows
    return spark.createDataFrame([(*r, "h", "p", "r", 1.0) for r in rows],
                                 "page_id long, url string, html string, host string, path string, rule string, trust double")


def brute(rows, damping=0.85, rounds=20):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    split = []
    for i, u, h in rows:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = low(re.split("[/?#]", rest, maxsplit=1)[0])
            path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        fit = [(r, v) for v, r in RULES for rh, rp in [(r.split("/", 1)[0], "/" + r.split("/", 1)[1])]
               if (host == rh or host.endswith("." + rh)) and path.startswith(rp)]
        split.append((i, host, path, max(fit, key=lambda x: len(x[0]), default=(None, None)), h))
    w = defaultdict(float)
    for _, host, _, _, h in split:
        for m in re.findall(r"""(?:href|src|HREF|SRC)=["']?[A-Za-z][A-Za-z0-9+.-]*://([^/?#"'\s<>]+)""", h or "") if host else []:
            if low(m) != host:
                w[(host, low(m))] += 1
    hosts = {x[1] for x in split if x[1]} | {d for _, d in w}
    for h in {".".join(h.split(".")[k:]) for h in hosts for k in range(len(h.split(".")))}:
        if "." in h and h.split(".", 1)[1]:
            w[(h, h.split(".", 1)[1])] += 1
            w[(h.split(".", 1)[1], h)] += 1

    def walk(edges, seed):
        if not sum(seed.values()):
            return {}
        out = defaultdict(float)
        for (s, _), x in edges.items():
            out[s] += x
        start = {h: x / sum(seed.values()) for h, x in seed.items() if x}
        r = dict(start)
        for _ in range(rounds):
            n = defaultdict(float)
            for (s, d), x in edges.items():
                n[d] += damping * r.get(s, 0) * x / out[s]
            for h, x in start.items():
                n[h] += (1 - damping) * x
            r = n
        return r

    good, bad = defaultdict(float), defaultdict(float)
    for _, host, _, (_, v), _ in split:
        if host:
            good[host] += v == "allow"
            bad[host] += v == "block"
    t, d = walk(w, good), walk({(b, a): x for (a, b), x in w.items()}, bad)
    return {i: (host, path, r, v or ("block" if round(d.get(host, 0), 12) > round(t.get(host, 0), 12) else "allow"),
                t.get(host, 0), d.get(host, 0)) for i, host, path, (r, v), _ in split}


def test_brute_force(spark):
    rows = [(i, u, HTML.get(i, "<p>")) for i, u in enumerate(URLS)]
    want = brute(rows)
    got = {r.page_id: r for r in filter_urls(pages(spark), RULES).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert (r.host, r.path, r.rule, r.verdict) == want[i][:4], URLS[i]
        assert (r.trust, r.distrust) == pytest.approx(want[i][4:], abs=1e-11)
    assert got[7].verdict == "block" and got[6].verdict == "allow" and got[11].rule is None and got[12].rule == "com/"


def test_edges_are_counted(spark):
    e = {(r.src, r.dst): r.weight for r in host_edges(pages(spark).withColumnRenamed("host", "h").selectExpr("'b.com' as host", "html")).collect()}
    assert e[("b.com", "good.org")] == 3 and e[("b.com", "com")] == 1 and ("b.com", "b.com") not in e


def test_odd_inputs(spark):
    assert filter_urls(pages(spark, []).limit(0), RULES).collect() == []
    none = filter_urls(pages(spark), []).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.rule for r in none} == {None}
    same = [(None, "http://x.net/es/", "z" * 300_000)] * 3
    assert [r.verdict for r in filter_urls(pages(spark, same), RULES).collect()] == ["block"] * 3
    with pytest.raises(ValueError):
        filter_urls(pages(spark), [("maybe", "com/")])


def test_native_plan(spark):
    text = filter_urls(pages(spark), RULES)._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_mass_is_bounded(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 3.0)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("a", 2.0, 0.0), ("c", 0.0, 1.0)], "host string, good double, bad double")
    got = propagate(edges, seeds, rounds=8, write_every=3).collect()
    assert sum(r.trust for r in got) <= 1 + 1e-9 and sum(r.distrust for r in got) <= 1 + 1e-9
