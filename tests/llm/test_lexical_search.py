"""Ranked lexical search against the formula over every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from corpus_fixture import corpus, key, table, words

from ridewise.llm.lexical_search import Segment, _Stats, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def plain_terms(text):
    return [lower(t) for t in TERM.findall(text or "")]


def brute(rows, items, k, b=90):
    held = [(i, Counter(plain_terms(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in held)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, c in held:
            m = 100 - b + (b * sum(c.values()) * n_docs) // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scored.append((-s, key(i)))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def queries():
    rng = random.Random(3)
    out = [(i, " ".join(words(rng, rng.choice([1, 3, 12, 40])))) for i in range(25)]
    return out + [(25, None), (26, ""), (27, "..."), (28, "NOT there"), (None, "the of x1"), (29, "the the THE The"), (30, "the"),
                  (30, "of and in"), (31, "tschüß 😀 12a"), (1, out[1][1])]


def result(df):
    order = lambda r: (str(r[0]), r[1], r[2], r[3])
    return sorted(((r.item_id, r["rank"], key(r.doc_id), r.score) for r in df.collect()), key=order)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, score string")


def test_terms():
    for _, t in corpus() + [(0, "A_b-C9é£ x\u0000y\x7fz\u0080w ÀB K ſ")]:
        assert [x.decode() for x in terms_of((t or "").encode())] == plain_terms(t)


def test_search_equals_brute_force(spark):
    rows, asked = corpus(), queries()
    docs = table(spark, rows).repartition(3)
    order = lambda r: (str(r[0]), *r[1:])
    for k, kw in ((10, {}), (10, {"segment_postings": 40}), (3, {"segment_postings": 7, "block_bytes": 900}), (1000, {"block_bytes": 2000})):
        got = search(docs, items(spark, asked), k, **kw)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert result(got) == sorted(brute(rows, asked, k), key=order), (k, kw)


def test_accumulators_stop_and_nothing_is_lost():
    rng = np.random.default_rng(1)
    docs, vocabulary = 3000, 60
    held = rng.random((docs, vocabulary)) < np.geomspace(0.004, 0.9, vocabulary)
    tf = np.where(held, rng.integers(1, 6, (docs, vocabulary)), 0)
    n = tf.sum(axis=1)
    df = np.maximum(held.sum(axis=0), 1)
    stats = _Stats(docs, int(n.sum()), 90)
    d, t = np.nonzero(tf)
    seg = Segment(np.arange(docs), np.zeros(docs, np.int64), n, held.sum(axis=1), t, tf[d, t], stats)
    weight = np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)
    m = 10 + (90 * n * docs) // int(n.sum())
    score = weight * ((10 ** 9 * tf) // (1000 * tf + 8 * m[:, None]))
    fewer = 0
    for _ in range(40):
        wanted = np.sort(rng.choice(vocabulary, 25, replace=False))
        wanted = wanted[np.argsort(df[wanted], kind="stable")]
        truth = score[:, wanted].sum(axis=1)
        for floor in (0, int(np.sort(truth)[-5])):
            at, got, made = seg.search(wanted, weight[wanted], 10, floor)
            assert np.array_equal(got, truth[at])
            kth = max(floor, np.sort(truth)[-10])
            assert set(np.flatnonzero(truth >= kth)) <= set(at)
            fewer += made < np.count_nonzero(truth)
    assert fewer > 40


def test_ties_and_repeated_rows(spark):
    rows = [(5, "a b"), (3, "a b"), (3, "a b"), (9, "A, b!"), (None, "b a"), (1, "c"), (1, "a c d e")]
    asked = [(1, "a b"), (2, "zz"), (3, "c")]
    assert result(search(table(spark, rows), items(spark, asked), 4)) == sorted(brute(rows, asked, 4), key=lambda r: (str(r[0]), *r[1:]))


def test_empty_tables(spark):
    none = items(spark, queries()).limit(0)
    assert search(table(spark, corpus()), none).collect() == []
    assert search(table(spark, corpus()).limit(0), items(spark, queries())).collect() == []
    assert search(table(spark, [(1, None), (2, "")]), items(spark, queries())).collect() == []
