import random
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixture import corpus, key, table, words

from ridewise.llm.components import components
from ridewise.llm.near_dedup import aligned_similarity, band, keep_one, labels, near_classes, sketch, word_hashes


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            cur = row[j]
            row[j] = prev + 1 if x == y else max(row[j], row[j - 1])
            prev = cur
    return row[-1]


def brute(rows, threshold=0.8):
    """Classes over all pairs, as a set of frozensets of row numbers."""
    docs = [word_hashes(t) for _, t in rows]
    lab = [labels(w) for w in docs]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = lab[i], lab[j]
            if np.array_equal(docs[i], docs[j]):
                ok = True
            elif not len(a) or not len(b) or min(len(a), len(b)) < threshold * max(len(a), len(b)):
                ok = False
            else:
                common = len(np.intersect1d(a, b))
                ok = common / (len(a) + len(b) - common) >= threshold - 1e-9
                if ok:
                    m = lcs(a.tolist(), b.tolist())
                    ok = m / (len(a) + len(b) - m) >= threshold - 1e-9
            if ok:
                par[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(key(rows[i][0]))
    return sorted(sorted(g) for g in groups.values())


def found(df, **kw):
    out = near_classes(df, **kw).collect()
    groups = defaultdict(list)
    for r in out:
        groups[r.class_id].append(r["__id"])
        assert r.class_id <= r["__id"]
    return out, groups


def test_brute_force(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] not in (91, 92)]
    out, groups = found(table(spark, rows))
    assert sorted(sorted(g) for g in groups.values()) == brute(rows)
    assert all(r.class_size == len(groups[r.class_id]) and r.kept == (r["__id"] == r.class_id) for r in out)


def test_leader_rounds_lose_nothing(spark):
    """A dense group, chains and a shared passage; ``spare=0`` forces the rounds."""
    rng = random.Random(4)
    base, rows = words(rng, 220), []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(99999)}"
        rows.append((i, " ".join(w)))
    chain = words(rng, 200)
    for i in range(120, 150):                      # each differs from the one before by one word
        chain[(i * 37) % 200] = f"c{i}"
        rows.append((i, " ".join(chain)))
    passage = " ".join(words(rng, 60))
    rows += [(i, " ".join(words(rng, 40)) + " " + passage) for i in range(150, 190)]
    want = brute(rows)
    for spare in (0.0, 100.0):
        _, groups = found(table(spark, rows), spare=spare)
        assert sorted(sorted(g) for g in groups.values()) == want


def test_odd_rows(spark):
    out, groups = found(table(spark))
    assert len(out) == len(corpus())
    by = defaultdict(list)
    for r in out:
        by[r["__id"]].append(r)
    assert len(by[92]) == 2 and by[92][0].class_id == by[92][1].class_id and all(r.kept for r in by[92])
    assert len({r.class_id for i in (81, 82, 83) for r in by[i]}) == 1        # no words at all
    assert len({r.class_size for r in by[91]}) == 1 and len(by[91]) == 2


def test_keep_one(spark):
    df = table(spark)
    out = keep_one(df)
    rows = out.collect()
    assert out.columns == df.columns and sum(r.doc_id == 92 for r in rows) == 1
    assert len([r for r in rows if r.doc_id is not None and 60 <= r.doc_id < 80]) == 1
    assert keep_one(df.limit(0)).collect() == []


def test_sketch_rate():
    """Agreement of a component is about J^ell, less if the order differs."""
    rng = np.random.default_rng(1)
    a = labels(rng.integers(0, 2 ** 62, 400).astype(np.uint64))
    b = a.copy()
    b[::9] = rng.integers(0, 2 ** 62, len(b[::9])).astype(np.uint64)      # J about 0.8
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    for ell in (1, 2, 6):
        rate = np.mean(sketch(a, ell, 2000, 3) == sketch(b, ell, 2000, 3))
        assert abs(rate - j ** ell) < 0.05
    turned = np.r_[b[200:], b[:200]]
    assert np.mean(sketch(a, 6, 2000, 3) == sketch(turned, 6, 2000, 3)) < 0.03
    assert np.array_equal(sketch(a, 6, 50, 3), sketch(a, 6, 50, 3, chunk=64))


def test_alignment_against_lcs():
    rng = random.Random(6)
    for _ in range(200):
        a = labels(np.array([rng.randrange(30) for _ in range(rng.randrange(1, 60))], np.uint64))
        b = list(a)
        for _ in range(rng.randrange(0, 4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(10 ** 6))
        if rng.random() < 0.3:
            b = b[len(b) // 2:] + b[:len(b) // 2]
        b = np.array(b, np.uint64)
        m = lcs(a.tolist(), b.tolist())
        s = m / (len(a) + len(b) - m)
        got = aligned_similarity(a, b, 0.8)
        assert got == pytest.approx(s) if s >= 0.8 else got < 0.8
    assert band(10, 100, 0.8) >= 0 and aligned_similarity(a[:0], a, 0.8) == 0.0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 201), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
