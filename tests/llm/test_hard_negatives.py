"""Hard negatives against scores of all pairs."""

import math
import random

import numpy as np
import pytest

from ridewise.llm.hard_negatives import Best, Block, mine

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, q string"


def vectors(seed=5, n=260, dims=12, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    out = []
    for i in range(n):
        lab = int(rng.integers(labels))
        v = (0.7 * centre[lab] + rng.normal(size=dims) * rng.choice([0.2, 0.6])).astype(np.float32)
        out.append((i, [float(x) for x in v], lab))
    hot = out[10][1]
    out += [(300 + i, list(hot), 1 + i % 2) for i in range(40)]                        # ties
    out += [(50, out[50][1], out[50][2]), (20, out[20][1], 3), (20, out[20][1], 3)]    # repeated rows, one id twice
    out += [(1000, None, 1), (1050, [None] + [0.5] * (dims - 1), 2), (1100, [float("nan")] * dims, 2),
            (1150, [float("inf")] + [0.1] * (dims - 1), 2), (1200, [0.5] * dims, None), (None, [0.5] * dims, 1),
            (1250, [0.0] * dims, 1), (1300, [], 1), (1350, [0.4] * 3, 0), (-50, [-0.3] * dims, 2), (1400, [0.3] * dims, 99)]
    return out


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, lab) in enumerate(ok):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, b) for b, (j, w, _) in enumerate(ok) if b != a)
        pos = [(s, j) for s, j, b in scored if ok[b][2] == lab][:positives]
        for s, j in pos:
            hit = [(t, k) for t, k, b in scored if ok[b][2] != lab and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(hit, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 0.1, 1, "x") for i, v, lab in rows], SCHEMA)


def test_mining_equals_all_pairs(spark):
    rows = vectors()
    df = frame(spark, rows).repartition(3)
    got = mine(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert result(got) == brute(rows) and len(brute(rows)) > 50
    assert result(mine(df, every=10, positives=8, negatives=2, low=70, high=90, block_rows=17, anchor_rows=20)) \
        == brute(rows, 10, 8, 2, 70, 90)


def test_scores_below_zero_and_zero(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 1.0]) for _ in range(3)], i % 2) for i in range(60)]
    rows += [(60 + i, [-x for x in rows[0][1]], 0) for i in range(3)]
    assert result(mine(frame(spark, rows), every=5)) == brute(rows, 5)


def _block(q, labels):
    n, dims = q.shape
    lists = np.argsort(q, axis=0, kind="stable").T.astype(np.int32)
    ids = np.arange(n, dtype=np.int64)
    return Block(n, dims, *(np.ascontiguousarray(x).tobytes() for x in (ids, ids, labels.astype(np.int64), q.astype(np.int64), lists)))


def test_threshold_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(3)
    q = np.floor(256 * rng.normal(size=(4000, 3))).astype(np.int64)
    block, read = _block(q, rng.integers(0, 3, 4000)), []
    for a in range(0, 4000, 200):
        best = Best(5)
        read.append(block.search(q[a], a, lambda rows: block.labels[rows] == 1, [best]))
        s = q @ q[a]
        want = sorted((-s[j], j) for j in np.flatnonzero(block.labels == 1) if j != a)[:5]
        assert list(zip(-best.score, best.id)) == want
    assert np.mean(read) < 2500


def test_large_components_are_exact_or_refused():
    q = np.array([[2 ** 27, 3], [2 ** 27 - 1, 5], [7, 2 ** 27]])
    best, block = Best(2), _block(q, np.zeros(3))
    block.search(q[0], 0, lambda rows: rows >= 0, [best])
    assert best.score.tolist() == [2 ** 27 * (2 ** 27 - 1) + 15, 7 * 2 ** 27 + 3 * 2 ** 27]
    big = _block(np.array([[2 ** 40, 1]]), np.zeros(1))
    with pytest.raises(ArithmeticError):
        big.search(np.array([2 ** 40, 1]), -1, lambda rows: rows >= 0, [Best(2)])


def test_empty_tables(spark):
    df = frame(spark, vectors())
    assert mine(df.limit(0)).collect() == []
    assert mine(frame(spark, [(50, None, 1)])).collect() == []
    assert mine(frame(spark, [(50, [1.0], 1)])).collect() == []
