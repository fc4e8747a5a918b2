import random

import numpy as np
import pytest
from corpus_fixture import corpus, key, split_words, table

from ridewise.llm.common import hash_words, kgram_hashes
from ridewise.llm.substring_dedup import anchor_positions, anchors, compact_paths, repeated_nodes, substring_dedup
from ridewise.llm.common import keyed


def brute(rows, window):
    first = {}
    docs = [(key(i), split_words(t)) for i, t in rows]
    for i, w in docs:
        for p in range(len(w) - window + 1):
            s = tuple(w[p:p + window])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, w in docs:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out)


def result(df, **kw):
    return sorted((r["__id"], r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(df, **kw).collect())


def test_brute_force(spark):
    rows = corpus()
    got = result(table(spark, rows))
    assert got == brute(rows, 50)
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_small_vocabulary(spark, seed):
    """Few words, short windows: periodic text, branches and copies within documents."""
    rng = random.Random(seed)
    part = [" ".join(rng.choice("ab") for _ in range(25)) for _ in range(4)]
    rows = [(i, " ".join(rng.choice([*part, "a " * 12, "c", "d e"]) for _ in range(rng.randrange(0, 6)))) for i in range(60)]
    for window, gram in ((8, 3), (10, 1), (12, 11)):
        assert result(table(spark, rows), window=window, seed=gram) == brute(rows, window)


def test_anchors_cover_every_window():
    rng = np.random.default_rng(0)
    words = [b"%d" % x for x in rng.integers(0, 12, 400)]
    g = kgram_hashes(hash_words(words), 4)
    at = set(anchor_positions(g, 4, 15).tolist())
    for p in range(len(words) - 14):
        assert at & set(range(p, p + 12))
    a = kgram_hashes(hash_words(words[50:90]), 4)      # equal words, equal anchors away from the ends
    inside = {x + 50 for x in anchor_positions(a, 4, 15).tolist()}
    assert inside <= at


def test_kgram_hash_depends_on_the_words_alone():
    h = hash_words([b"%d" % (i % 7) for i in range(60)])
    for k in (1, 2, 3, 5, 12, 50):
        g = kgram_hashes(h, k)
        assert len(g) == 61 - k and np.array_equal(g[:-7], g[7:]) and len(set(g.tolist())) == 7


def test_paths_compact(spark):
    """Copies of a document without other repeats are one path each."""
    rng = random.Random(5)
    text = " ".join(str(rng.random()) for _ in range(300))
    docs = keyed(spark.createDataFrame([(i, text) for i in range(3)] + [(9, "w " + " ".join(str(i) for i in range(99)))], "doc_id long, text string"))
    paths = compact_paths(repeated_nodes(anchors(docs)), 12).collect()
    assert len(paths) == 1 and paths[0]["__first"] == 0 and paths[0]["__len"] > 200


def test_empty_table_and_bad_seed(spark):
    assert result(table(spark, []).limit(0)) == []
    with pytest.raises(ValueError):
        substring_dedup(table(spark), window=50, seed=50)
