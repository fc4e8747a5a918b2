import random
import re

import numpy as np
import pytest
from corpus_fixture import corpus, key, table, words

from ridewise.llm import decontaminate as d
from ridewise.llm.decontaminate import contaminated, drop_contaminated, flag_documents, greedy_tiles, overlaps

ITEM = "item_id long, text string, extra string"


def naive_tiles(text, pattern, least):
    """Greedy string tiling by its definition: the longest unmarked match each time."""
    tm, pm, total = [0] * len(text), [0] * len(pattern), []
    while True:
        best = (0, 0, 0)
        for p in range(len(pattern)):
            for t in range(len(text)):
                n = 0
                while p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n] and not pm[p + n] and not tm[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        if best[0] < least:
            return total
        n, p, t = best
        pm[p:p + n] = tm[t:t + n] = [1] * n
        total.append(best)


def test_tiles_match_the_definition():
    rng = random.Random(3)
    for _ in range(60):
        pattern = [rng.randrange(6) for _ in range(rng.randrange(1, 30))]
        text = [rng.randrange(6) for _ in range(20)] + pattern[10:] + [9] + pattern[:10] + [rng.randrange(6) for _ in range(15)]
        a, b = np.array(text, np.uint64), np.array(pattern, np.uint64)
        got = greedy_tiles(a, b, 3)
        want = naive_tiles(text, pattern, 3)
        assert sorted(n for n, _, _ in got) == sorted(n for n, _, _ in want)
        used = [x for n, p, t in got for x in range(p, p + n)]
        assert len(used) == len(set(used)) and all(text[t:t + n] == pattern[p:p + n] for n, p, t in got)


def bench(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, 40)), "x") for i in range(12)]
    items += [(100, None, "x"), (None, "an item without an id but with words", "x"), (101, "short one", "x"), (102, "", None),
              (3, "a b c d e", "x")]
    return spark.createDataFrame(items, ITEM), [i[1] for i in items[:12]]


def planted(spark):
    b, items = bench(spark)
    rng = random.Random(12)
    w = items[5].split()
    rows = corpus() + [(200, "lead in " + items[0].upper() + "!"), (201, " ".join(w[20:]) + " between , " + " ".join(w[:20])),
                       (202, " ".join(words(rng, 5000)) + " " + items[7] + " " + items[8]), (203, " ".join(items[9].split()[:12])),
                       (None, items[10]), (204, items[11]), (204, items[11])]
    return table(spark, rows), b, rows


def test_planted(spark):
    df, b, rows = planted(spark)
    got = {}
    for r in flag_documents(df, b).collect():
        got.setdefault(r["__id"], []).append((r.contaminated, r["items"], round(r.coverage, 3)))
    assert sum(map(len, got.values())) == len(rows)
    assert got[200] == [(True, [0], 1.0)] and got[201] == [(True, [5], 1.0)] and got[202] == [(True, [7, 8], 1.0)]
    assert got[203][0][0] is False and got[204] == [(True, [11], 1.0)] * 2
    assert [x for x in got[key(None)] if x[0]] == [(True, [10], 1.0)]
    assert all(not x[0] for i, v in got.items() if 0 <= i < 200 for x in v)


def test_brute_force_and_blocks(spark):
    df, b, rows = planted(spark)
    tok = lambda t: re.findall(r"\w+", (t or "").lower())
    items = {}
    for r in b.collect():
        if r.item_id is not None and r.text is not None and len(tok(r.text)) >= len(items.get(r.item_id, [])):
            items[r.item_id] = tok(r.text)
    want = set()
    for i, t in rows:
        w = tok(t)
        if len(w) > 3000:
            continue
        for k, p in items.items():
            grams = {tuple(p[j:j + 5]) for j in range(len(p) - 4)}
            if any(tuple(w[j:j + 5]) in grams for j in range(len(w) - 4)):
                want.add((key(i), k, sum(n for n, _, _ in naive_tiles(w, p, 3))))
    for size in (32 << 20, 700):                  # one block, and several
        got = {(r["__id"], r.item_id, r.covered) for r in overlaps(df, b, block_bytes=size).collect() if r["__id"] not in (202, 91)}
        assert got == {x for x in want if x[0] not in (202, 91)}


def test_drop_keeps_columns_and_clean_rows(spark):
    df, b, rows = planted(spark)
    out = drop_contaminated(df, b)
    assert out.columns == df.columns and out.count() == len(rows) - 6
    assert out.where("doc_id between 200 and 202").count() == 0


def test_empty_tables(spark):
    df, b, rows = planted(spark)
    assert flag_documents(df.limit(0), b).collect() == []
    assert flag_documents(df, b.limit(0)).where("contaminated").count() == 0
    assert contaminated(df, b.where("item_id > 99")).count() == 0
    with pytest.raises(ValueError):
        overlaps(df, b, seed=3, min_match=4)


def test_index_is_small_and_whole():
    """32 MB of text must stay under 300 MB in a worker: at most 8 bytes of index a byte of text."""
    rng = random.Random(3)
    items = [(k if k % 7 else None, " ".join(rng.choice(("alpha", "beta", "of", "a", "gamma", "delta")) + str(rng.randrange(500))
                                              for _ in range(rng.choice((2, 6, 40, 300))))) for k in range(400)]
    index = d.SeedIndex(items, 5)
    assert index.nbytes < 8 * sum(len(t.encode()) for _, t in items)
    grams = [set(zip(*[t.lower().split()[i:] for i in range(5)])) for _, t in items]
    for _, text in items[::9]:
        mine = set(zip(*[text.lower().split()[i:] for i in range(5)]))
        assert index.candidates(d.word_hashes(text)) == [k for k, g in enumerate(grams) if g & mine]
    assert all(index.item(k)[0] == i and (index.item(k)[1] == d.word_hashes(t)).all() for k, (i, t) in enumerate(items))
    assert d.SeedIndex([], 5).candidates(d.word_hashes("one two three four five")) == []
