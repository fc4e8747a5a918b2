"""The pipeline against a brute-force version of every stage, each on its own input."""

import hashlib
import random
import re

import corpus_pipeline
import numpy as np
import test_decontaminate
import test_line_dedup
import test_near_dedup
import test_quality_classifier
from corpus_fixture import corpus, key, table, words

from ridewise.llm.near_dedup import word_hashes
from ridewise.session import scratch_path


def corpus_dir(spark, rows):
    d = scratch_path(spark, "sf")
    docs = table(spark, rows)
    docs.write.parquet(f"{d}/documents.parquet")
    rng = random.Random(9)
    bad = {i for i, t in rows if t and "&&&" in t}
    labels = [(i, 0 if i in bad else 1, 0) for i, t in rows if i is not None and i < 1000 and (i in bad or rng.random() < 0.5)]
    spark.createDataFrame(sorted(set(labels)), "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    test_decontaminate.bench(spark)[0].write.parquet(f"{d}/benchmark.parquet")
    return d, docs


def full_corpus(spark):
    rng = random.Random(21)
    items = test_decontaminate.bench(spark)[1]
    rows = [r for r in corpus() if r[0] != 91]
    rows += [(i, " ".join(w + rng.choice(["&&&", "$$$", "###"]) for w in words(rng, 60))) for i in range(300, 340)]
    rows += [(i, " ".join(words(rng, 60))) for i in range(400, 440)]
    rows += [(500, "before " + items[2] + " after"), (501, " ".join(words(rng, 9)) + " " + items[4])]
    return rows


def test_stages_against_brute_force(spark):
    rows = full_corpus(spark)
    d, docs = corpus_dir(spark, rows)
    cols = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, d)
        path = scratch_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == cols
    pairs = {k: ([(r.doc_id, r.text) for r in a.collect()], [(r.doc_id, r.text) for r in b.collect()])
             for k, (a, b) in seen.items() if k != "packing"}
    order = lambda x: (key(x[0]), x[1] or "")

    labelled = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect()]
    plain_score = test_quality_classifier.plain_model(pairs["quality"][0], labelled)
    keep = [r for r in pairs["quality"][0]
            if plain_score(r[1]) >= 0.3]
    assert sorted(pairs["quality"][1], key=order) == sorted(keep, key=order)
    left = {r[0] for r in pairs["quality"][1]}
    assert not left & set(range(300, 340)) and set(range(400, 440)) <= left

    a, b = pairs["line_dedup"]
    digest = sorted((i, s) for i, _, _, s in test_line_dedup.brute(a))
    assert sorted((key(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in b) == digest
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"][1].collect())

    a, b = pairs["near_dedup"]
    uniq = sorted(set(a), key=order)
    classes = test_near_dedup.brute(uniq)
    assert sorted(key(i) for i, _ in b) == sorted(min(c) for c in classes)

    a, b = pairs["decontamination"]
    tok = lambda t: re.findall(r"\w+", (t or "").lower())
    items = [tok(t) for t in test_decontaminate.bench(spark)[1]]
    clean = [r for r in a if all(sum(n for n, _, _ in test_decontaminate.naive_tiles(tok(r[1]), p, 3)) < 0.6 * len(p)
                                 for p in items if len(set(tok(r[1])) & set(p)) > 10)]
    assert sorted(b, key=order) == sorted(clean, key=order) and {500, 501} & {r[0] for r in a} and not {500, 501} & {r[0] for r in b}

    packed = seen["packing"][1].collect()
    assert sorted({key(r.doc_id) for r in packed}) == sorted({key(r[0]) for r in b})
    run = corpus_pipeline.run(spark, d).collect()
    assert sorted(map(str, run)) == sorted(map(str, packed))


def test_empty_documents(spark):
    d, _ = corpus_dir(spark, full_corpus(spark))
    empty = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, d).collect() == [], name


def test_words_of_a_copy_are_one_class():
    assert word_hashes("A b, c").tolist() == word_hashes("a B c!").tolist()
