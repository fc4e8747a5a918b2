import hashlib
import struct
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from corpus_fixture import corpus, table

from ridewise.llm import quality_classifier as q
from ridewise.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    return q.train(docs, labels), docs, labels


def plain_model(rows, labels):
    """A text's score, by the definition: plain loops over ``(id, text)`` and ``(id, quality)``."""
    seen = {}
    for i, y in labels:
        if i is not None and y in (0, 1) and zlib.crc32(str(i).encode()) % 5:
            seen.setdefault(i, set()).add(y)
    label = {i: min(y) for i, y in seen.items() if len(y) == 1}
    count = [sum(y == c for y in label.values()) for c in (0, 1)]
    share = (count[1] + 0.5) / (sum(count) + 1)

    def draw(i, n):
        x = xxhash.xxh64_intdigest(struct.pack("<i", n), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
        return x - (x >> 63 << 64)

    picked = {i for c in (0, 1) for i in sorted((i for i, y in label.items() if y == c), key=lambda i: (draw(i, 1), i))[:4000]}
    used = [(label[i], t, draw(i, 2) % 2 == 0) for i, t in rows if i in picked and t is not None]
    tools = []
    for size, dict_size in q.SCALES:
        pair = []
        for c in (1, 0):
            parts = [t.encode()[k:k + size] for y, t, curve in used if y == c and not curve for k in range(0, len(t.encode()), size)]
            parts.sort(key=lambda x: (int.from_bytes(hashlib.blake2b(x, digest_size=7).digest(), "little"), x))
            parts = parts[:min(6000, (16 << 20) // size)]
            n = sum(map(len, parts))
            few = n < 8192 or len(parts) < 8
            raw = None if few else zstandard.train_dictionary(min(dict_size, n // 4), parts, d=8, k=256).as_bytes()
            extra = {} if few else {"dict_data": zstandard.ZstdCompressionDict(raw)}
            if extra:
                extra["dict_data"].precompute_compress(level=3)
            pair.append(zstandard.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, **extra))
        tools.append((size, pair))

    def d(text):
        raw = text.encode()
        return sum((sum(len(bad.compress(raw[k:k + size])) for k in range(0, len(raw), size))
                    - sum(len(good.compress(raw[k:k + size])) for k in range(0, len(raw), size))) / len(raw)
                   for size, (good, bad) in tools) / len(tools)

    curve = sorted((d(t), y) for y, t, c in used if c and t)
    x, y = np.array([a for a, _ in curve]), np.array([b for _, b in curve], dtype=float)
    w = np.where(y == 1, count[1] / max((y == 1).sum(), 1), count[0] / max((y == 0).sum(), 1))
    places = sorted(set(x))
    wx = np.array([w[x == p].sum() for p in places])
    wy = np.array([(w * y)[x == p].sum() for p in places])
    sw, sy = np.r_[0, np.cumsum(wx)], np.r_[0, np.cumsum(wy)]
    n = len(places)
    mean = [[(sy[k + 1] - sy[j]) / (sw[k + 1] - sw[j]) for k in range(j, n)] for j in range(n)]
    least = [np.minimum.accumulate(m[::-1])[::-1] for m in mean]                     # over the ends from k on
    iso = np.array([max(least[j][k - j] for j in range(k + 1)) for k in range(n)])   # the min-max formula of monotone regression
    pools = [np.flatnonzero(np.isclose(iso, v, rtol=0, atol=1e-12)) for v in sorted(set(iso.round(12)))]
    knots = [(np.average(np.array(places)[p], weights=wx[p]), iso[p].mean()) for p in pools]
    return lambda text: float(np.interp(d(text), *zip(*knots))) if text else share


def test_scores_equal_the_plain_version(spark, fitted):
    model, docs, labels = fitted
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    plain = plain_model(rows, [(r.doc_id, r.quality) for r in labels.collect()])
    got = q.score(docs, model, keep={"doc_id": docs["doc_id"]}).collect()
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - plain(text[r.doc_id])) < 1e-9


def test_curve_is_monotone():
    x, y = np.array([3.0, 1.0, 1.0, 2.0, 4.0, 5.0]), np.array([1.0, 0.0, 1.0, 0.0, 0.0, 1.0])
    knots = q.fit_curve(x, y, np.ones(6))
    assert knots == ((4 / 3, 1 / 3), (3.5, 0.5), (5.0, 1.0))


def test_null_ids(spark):
    df = table(spark).selectExpr("cast(null as long) as doc_id", "text")
    labels = spark.createDataFrame([(None, 1), (None, 0)], "doc_id long, quality int")
    assert {r.score for r in q.score(df, q.train(df, labels)).collect()} == {0.5}
    assert {r.h for r in df.select((q.fold("doc_id") == 0).alias("h")).collect()} == {None}


def test_held_out_accuracy(spark, fitted):
    """sf0.01 has 399 labelled rows, 58 of them bad; a fifth is held out."""
    model, docs, labels = fitted
    rows = {r.doc_id: r for r in QUERIES["op3_quality_classifier"](spark, SF01).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(rows[x.doc_id].score, x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.93
    assert np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([(s >= 0.3) == y for s, y in held]) > 0.93


def test_held_out_labels_are_not_read(spark, fitted):
    model, docs, labels = fitted
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(q.fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert q.train(docs, flipped) == model


def test_whole_texts_and_empty_ones(spark, fitted):
    model = fitted[0]
    text = "plain words and more of them " * 2000
    assert q.size_difference(text, model) != q.size_difference(text + "junk&&& $$$ ### " * 300, model)
    assert b"".join(q.blocks(text.encode(), 512)) == text.encode()
    df = table(spark)
    out = q.score(df, model, keep={"doc_id": df["doc_id"], "kept": df["kept"]}).collect()
    assert len(out) == len(corpus())
    for r in out:
        if r.doc_id == 81:
            assert r.difference == 0 and r.n_bytes == 0 and r.score == model.prior
    assert q.score(df.limit(0), model).collect() == []


def test_few_labels(spark):
    df = table(spark)
    one = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.score > 0.9 for r in q.score(df, q.train(df, one)).collect()} == {True}
    none = q.train(df, one.limit(0))
    assert {r.score for r in q.score(df, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7), (6, 1), (7, 0)], "doc_id long, quality int")
    assert 0 < q.train(df, odd).prior < 1


def test_keep_good_keeps_columns(spark, fitted):
    model, docs, labels = fitted
    kept = q.keep_good(docs.selectExpr("*", "doc_id as score", "text as n_bytes"), labels)
    assert kept.columns == [*docs.columns, "score", "n_bytes"]
    assert 0 < kept.count() < docs.count() and kept.where("score <> doc_id").count() == 0
