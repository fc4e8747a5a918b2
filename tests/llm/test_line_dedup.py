import hashlib
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixture import WS, corpus, key, table

from ridewise.llm.line_dedup import dedup_lines, keep_lines, line_bitmaps, line_digests, line_key, pack_bitmap, unpack_bitmap

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    docs = defaultdict(set)
    norm = lambda x: x.strip(WS).translate(UP)
    for i, t in rows:
        for x in (t or "").split("\n"):
            docs[norm(x)].add(key(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(norm(x)) < min_chars or len(docs[norm(x)]) < min_docs or max(docs[norm(x)]) == key(i)]
        out.append((key(i), len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 8, 61])
def test_brute_force(spark, parts):
    rows = corpus()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = line_digests(table(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted((key(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == brute(rows)
    assert sum(r.n_dropped for r in got) > 5


def test_hot_line_over_many_partitions(spark):
    """One key fills most rows, so it spans range partitions, as first and as last key."""
    rows = [(i, "\n".join(["the hot line of this whole corpus"] * (1 + i % 3) + [f"line {i % 40} that a few documents do share"]))
            for i in range(400)]
    for parts in (5, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = line_digests(table(spark, rows)).collect()
        assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == brute(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_other_columns_stay(spark):
    df = table(spark)
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "__n_lines", "__n_dropped"]
    assert out.where("score = 0.5 and starts = 's' and n_lines = 3").count() == df.count()


def test_bitmaps(spark):
    b = pack_bitmap(11, [0, 7, 10])
    assert list(np.flatnonzero(~unpack_bitmap(b, 11))) == [0, 7, 10]
    assert keep_lines("a\nb\nc", pack_bitmap(3, [1])) == "a\nc"
    for r in line_bitmaps(table(spark)).collect():
        assert (~unpack_bitmap(r.keep_bitmap, r.n_lines)).sum() == r.n_dropped > 0


def test_empty_table(spark):
    assert line_digests(table(spark, []).limit(0)).collect() == []


def test_key():
    assert line_key(" \tÄB C\x0b".encode()) == "Äb c".encode()
