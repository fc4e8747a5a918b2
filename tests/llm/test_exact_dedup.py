import hashlib
import re
from collections import defaultdict

import pytest
from corpus_fixture import corpus, table

from ridewise.llm.exact_dedup import exact_dedup, merge_runs


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("parts,fan", [(1, 16), (7, 2), (40, 3)])
def test_brute_force(spark, parts, fan):
    rows = corpus()
    got = exact_dedup(table(spark, rows).repartition(parts), fan=fan).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    want = []
    for t, ids in groups.items():
        best = min((i for i in ids if i is not None), default=None)
        want += [(i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    order = lambda r: (r[3], r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=order) == sorted(want, key=order)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_empty_table_and_all_copies(spark):
    assert exact_dedup(table(spark, []).limit(0)).collect() == []
    got = exact_dedup(table(spark, [(i, "same") for i in range(50, 0, -1)]).repartition(9)).collect()
    assert {(r.keep_id, r.group_size, r.kept == (r.doc_id == 1)) for r in got} == {(1, 50, True)}


def test_disagreeing_second_hash_splits(spark):
    runs = spark.createDataFrame([(1, bytearray(b"d"), 3, 10, 0), (2, bytearray(b"d"), 3, 11, 1), (3, bytearray(b"d"), 3, 10, 2)],
                                 "__id long, __digest binary, __bytes int, __check long, __ord long")
    assert sorted((r["__best"].id, r["__copies"]) for r in merge_runs(runs).collect()) == [(1, 2), (2, 1)]


def test_bad_fan(spark):
    with pytest.raises(ValueError):
        exact_dedup(table(spark), fan=1)
