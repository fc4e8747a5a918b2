"""Every benchmark text is searched: several texts an id, and null ids."""

import random

from corpus_fixture import table, words

from ridewise.llm.decontaminate import drop_contaminated, flag_documents, overlaps


def cases(spark):
    rng = random.Random(21)
    a, b, c, d, e = (" ".join(words(rng, n)) for n in (40, 30, 30, 25, 35))
    bench = spark.createDataFrame([(1, a), (1, b), (1, c), (1, b), (None, d), (None, e), (2, None)], "item_id long, text string")
    docs = table(spark, [(10, "x " + a), (11, b + " y"), (12, c), (13, "z " + d), (14, e), (15, b + " " + d), (16, "nothing of it")])
    return docs, bench


def test_every_text_of_an_id_and_of_null_ids(spark):
    docs, bench = cases(spark)
    for size in (32 << 20, 150):                 # one block, and several
        got = {r["__id"]: (r.contaminated, r["items"], r.coverage) for r in flag_documents(docs, bench, block_bytes=size).collect()}
        assert got == {10: (True, [1], 1.0), 11: (True, [1], 1.0), 12: (True, [1], 1.0), 13: (True, [], 1.0), 14: (True, [], 1.0),
                       15: (True, [1], 1.0), 16: (False, [], 0.0)}
        assert [r.doc_id for r in drop_contaminated(docs, bench, block_bytes=size).collect()] == [16]


def test_block_count_does_not_change_the_pairs(spark):
    docs, bench = cases(spark)
    one, many = (sorted(map(str, overlaps(docs, bench, block_bytes=size).collect())) for size in (32 << 20, 150))
    assert one == many and len(one) == 7
