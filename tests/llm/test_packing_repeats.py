"""Repeated rows spread over the packing groups; unique rows keep theirs."""

from collections import Counter

from corpus_fixture import table
from pyspark.sql import functions as F

from ridewise.llm.common import keyed
from ridewise.llm.packing import pack_documents
from ridewise.llm.queries import END_ID, TOKENIZER


def test_repeated_rows_spread_over_groups(spark):
    rows = [(None, "a b c")] * 1500 + [(None, None)] * 700 + [(None, "")] * 300 + [(i, f"word {i}") for i in range(500)]
    got = pack_documents(table(spark, rows), TOKENIZER, END_ID, 64, group_docs=100).collect()
    assert len(got) == len(rows)
    groups = Counter(r.sequence_id >> 32 for r in got)
    assert len(groups) == 30 and max(groups.values()) < 200
    room = Counter()
    for r in got:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 64
    assert len({(r.sequence_id, r.offset) for r in got}) == len(rows)


def test_unique_rows_do_not_depend_on_the_split(spark):
    docs = table(spark, [(i, f"some words {i} " * (i % 9)) for i in range(400)])
    run = lambda n: sorted(map(tuple, pack_documents(docs.repartition(n), TOKENIZER, END_ID, 64, group_docs=50).collect()))
    one = run(1)
    assert one == run(7)
    want = {r["__id"]: r.g for r in keyed(docs).select("__id", F.pmod(F.xxhash64("__id", "__rk", F.lit(0)), F.lit(8)).alias("g")).collect()}
    assert {r[0]: r[5] >> 32 for r in one} == want
