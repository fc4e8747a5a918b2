import zlib
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixture import corpus, key, table
from hypothesis import given, settings
from hypothesis import strategies as st

from ridewise.llm import token_records as tr
from ridewise.llm.packing import TournamentTree, first_fit_decreasing, pack_documents
from ridewise.llm.queries import END_ID, TOKENIZER
from ridewise.llm.tokens import WordEncoder, load
from ridewise.session import scratch_path


def direct(text):
    return load(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [END_ID]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab 'sSrΣſİ\t\n\x0b\x0c\r\x1c\x1d\x85\xa0\u2028\u3000é\u0301\u0344😀1<|>"),
                                  st.characters(codec="utf-8")), max_size=40), max_size=5))
def test_word_encoder_equals_direct_encoding(texts):
    enc = WordEncoder(TOKENIZER, cache_words=3)
    for _ in range(2):
        assert [x.tolist() for x in enc.encode_batch(texts, END_ID)] == [direct(t) for t in texts]


def test_every_letter_and_sign_of_the_fast_path():
    words = [chr(c) for c in range(33, 0x300)] + [chr(c) + "b" for c in range(33, 0x300)] + ["b" + chr(c) for c in range(33, 0x300)]
    words += ["can't", "it's.", "a_b", "_", "x--", "THE!!", "De%%%", "Straße,", "Ǆa", "ŉ.", "İx", "ΑΣ", "1a", "a1.", "...a", "a'"]
    words = [w for w in words if len(w.split()) == 1]
    assert [x.tolist() for x in WordEncoder(TOKENIZER).encode_batch(words)] == [direct(w)[:-1] for w in words]


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    enc = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" a  b\n c", None, "x"]
    assert not enc.wordwise
    assert [x.tolist() for x in enc.encode_batch(texts)] == [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_word_encoder_on_the_fixture():
    texts = [t for _, t in corpus()] + ["a <|endoftext|> b<|startoftext|>c"]
    assert [x.tolist() for x in WordEncoder(TOKENIZER).encode_batch(texts, END_ID)] == [direct(t) for t in texts]


def test_records_round_trip(spark):
    rows = corpus()
    for files, limit in ((1, 1 << 20), (7, 300)):
        path = scratch_path(spark, "records")
        man = tr.write_records(table(spark, rows), path, TOKENIZER, END_ID, files=files)
        assert man.agg({"records": "sum"}).first()[0] == len(rows)
        for seed in (None, 5):
            got = sorted(((r.start, r["__id"], r.n_tokens, np.frombuffer(r.ids, "<u4").tolist())
                          for r in tr.read_records(spark, path, limit, seed).collect()))
            assert [g[1] for g in got] == sorted(key(i) for i, _ in rows)         # ascending ids
            assert [g[0] for g in got] == list(np.cumsum([0] + [g[2] for g in got])[:-1])
            want = defaultdict(list)
            for i, t in rows:
                want[key(i)].append(direct(t))
            have = defaultdict(list)
            for _, i, _, ids in got:
                have[i].append(ids)
            assert {i: sorted(v) for i, v in have.items()} == {i: sorted(v) for i, v in want.items()}


def test_empty_table_has_no_records(spark):
    path = scratch_path(spark, "records")
    assert tr.write_records(table(spark, []).limit(0), path, TOKENIZER, END_ID).collect() == []


def test_checksums_catch_changes():
    data = tr.frame(7, np.arange(50, dtype=np.uint32), 2) + tr.frame(-1, np.arange(3, dtype=np.uint32), 2)
    assert [(i, x.tolist()) for i, x in tr.parse_frames(data, 2)] == [(7, list(range(50))), (-1, [0, 1, 2])]
    for at in (0, 9, 15, 40, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(tr.parse_frames(bytes(broken), 2))
    with pytest.raises(ValueError):
        list(tr.parse_frames(data[:-3], 2))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_tournament_tree_is_first_fit_decreasing(lengths):
    got = first_fit_decreasing(lengths, 50)
    room, want = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(50)
        want[i] = (b, 50 - room[b])
        room[b] -= lengths[i]
    assert got == want


def test_tree_is_full():
    t = TournamentTree(2, 10)
    assert [t.first_fit(6)[0], t.first_fit(6)[0], t.first_fit(4)] == [0, 1, (0, 6)]
    with pytest.raises(ValueError):
        t.first_fit(5)


@pytest.mark.parametrize("capacity,group_docs", [(4096, 1024), (64, 10)])
def test_packing(spark, capacity, group_docs):
    rows = corpus()
    got = pack_documents(table(spark, rows), TOKENIZER, END_ID, capacity, group_docs=group_docs).collect()
    want = defaultdict(int)
    for i, t in rows:
        ids = np.array(direct(t), "<u4")
        for s in range(0, len(ids), capacity):
            p = ids[s:s + capacity]
            want[(key(i), s, len(p), zlib.crc32(p.tobytes()), len(ids))] += 1
    have = defaultdict(int)
    seqs = defaultdict(list)
    for r in got:
        have[(r["__id"], r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
        seqs[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for pieces in seqs.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0] + [n for _, n in pieces])[:-1])
        assert sum(n for _, n in pieces) <= capacity


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pack_documents(docs, TOKENIZER, END_ID).groupBy("sequence_id").agg({"length": "sum"}).collect()
    fill = [r[1] for r in out]
    assert sum(fill) / (4096 * len(fill)) > 0.98


def test_packing_empty_table(spark):
    assert pack_documents(table(spark, []).limit(0), TOKENIZER, END_ID).collect() == []
