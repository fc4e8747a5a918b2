"""Token counts against the library's own encoding."""

import public_tokenizers
import pytest
from corpus_fixture import corpus, key, table
from hypothesis import given, settings
from hypothesis import strategies as st

from ridewise.llm.token_counts import RUN, PreTokens, count_tokens
from ridewise.llm.tokens import load

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "ab 'sStréßªº²¼٣Σ\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 　­́ɏɐ😀1<|>\x00"
CUT = {p: PreTokens(p) for p in (BYTE, WORD)}


def direct(path, text):
    return len(load(path).encode(text or "", add_special_tokens=False).ids)


def by_pieces(path, text):
    found, special = CUT[path].profile(text)
    return special + sum(n * CUT[path].pieces(p) for p, n in found.items())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_add_up_to_the_encoding(path):
    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(st.text(st.one_of(st.sampled_from(SIGNS), st.characters(codec="utf-8")), max_size=30),
                              st.sampled_from(["<|endoftext|>", "<|endoftext|", " <|endoftext|> ", "'re", "  "])), max_size=6))
    def run(parts):
        text = "".join(parts)
        assert by_pieces(path, text) == direct(path, text)
    run()


def test_every_plain_character_between_letters_spaces_and_digits():
    for c in map(chr, range(0x260)):
        for text in (c, c * 2, f"a{c}b", f" {c} {c}", f"1{c}2", f"{c} a", f" {c}a", f"'{c}'s"):
            assert by_pieces(BYTE, text) == direct(BYTE, text), repr(text)


def test_vocabulary_entries_have_their_own_pieces():
    voc = CUT[BYTE].vocabulary
    assert len(voc) > 49_000 and min(voc.values()) == 1
    assert all(direct(BYTE, p) == n for p, n in list(voc.items())[::50] if len(CUT[BYTE]._cut(p)) == 1)


def test_long_texts_are_cut_before_spaces_only():
    for text in ("ab  cd\n\n" * (RUN // 3), "x" * (3 * RUN) + " y", " " * (2 * RUN) + "z", "Σ 1" * RUN, "a" * (RUN - 1) + "  b" * 9):
        assert by_pieces(BYTE, text) == direct(BYTE, text)


@pytest.mark.parametrize("path,block_bytes", [(BYTE, 8 << 20), (BYTE, 500), (WORD, 3000)])
def test_counts_of_the_fixture(spark, path, block_bytes):
    rows = corpus() + [(95, "a <|endoftext|> b<|endoftext|>"), (96, "Σας ΑΣ 12 ٣٤ ½")]
    got = count_tokens(table(spark, rows).repartition(3), path, block_bytes=block_bytes, remembered=block_bytes // 100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    order = lambda r: (key(r[0]), r[1], r[2])
    want = sorted(((i, len((t or "").encode()), direct(path, t)) for i, t in rows), key=order)
    assert sorted((tuple(r) for r in got.collect()), key=order) == want


def test_empty_table(spark):
    assert count_tokens(table(spark, corpus()).limit(0), BYTE).collect() == []


def test_other_kinds_of_tokenizer_are_refused():
    with pytest.raises(ValueError):
        PreTokens(public_tokenizers.path("piece_bpe_32k.model"))


def test_query(spark):
    from conftest import SF
    from ridewise.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_token_counts"](spark, SF).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        (i, len((t or "").encode()), direct(BYTE, t), direct(BYTE, t) > 1024) for i, t in docs.items()}
    assert len(got) == len(docs)
