"""Token ids inside tasks, with bounded caches of word encodings.

For a tokenizer that drops white space, lower-cases and splits words into runs
of letters, single digits and runs of other signs before its merges (``WORDWISE``
below), a text's ids are the ids of its white-space separated pieces in order.
Pieces are cut at ASCII white space only. A piece that is letters below U+0250
followed by ASCII punctuation, which most are, goes to the merges directly; any
other piece is encoded whole. Every other tokenizer encodes whole texts.
``tests/llm`` compares all of this with direct encoding.
"""

from __future__ import annotations

import functools
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHE_WORDS = 250_000
CHUNK = 2048

#: fixed values: normalizer and pre-tokenizer of a tokenizer that works word by word
WORDWISE = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                         {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})

#: letters, then ASCII punctuation other than the apostrophe
SIMPLE = re.compile(r"([^\W\d_]*)([!-&(-/:-@\[-`{-~]*)")
SIMPLE_ASCII = re.compile(rb"([A-Za-z]*)([!-&(-/:-@\[-`{-~]*)")
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}


def byte_letters() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: itself if
    printable, else the next one from 256 on."""
    rest = iter(range(256, 512))
    return [chr(b if b in PRINTABLE else next(rest)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def is_wordwise(tokenizer: Tokenizer) -> bool:
    conf = json.loads(tokenizer.to_str())
    return (conf["normalizer"], conf["pre_tokenizer"]) == WORDWISE


class Cache:
    """Two generations: a full one becomes the old one, and what is found there
    moves to the new one, so frequent keys survive."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def put(self, key, value):
        if len(self.new) >= self.limit:
            self.new, self.old = {}, self.new
        self.new[key] = value
        return value

    def get(self, key):
        found = self.new.get(key)
        if found is None and key in self.old:
            found = self.put(key, self.old[key])
        return found


class WordEncoder:
    """``encode_batch(texts)`` gives little-endian unsigned 32-bit arrays."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.tokenizer = load(path)
        self.wordwise = is_wordwise(self.tokenizer)
        self.model = self.tokenizer.model
        self.words, self.runs = Cache(cache_words), Cache(cache_words)
        self.letter = byte_letters()

    def _run(self, run: bytes) -> bytes:
        """Ids of one run of letters or signs, already lower-cased."""
        found = self.runs.get(run)
        if found is None:
            text = run.decode() if run.isascii() else "".join([self.letter[b] for b in run])
            found = self.runs.put(run, array("I", [t.id for t in self.model.tokenize(text)]).tobytes() if run else b"")
        return found

    def _simple(self, word: bytes) -> bytes | None:
        if word.isalpha():                             # bytes: A-Z and a-z only
            return self._run(word.lower())
        if word.isascii():
            m = SIMPLE_ASCII.fullmatch(word)
            return None if m is None else self._run(m[1].lower()) + self._run(m[2])
        text = word.decode()
        m = SIMPLE.fullmatch(text)
        if m is None or max(text) >= "\u0250":
            return None
        low = m[1].lower()
        if len(low) != len(m[1]) or not low.isalpha():
            return None
        return self._run(low.encode()) + self._run(m[2].encode())

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        out, hard = list(map(self.words.new.get, words)), []
        for k in [k for k, got in enumerate(out) if got is None]:
            w = words[k]
            got = self.words.old.get(w)
            if got is None:
                got = self._simple(w)
            if got is None:
                hard.append(k)
            else:
                out[k] = self.words.put(w, got)
        for lo in range(0, len(hard), CHUNK):       # an encoding object is far larger than its ids
            part = hard[lo:lo + CHUNK]
            for k, e in zip(part, self.tokenizer.encode_batch([words[k].decode() for k in part], add_special_tokens=False)):
                out[k] = self.words.put(words[k], array("I", e.ids).tobytes())
        return out

    def encode_batch(self, texts, end_id: int | None = None) -> list[np.ndarray]:
        """``texts``: a list or Arrow array; a null counts as empty. The words
        are numbered by Arrow, each distinct one is looked up once, and the
        ids are put together with array operations."""
        tail = np.array([] if end_id is None else [end_id], dtype="<u4")
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.wordwise:
            enc = self.tokenizer.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)
            return [np.concatenate([np.array(e.ids, dtype="<u4"), tail]) for e in enc]
        split = pc.ascii_split_whitespace(column.fill_null(""))
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        ids = self.ids_of(coded.dictionary.cast(pa.binary()).to_pylist())
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        first = np.cumsum(size) - size
        code = coded.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        upto = np.r_[0, np.cumsum(n)]
        joined = flat[np.arange(upto[-1]) + np.repeat(first[code] - upto[:-1], n)]
        cut = upto[ends]
        return [np.concatenate([joined[a:b], tail]) for a, b in zip(cut[:-1], cut[1:])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per Python worker; workers are reused between tasks."""
    return WordEncoder(path)


def slices(column, max_bytes: int = 4 << 20):
    """Cuts an Arrow string column into runs of rows of about ``max_bytes``."""
    start, size = 0, 0
    for i in range(len(column)):
        v = column[i]
        size += 0 if not v.is_valid else v.as_buffer().size
        if size >= max_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(column):
        yield start, len(column)
