"""Token counts without token ids.

A tokenizer that cuts a text into pre-tokens and encodes each by itself gives
as many ids as the pieces of those pre-tokens add up to. So:

1. Profile. Documents are read once, in blocks of about ``block_bytes`` of
   text. A block keeps its distinct pre-tokens and, per document, which of
   them occur how often; every block is one row of a written table. Special
   tokens count one id each, and pre-tokens that are themselves entries of the
   vocabulary (a table of fixed size) are summed right away.
2. Pieces. A block sends its other distinct pre-tokens, packed, to the buckets
   of their hashes. Equal pre-tokens of all blocks meet in one bucket, and there
   the pieces of each are counted once. However often a pre-token occurs in the
   corpus, it comes once from each block, and every block sends every bucket
   the same share, so no pre-token makes a bucket hot.
3. Join. The counts go back to their blocks.
4. Sum. Each block adds up count times pieces for its documents.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, shuffle_partitions
from ridewise.llm.tokens import Cache, byte_letters, load

BLOCK_BYTES = 32 << 20
#: pre-tokens a bucket remembers at least; a bucket with more distinct ones counts some again
REMEMBERED = 1 << 20
#: a text is cut into runs of about so many characters, always before white space
RUN = 1 << 16
#: below this code point the pattern is matched by ``re``; texts with letters beyond go to the library
PLAIN = 0x250
#: fixed values: white space among those code points
SPACE = "\t\n\x0b\x0c\r \x85\xa0"

BLOCKS = ("block long, doc_ids array<long>, n_bytes array<long>, known array<long>, ends array<int>, "
          "terms binary, counts binary, packs array<struct<bucket: int, pretokens: binary>>")


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind)


def byte_level_pattern() -> re.Pattern:
    """The byte-level pre-tokenizer's pattern for code points below ``PLAIN``."""
    letter, number = _class("L"), _class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
                      f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class PreTokens:
    """Pre-tokens of texts, and the number of pieces of a pre-token.

    For a byte-level tokenizer without a normalizer, a pre-token is the piece of
    the text itself; for others it is what their pre-tokenizer gives.
    """

    def __init__(self, path: str):
        if not path.endswith(".json"):
            raise ValueError("pre-tokens are known for tokenizers in .json files only")
        self.tokenizer = load(path)
        conf = json.loads(self.tokenizer.to_str())
        self.normalizer, self.cutter, self.model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        if self.cutter is None:
            raise ValueError("the tokenizer does not cut texts into pre-tokens")
        if any(t[k] for t in conf["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with matching options are not supported")
        marks = sorted((t["content"] for t in conf["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, marks))) if marks else None
        cut = conf["pre_tokenizer"]
        self.byte_level = (conf["normalizer"] is None and cut.get("type") == "ByteLevel"
                           and cut.get("use_regex") is True and cut.get("add_prefix_space") is False)
        self.pattern, self.beyond = byte_level_pattern(), re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")
        self.before_space = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
        self.letter = byte_letters()
        self.byte = {c: b for b, c in enumerate(self.letter)}

    @functools.cached_property
    def vocabulary(self) -> dict[str, int]:
        """Pieces of the pre-tokens that are entries of the vocabulary."""
        out = {}
        for entry in self.tokenizer.get_vocab():
            try:
                pre = self._raw(entry) if self.byte_level else entry
            except (KeyError, UnicodeDecodeError):        # an added token, or part of a character
                continue
            out[pre] = self.pieces(pre)
        return out

    def _raw(self, mapped: str) -> str:
        return bytes([self.byte[c] for c in mapped]).decode()

    def pieces(self, pre: str) -> int:
        if self.byte_level:
            pre = pre if pre.isascii() and pre.isalnum() else "".join([self.letter[b] for b in pre.encode()])
        return len(self.model.tokenize(pre))

    def _runs(self, text: str) -> Iterator[str]:
        """A pre-token never holds white space after other characters, so a text
        may be cut there."""
        at = 0
        while len(text) - at > RUN:
            cut = self.before_space.search(text, at + RUN)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _cut(self, text: str) -> list[str]:
        if not self.byte_level:
            if self.normalizer is not None:
                text = self.normalizer.normalize_str(text)
            return [p for p, _ in self.cutter.pre_tokenize_str(text)]
        if self.beyond.search(text) is None:
            return self.pattern.findall(text)
        return [self._raw(p) for p, _ in self.cutter.pre_tokenize_str(text)]

    def profile(self, text: str) -> tuple[Counter, int]:
        """How often each pre-token occurs, and the number of special tokens."""
        parts = self.special.split(text) if self.special is not None else [text]
        found = Counter()
        for part in parts:
            for run in self._runs(part) if self.byte_level else (part,):
                if run:
                    found.update(self._cut(run))
        return found, len(parts) - 1


@functools.lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    """One per Python worker; workers are reused between tasks."""
    return PreTokens(path)


def _pack_ints(values: np.ndarray) -> bytes:
    """32-bit integers, byte planes one after another, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pack_strings(parts: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, parts), dtype="<u4", count=len(parts)).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(parts).to_bytes(4, "little") + sizes + b"".join(parts))


def _unpack_strings(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    cut = [4 + 4 * n, *ends.tolist()]
    return [data[a:b] for a, b in zip(cut[:-1], cut[1:])]


class _Block:
    """Documents of one block: distinct pre-tokens and a sparse table of counts."""

    def __init__(self):
        self.ids, self.bytes, self.known, self.ends = [], [], [], []
        self.terms, self.counts, self.number, self.size = array("i"), array("i"), {}, 0

    def add(self, doc_id, text: str, n_bytes: int, cut: PreTokens) -> None:
        found, known = cut.profile(text)
        number, vocabulary = self.number, cut.vocabulary
        for pre, n in found.items():
            pieces = vocabulary.get(pre)
            if pieces is None:
                self.terms.append(number.setdefault(pre, len(number)))
                self.counts.append(n)
            else:
                known += n * pieces
        self.ids.append(doc_id)
        self.bytes.append(n_bytes)
        self.known.append(known)
        self.ends.append(len(self.terms))
        self.size += n_bytes

    def _packs(self, buckets: int) -> tuple[list[dict], np.ndarray]:
        """Pre-tokens by bucket, and the place of each old number in that order."""
        pre = [p.encode() for p in self.number]
        at = sorted(((zlib.crc32(p) % buckets, p, k) for k, p in enumerate(pre)))
        place = np.empty(len(pre), dtype=np.int64)
        place[[k for _, _, k in at]] = np.arange(len(pre))
        bucket = np.array([x[0] for x in at], dtype=np.int64)
        cut = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(at)] if at else [0]
        return [{"bucket": at[a][0], "pretokens": _pack_strings([p for _, p, _ in at[a:b]])}
                for a, b in zip(cut[:-1], cut[1:])], place

    def row(self, block: int, buckets: int) -> pa.RecordBatch:
        packs, place = self._packs(buckets)
        ends = np.array(self.ends, dtype=np.int64)
        doc = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
        terms = place[np.frombuffer(self.terms, np.int32)] if len(self.terms) else np.empty(0, np.int64)
        order = np.lexsort((terms, doc))
        counts = np.frombuffer(self.counts, np.int32)[order] if len(terms) else np.empty(0, np.int32)
        steps = np.diff(np.r_[0, terms[order]])                # rising within a document
        one = lambda v, t: pa.array([v], pa.list_(t))
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), one(self.ids, pa.int64()), one(self.bytes, pa.int64()), one(self.known, pa.int64()),
             one(ends.astype(np.int32), pa.int32()), pa.array([_pack_ints(steps)], pa.binary()),
             pa.array([_pack_ints(counts)], pa.binary()),
             one(packs, pa.struct([("bucket", pa.int32()), ("pretokens", pa.binary())]))],
            names=["block", "doc_ids", "n_bytes", "known", "ends", "terms", "counts", "packs"])


def _block_rows(path: str, block_bytes: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, block = pre_tokens(path), _Block()
        at = TaskContext.get().partitionId() << 32
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                block.add(i, text.as_py() or "", text.as_buffer().size if text.is_valid else 0, cut)
                if block.size >= block_bytes:
                    yield block.row(at, buckets)
                    block, at = _Block(), at + 1
        if block.ids:
            yield block.row(at, buckets)
    return run


def _piece_rows(path: str, remembered: int):
    """Rows (block, bucket, pretokens), those of a bucket together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, bucket, cache = pre_tokens(path), None, Cache(remembered)
        for b in batches:
            out = []
            for k, packed in zip(b.column(1).to_pylist(), b.column(2)):
                if k != bucket:
                    bucket, cache = k, Cache(remembered)
                got = []
                for p in _unpack_strings(packed.as_py()):
                    n = cache.get(p)
                    got.append(cache.put(p, cut.pieces(p.decode())) if n is None else n)
                out.append(_pack_ints(np.array(got)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             names=["block", "bucket", "pieces"])
    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in range(b.num_rows):
            ids, n_bytes, known, ends = (b.column(c)[r].values for c in range(4))
            steps, counts = (_unpack_ints(b.column(c)[r].as_py()) for c in (4, 5))
            total = known.to_numpy(zero_copy_only=False).copy()
            if len(steps):
                value = np.concatenate([_unpack_ints(x) for x in b.column(6)[r].as_py()])
                terms = np.cumsum(steps.astype(np.uint32).view(np.int32).astype(np.int64))
                upto = np.r_[0, np.cumsum(value[terms] * counts)]
                cut = np.r_[0, ends.to_numpy()]
                total += upto[cut[1:]] - upto[cut[:-1]]
            yield pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES, remembered: int = REMEMBERED) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes`` (UTF-8) and ``n_tokens``, as
    the library of the tokenizer in ``path`` gives them without added tokens.

    * null or empty text: no bytes, no tokens; null id: stays null
    * repeated rows, and rows with one id: counted each by itself
    * very long texts: a block of their own, pre-tokens found run by run
    * special strings inside texts: one token each, the library's default
    * empty table: empty result; other columns are not read
    * ValueError for a tokenizer that does not work on separate pre-tokens
    """
    pre_tokens(path)
    if block_bytes < 1:
        raise ValueError("block_bytes must be positive")
    n = shuffle_partitions(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    blocks = cut_lineage(docs.mapInArrow(_block_rows(path, block_bytes, n), BLOCKS), "token-profiles")
    pieces = (blocks.select("block", F.explode("packs").alias("p")).select("block", "p.bucket", "p.pretokens")
                    .repartition(n, "bucket").sortWithinPartitions("bucket")
                    .mapInArrow(_piece_rows(path, remembered), "block long, bucket int, pieces binary"))
    found = (pieces.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "pieces"))).alias("got"))
                   .select("block", F.col("got.pieces").alias("pieces")))
    return (blocks.drop("packs").join(found, "block", "left")
                  .select("doc_ids", "n_bytes", "known", "ends", "terms", "counts", "pieces")
                  .mapInArrow(_sum_rows, "doc_id long, n_bytes long, n_tokens long"))
