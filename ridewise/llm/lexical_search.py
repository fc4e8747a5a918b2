"""Ranked lexical search, accumulator-limited, term at a time.

1. Postings. One scan of the documents writes, per document, its length and the
   query terms it holds with their frequencies. Queries are taken in blocks of
   at most ``block_bytes`` of text (measured first); a block's terms are the
   only thing sent to the tasks, and every block meets every document.
2. Statistics. Number of documents, total length and document frequencies are
   sums over that table, and so cover all documents.
3. Search. A task reads documents in segments of about ``segment_postings``
   postings, inverts a segment and takes each query's terms one at a time,
   rarest first, adding term scores to accumulators. Before a term is read, the
   best that the terms still to come could add up to is known. Once that is
   below the k-th best partial score (or the k-th best score of the segments
   before), no further document can enter, and no accumulator is created any
   more; those that exist are updated with all remaining terms, exactly.
4. Merge. A task hands on ``k`` documents a query; the best ``k`` of all tasks
   are the result.

Scores are integers. A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``;
a document's ``m`` is ``100 - b + (b n N) div L``; its score is the sum of
``w ((1000000000 tf) div (1000 tf + 8 m))`` over the query's distinct terms.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import NULL_ID, cut_lineage

#: digits, letters and all bytes of code points beyond ASCII; A-Z become a-z, everything else a space
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
POSTINGS = "doc_id long, hash long, n long, terms array<int>, tfs array<int>"
HITS = "item_id long, item_hash long, doc_id long, hash long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters and digits (UTF-8), A-Z lower-cased."""
    return text.translate(TERM_BYTES).split()


def _posting_rows(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = vocabulary.value
        wanted = number.keys()
        for b in batches:
            n, terms, tfs, ends = [], [], [], [0]
            for text in b.column(2):
                words = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                found = Counter(words)
                for t in found.keys() & wanted:
                    terms.append(number[t])
                    tfs.append(found[t])
                n.append(len(words))
                ends.append(len(terms))
            off = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.ListArray.from_arrays(off, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(off, pa.array(tfs, pa.int32()))], names=["doc_id", "hash", "n", "terms", "tfs"])
    return run


class Segment:
    """An inverted list per term over a bounded run of documents."""

    def __init__(self, ids, hashes, n, lengths, terms, tfs, stats):
        self.ids, self.hashes = ids, hashes
        m = 100 - stats.b + (stats.b * n * stats.documents) // max(stats.length, 1)
        doc = np.repeat(np.arange(len(ids)), lengths)
        order = np.argsort(terms, kind="stable")
        tf = tfs[order].astype(np.int64)
        self.doc = doc[order]
        self.share = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        self.term, first = np.unique(terms[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.most = np.maximum.reduceat(self.share, first) if len(first) else np.empty(0, np.int64)

    def search(self, wanted: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of documents that can be among the best ``k``,
        given that ``k`` others have reached ``floor`` already; and the number
        of accumulators. ``wanted``: terms, rarest first."""
        at = np.searchsorted(self.term, wanted)
        at[at == len(self.term)] = 0
        here = (self.term[at] == wanted) & (weight > 0) if len(self.term) else np.zeros(len(wanted), bool)
        at, w = at[here], weight[here]
        ahead = np.cumsum((w * self.most[at])[::-1])[::-1]         # most that this and later terms can add
        total = np.zeros(len(self.ids), dtype=np.int64)
        alive = None
        for j, t in enumerate(at):
            doc, part = self.doc[self.first[t]:self.first[t + 1]], self.share[self.first[t]:self.first[t + 1]]
            if alive is None:
                if ahead[j] < max(floor, _kth(total, k)):
                    alive = total > 0
                else:
                    total[doc] += w[j] * part
                    continue
            keep = alive[doc]
            total[doc[keep]] += w[j] * part[keep]
        made = int(np.count_nonzero(total if alive is None else alive))
        best = np.flatnonzero(total >= max(floor, _kth(total, k), 1))
        return best, total[best], made


def _kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, -k)[-k]) if len(values) >= k else 0


class _Stats:
    def __init__(self, documents: int, length: int, b: int):
        self.documents, self.length, self.b = documents, length, b


def _search_rows(items, stats: _Stats, k: int, segment_postings: int):
    def segments(batches):
        held, size = [], 0
        for b in batches:
            flat = [b.column(c).flatten().to_numpy() for c in (3, 4)]
            held.append((*(b.column(c).to_numpy(zero_copy_only=False) for c in range(3)),
                         np.diff(b.column(3).offsets.to_numpy()), *flat))
            size += len(flat[0])
            if size >= segment_postings:
                yield Segment(*map(np.concatenate, zip(*held)), stats)
                held, size = [], 0
        if held:
            yield Segment(*map(np.concatenate, zip(*held)), stats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = items.value
        best = [(np.empty(0, np.int64),) * 3 for _ in queries]
        for seg in segments(batches):
            for q, (_, _, wanted, weight) in enumerate(queries):
                ids, hashes, scores = best[q]
                at, got, _ = seg.search(wanted, weight, k, int(scores[-1]) if len(scores) >= k else 0)
                if len(at):
                    ids, hashes, scores = (np.r_[a, b] for a, b in ((ids, seg.ids[at]), (hashes, seg.hashes[at]), (scores, got)))
                    top = np.lexsort((hashes, ids, -scores))[:k]
                    best[q] = ids[top], hashes[top], scores[top]
        for (item, mark, _, _), (ids, hashes, scores) in zip(queries, best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), pa.int64()), pa.array([mark] * len(ids), pa.int64()), pa.array(ids),
                     pa.array(hashes), pa.array(scores)], names=["item_id", "item_hash", "doc_id", "hash", "score"])
    return run


def _search_block(docs: DataFrame, items: list, k: int, b: int, segment_postings: int) -> DataFrame:
    """The best ``k`` documents of each task for ``items``: (id, hash, text)."""
    spark = docs.sparkSession
    terms = [sorted(set(terms_of(t.encode()))) for _, _, t in items]
    number = {t: i for i, t in enumerate(sorted(set().union(*terms)))}
    words = spark.sparkContext.broadcast(number)
    postings = cut_lineage(docs.mapInArrow(_posting_rows(words), POSTINGS), "postings")
    documents, length = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["df"] for r in postings.select(F.explode("terms").alias("term")).groupBy("term")
                                             .agg(F.count(F.lit(1)).alias("df")).collect()}      # one row a term of the block
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    queries = []
    for (item, mark, _), own in zip(items, terms):
        found = sorted((number[t] for t in own if number[t] in df), key=lambda t: (df[t], t))
        queries.append((item, mark, np.array(found, dtype=np.int32), np.array([weight[t] for t in found], dtype=np.int64)))
    sent = spark.sparkContext.broadcast(queries)
    return postings.mapInArrow(_search_rows(sent, _Stats(documents, length, b), k, segment_postings), HITS)


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", b: int = 90, block_bytes: int = 4 << 20,
           segment_postings: int = 1 << 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each query
    with a score above 0, ``rank`` from 1.

    * null or empty text: no terms; such a document counts nowhere, such a query finds nothing
    * null document id: ranks before other ids of equal score, shown as null
    * repeated rows, and rows with one id: documents of their own
    * repeated queries are one; queries with one id and different texts are ranked
      each by itself, a null id is kept
    * equal scores: ascending id; very long texts are read whole
    * empty tables: empty result; other columns are not read
    """
    if k < 1 or not 0 <= b <= 100:
        raise ValueError("k must be positive and b lie in 0..100")
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                     F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.col(text_col).cast("string").alias("text"))
    items = (queries.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
                    .where(F.octet_length("text") > 0).distinct().withColumn("mark", F.xxhash64("item_id", "text")))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, parts = -(-total // block_bytes), []
    for i in range(blocks):
        part = items.where(F.pmod("mark", F.lit(blocks)) == i)
        got = sorted(((r["item_id"], r["mark"], r["text"]) for r in part.collect()), key=lambda x: (x[1], x[2]))   # about block_bytes
        if got:
            parts.append(_search_block(docs, got, k, b, segment_postings))
    if not parts:
        return df.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id", "item_hash").orderBy(F.col("score").desc(), "doc_id", "hash")
    return (functools.reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", F.when(F.col("doc_id") != F.lit(NULL_ID), F.col("doc_id")).alias("doc_id"), "score"))
