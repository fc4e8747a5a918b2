"""Line deduplication over range-partitioned line hashes.

1. Each document emits one row per line whose key is long enough: 128-bit key
   hash, document, position. 2. The rows are range-partitioned by (hash,
   document descending, position) and sorted inside partitions, so the first
   document of a key is the largest one that holds it. A key found in a third
   of all documents is spread over as many partitions as it fills. 3. Each
   partition is streamed once. Keys that begin and end in it are decided on
   the spot; rows of the first and last key, which may go on in a neighbour,
   are passed on with a summary of at most two rows a partition, from which
   the key's document count and largest document follow. 4. The result is one
   compressed keep bitmap per document; texts are never shuffled here.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, keyed, shuffle_partitions, with_key

WS = b" \t\n\x0b\x0c\r"
LINES = "__h1 long, __h2 long, __id long, __rk long, __pos int"
DROP, OPEN, EDGE = 0, 1, 2
DECISIONS = LINES + ", kind int, docs_inside long, last_id long"


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip(WS).lower()          # bytes.lower() changes A-Z only


def _code_points(b: bytes) -> int:
    return len(b.decode("utf-8", "replace"))


def _line_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            out, ids, rks, pos = [], [], [], []
            for i, rk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                for p, line in enumerate(text.as_py().encode().split(b"\n")):
                    if len(line) < min_chars:
                        continue
                    key = line_key(line)
                    if len(key) < min_chars or (len(key) < 4 * min_chars and _code_points(key) < min_chars):
                        continue
                    out.append(digest(key))
                    ids.append(i)
                    rks.append(rk)
                    pos.append(p)
            h = np.frombuffer(b"".join(out), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])),
                 pa.array(ids, pa.int64()), pa.array(rks, pa.int64()), pa.array(pos, pa.int32())],
                names=["__h1", "__h2", "__id", "__rk", "__pos"])
    return run


def _stream_keys(min_docs: int):
    """Streams one sorted partition. Held back at most: the rows of a key's
    first document and of the documents seen before ``min_docs`` is reached."""
    names = ["__h1", "__h2", "__id", "__rk", "__pos", "kind", "docs_inside", "last_id"]

    def pack(rows) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * 8
        types = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first_id = last_id = None
        first_key, docs, held, out = True, 0, [], []

        def edge():
            # docs_inside: documents of this key here other than the first and the last one
            out.append((*key, first_id, 0, 0, EDGE, max(0, docs - 2), last_id))

        for b in batches:
            for row in zip(*(b.column(j).to_pylist() for j in range(5))):
                k, i = row[:2], row[2]
                if k != key:
                    if key is not None:
                        if first_key:
                            edge()
                        first_key = key is None
                    key, first_id, last_id, docs, held = k, i, i, 1, []
                elif i != last_id:
                    docs, last_id = docs + 1, i
                    if not first_key and docs == min_docs:
                        out.extend((*r, DROP, 0, 0) for r in held if r[2] != first_id)
                        held = []
                if first_key:
                    out.append((*row, OPEN, 0, 0))
                elif docs < min_docs:
                    held.append(row)
                elif i != first_id:
                    out.append((*row, DROP, 0, 0))
                if len(out) >= 50_000:
                    yield pack(out)
                    out = []
        if key is not None:
            if not first_key and docs < min_docs:
                out.extend((*r, OPEN, 0, 0) for r in held)
            edge()
        yield pack(out)
    return run


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``__id, __rk, __pos`` of every line to drop."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    spark = df.sparkSession
    lines = cut_lineage(keyed(df, id_col, text_col).mapInArrow(_line_rows(min_chars), LINES), "lines")
    runs = (lines.repartitionByRange(shuffle_partitions(spark), F.col("__h1"), F.col("__h2"),
                                     F.col("__id").desc(), F.col("__rk"), F.col("__pos"))
                 .sortWithinPartitions(F.col("__h1"), F.col("__h2"), F.col("__id").desc(), F.col("__rk"),
                                       F.col("__pos")))
    got = cut_lineage(runs.mapInArrow(_stream_keys(min_docs), DECISIONS), "line-decisions")
    edges = got.where(F.col("kind") == EDGE)
    ends = (edges.select("__h1", "__h2", F.explode(F.array("__id", "last_id")).alias("__end"))
                 .groupBy("__h1", "__h2").agg(F.countDistinct("__end").alias("__ends"), F.max("__end").alias("__max")))
    inside = edges.groupBy("__h1", "__h2").agg(F.sum("docs_inside").alias("__inside"))
    # at most two keys a partition: a size bound for the broadcast
    drop_keys = (ends.join(inside, ["__h1", "__h2"])
                     .where(F.col("__ends") + F.col("__inside") >= min_docs).select("__h1", "__h2", "__max"))
    late = (got.where(F.col("kind") == OPEN).join(F.broadcast(drop_keys), ["__h1", "__h2"])
               .where(F.col("__id") != F.col("__max")))
    return (got.where(F.col("kind") == DROP).select("__id", "__rk", "__pos")
               .unionByName(late.select("__id", "__rk", "__pos")))


def pack_bitmap(n_lines: int, dropped: list[int]) -> bytes:
    keep = np.ones(n_lines, dtype=np.uint8)
    keep[np.asarray(dropped, dtype=np.int64)] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Boolean keep flags of a document's lines."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def line_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per document that loses lines: ``__id, __rk, n_lines, n_dropped,
    keep_bitmap`` (zlib over one bit per line, 1: stays). A document without
    such a row keeps all its lines."""
    gone = (dropped_lines(df, id_col, text_col, min_chars, min_docs)
            .groupBy("__id", "__rk").agg(F.array_sort(F.collect_set("__pos")).alias("__gone")))
    sizes = (keyed(df, id_col, text_col)
             .select("__id", "__rk", F.size(F.split("__text", "\n", -1)).alias("n_lines")).distinct())
    return (gone.join(sizes, ["__id", "__rk"])
                .select("__id", "__rk", F.col("n_lines").cast("long").alias("n_lines"),
                        F.size("__gone").cast("long").alias("n_dropped"),
                        F.udf(pack_bitmap, "binary")("n_lines", "__gone").alias("keep_bitmap")))


def keep_lines(text: str | None, bitmap: bytes | None) -> str | None:
    if bitmap is None:
        return None
    lines = text.split("\n")
    return "\n".join(x for x, k in zip(lines, unpack_bitmap(bitmap, len(lines))) if k)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of ``df`` with the text reduced to the lines that stay, and
    ``__n_lines``, ``__n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents keeps its lines only in the largest document id holding it.

    * null or empty text: one empty line, which stays (a null text becomes empty)
    * null id: one document, smaller than any id
    * rows with one id are one document for the counts
    * very long texts: a document's line positions are the largest unit held
    * empty table: empty result; further columns pass through untouched
    """
    bitmaps = line_bitmaps(df, id_col, text_col, min_chars, min_docs)
    joined = with_key(df, id_col, text_col).join(bitmaps, ["__id", "__rk"], "left")
    text = F.coalesce(F.col(f"__row.`{text_col}`").cast("string"), F.lit(""))
    cut = F.udf(keep_lines, "string", useArrow=True)
    changed = F.when(F.col("keep_bitmap").isNotNull(), text)      # other texts do not go to Python
    kept = F.coalesce(cut(changed, F.col("keep_bitmap")), text)
    cols = [kept.alias(c) if c == text_col else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
    return joined.select(*cols, F.coalesce("n_lines", F.size(F.split(text, "\n", -1)).cast("long")).alias("__n_lines"),
                         F.coalesce("n_dropped", F.lit(0)).cast("long").alias("__n_dropped"))


def line_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``id_col``, n_lines, n_dropped, kept_sha256: what stays of each document."""
    two = df.select(F.col(id_col), F.col(text_col))
    out = dedup_lines(two, id_col, text_col, **kw)
    return out.select(F.col(id_col).cast("long").alias(id_col), F.col("__n_lines").alias("n_lines"),
                      F.col("__n_dropped").alias("n_dropped"), F.sha2(F.col(text_col), 256).alias("kept_sha256"))
