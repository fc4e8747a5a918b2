"""Long repeated spans by de Bruijn graph compaction.

A full graph has an edge for every token k-mer of the corpus. This one keeps
the k-mers between anchors only and loses no repeated window:

1. Anchors. Of each run of ``window - seed + 1`` consecutive word ``seed``-grams
   the one with the smallest hash is an anchor. Equal windows have equal anchors.
2. Edges. The words from one anchor to the next form a token k-mer of variable
   length: an edge between two anchor nodes. A node is *repeated* when two
   documents hold it; others cannot lie in a repeated window and go.
3. Compaction. ``u -> v`` is nonbranching when all occurrences of u continue
   with the same k-mer and all occurrences of v come from that k-mer. Such
   paths are compacted by pointer doubling, a Spark join per round. As text is
   finite, no cycle can be nonbranching throughout.
4. Verification by source coordinates. All occurrences of a compacted path
   hold the same words, and a window inside it can occur nowhere else, so the
   inside is settled by the path's smallest document. A window that reaches
   over an end of the path is compared by a 128-bit hash of its own words
   with its copies from all documents.

Anchors and paths only choose where windows are compared; the answer per
window is exact (up to 128-bit collisions, and 64-bit ones for anchor k-mers).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, hash_words, join_side, keyed, kgram_hashes, with_key

ANCHORS = "__id long, __rk long, __pos int, __node long, __prev long, __next long, __gap int"


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged, as UTF-8."""
    return (text or "").encode().split()       # bytes.split(): exactly these six characters


def anchor_positions(h: np.ndarray, seed: int, window: int) -> np.ndarray:
    """Positions of the smallest seed-gram hash (leftmost of equals) of every window."""
    w = window - seed + 1
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    # sliding minimum by doubling over (value, position); leftmost wins ties
    val, pos, size = h, np.arange(len(h)), 1

    def merge(v1, p1, v2, p2):
        left = v1 <= v2
        return np.where(left, v1, v2), np.where(left, p1, p2)

    while 2 * size <= w:
        m = len(h) - 2 * size + 1
        val, pos = merge(val[:m], pos[:m], val[size:size + m], pos[size:size + m])
        size *= 2
    if size < w:
        off = w - size
        val, pos = merge(val[:n], pos[:n], val[off:off + n], pos[off:off + n])
    return np.unique(pos[:n])


def _i64(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64, copy=False).view(np.int64)


def _anchor_rows(seed: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[] for _ in range(7)]
            for i, rk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                words = split_words(text.as_py())
                if len(words) < window:
                    continue
                wh = hash_words(words)
                g = kgram_hashes(wh, seed)
                at = anchor_positions(g, seed, window)
                gap = np.diff(at)
                # hash of the k-mer from anchor to next anchor: prefix polynomials over
                # word hashes cannot be subtracted without the power, so hash the bytes
                raw = wh.tobytes()
                edge = np.fromiter((hash_words([raw[8 * a:8 * (c + seed)]])[0] for a, c in zip(at[:-1], at[1:])),
                                   dtype=np.uint64, count=len(gap))
                edge = _i64(edge)
                ok = len(at)
                nxt = np.zeros(ok, dtype=np.int64)
                prv = np.zeros(ok, dtype=np.int64)
                nxt[:-1], prv[1:] = edge, edge
                gaps = np.zeros(ok, dtype=np.int32)
                gaps[:-1] = gap
                for c, v in zip(cols, (np.full(ok, i), np.full(ok, rk), at.astype(np.int32), _i64(g[at]), prv, nxt,
                                       gaps)):
                    c.append(v)
            types = [np.int64, np.int64, np.int32, np.int64, np.int64, np.int64, np.int32]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(t) if c else np.empty(0, t)) for c, t in zip(cols, types)],
                names=["__id", "__rk", "__pos", "__node", "__prev", "__next", "__gap"])
    return run


def anchors(docs: DataFrame, window: int = 50, seed: int = 12) -> DataFrame:
    """Anchor occurrences of keyed documents. ``__prev``/``__next`` hash the
    token k-mer to the neighbour anchor, 0 where the document ends."""
    return docs.select("__id", "__rk", "__text").mapInArrow(_anchor_rows(seed, window), ANCHORS)


def repeated_nodes(occ: DataFrame) -> DataFrame:
    """Graph nodes held by two documents or more, with the one k-mer all their
    occurrences continue with (``__out``) and come from (``__in``), if there is one."""
    g = occ.groupBy("__node").agg(
        F.min("__id").alias("__first"), F.max("__id").alias("__last"),
        F.min("__next").alias("n0"), F.max("__next").alias("n1"), F.max("__gap").alias("__gap"),
        F.min("__prev").alias("p0"), F.max("__prev").alias("p1"))
    one = lambda a, b: F.when((F.col(a) == F.col(b)) & (F.col(a) != 0), F.col(a))
    return g.where(F.col("__first") != F.col("__last")).select(
        "__node", "__first", one("n0", "n1").alias("__out"), one("p0", "p1").alias("__in"), "__gap")


def compact_paths(nodes: DataFrame, seed: int) -> DataFrame:
    """Maximal nonbranching paths: one row per path head with the path's
    length in words and the smallest document holding it."""
    # u -> v over k-mer e when e is u's only continuation and v's only origin
    link = (nodes.where(F.col("__out").isNotNull()).select(F.col("__node").alias("u"), F.col("__out").alias("e"),
                                                           F.col("__gap").alias("gap"))
                 .join(nodes.where(F.col("__in").isNotNull())
                            .select(F.col("__node").alias("v"), F.col("__in").alias("e")), "e"))
    state = cut_lineage(
        nodes.join(link.select(F.col("u").alias("__node"), F.col("v").alias("ptr"), "gap"), "__node", "left")
             .join(link.select(F.col("v").alias("__node"), F.lit(True).alias("inner")), "__node", "left")
             .select("__node", "__first", "ptr", F.coalesce("gap", F.lit(0)).cast("long").alias("dist"),
                     F.col("inner").isNull().alias("head")), "paths")
    # heads jump; a node's pointer doubles each round until the path's end
    while state.where(F.col("ptr").isNotNull()).limit(1).count():
        to = state.select(F.col("__node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"))
        state = cut_lineage(
            state.join(to, "ptr", "left")
                 .select("__node", "__first", F.col("ptr2").alias("ptr"),
                         (F.col("dist") + F.coalesce("dist2", F.lit(0))).alias("dist"), "head"), "paths")
    return state.where("head").select("__node", "__first", (F.col("dist") + seed).cast("int").alias("__len"))


def path_occurrences(occ: DataFrame, paths: DataFrame) -> DataFrame:
    """Source coordinates of every path: ``__id, __rk, __pos, __len, __first``."""
    return occ.select("__node", "__id", "__rk", "__pos").join(paths, "__node").drop("__node")


def window_hashes(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    wh = hash_words(words)
    return kgram_hashes(wh, window, 1), kgram_hashes(wh, window, 2)


def _pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts go through the shuffles compressed: less than a lz4 block holds."""
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        packed = [z.compress(t.as_py().encode()) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())],
                                         names=["__id", "__rk", "__packed"])


def packed_texts(docs: DataFrame) -> DataFrame:
    return docs.select("__id", "__rk", "__text").mapInArrow(_pack_text, "__id long, __rk long, __packed binary")


def unpack_words(packed: pa.Scalar) -> list[bytes]:
    return zstandard.decompress(packed.as_buffer()).split()


def _flank_rows(seed: int, window: int):
    """Windows that hold a path's end and reach beyond it, once per document
    and window hash, with all their positions."""
    reach = window - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2, ids, rks, spots = [], [], [], [], []
            for i, rk, text, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                words = unpack_words(text)
                n = len(words) - window + 1
                mark = np.zeros(n + 1, dtype=np.int32)
                for s in spans:
                    a, e = s["__pos"], s["__pos"] + s["__len"]
                    lo, hi = max(0, a - reach), min(n - 1, e - seed)
                    inner = (a, e - window) if e - a >= window else None
                    for x, y in ([(lo, hi)] if inner is None else [(lo, a - 1), (inner[1] + 1, hi)]):
                        if x <= y:
                            mark[x] += 1
                            mark[y + 1] -= 1
                at = np.flatnonzero(np.cumsum(mark[:n]) > 0)
                if not len(at):
                    continue
                a1, a2 = window_hashes(words, window)
                order = at[np.lexsort((a2[at], a1[at]))]
                k1, k2 = a1[order], a2[order]
                new = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
                h1.append(_i64(k1[new]))
                h2.append(_i64(k2[new]))
                ids.append(np.full(len(new), i))
                rks.append(np.full(len(new), rk))
                spots.extend(np.split(order.astype(np.int32), new[1:]))
            cat = lambda c: np.concatenate(c) if c else np.empty(0, np.int64)
            flat = np.concatenate(spots) if spots else np.empty(0, np.int32)
            off = np.r_[0, np.cumsum([len(s) for s in spots])].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cat(h1)), pa.array(cat(h2)), pa.array(cat(ids)), pa.array(cat(rks)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(flat))],
                names=["__h1", "__h2", "__id", "__rk", "__at"])
    return run


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 50, seed: int = 12) -> DataFrame:
    """``__id, __rk, starts``: per document the first words of its windows whose
    word sequence also starts in a document with a smaller id, as runs
    ``(from, to)``, both included. Documents without any have no row."""
    if not 1 <= seed < window:
        raise ValueError("seed must be smaller than window")
    docs = keyed(df, id_col, text_col)
    occ = cut_lineage(anchors(docs, window, seed), "anchors")
    paths = cut_lineage(compact_paths(repeated_nodes(occ), seed), "unitigs")
    spans = cut_lineage(path_occurrences(occ, paths), "path-spans")
    inside = (spans.where((F.col("__len") >= window) & (F.col("__id") != F.col("__first")))
                   .select("__id", "__rk", F.col("__pos").alias("from"),
                           (F.col("__pos") + F.col("__len") - window).alias("to")))
    per_doc = spans.groupBy("__id", "__rk").agg(F.collect_set(F.struct("__pos", "__len")).alias("__spans"))
    flanks = cut_lineage(
        packed_texts(docs).join(per_doc, ["__id", "__rk"]).select("__id", "__rk", "__packed", "__spans")
            .mapInArrow(_flank_rows(seed, window), "__h1 long, __h2 long, __id long, __rk long, __at array<int>"),
        "flank-windows")
    first = join_side(flanks.groupBy("__h1", "__h2").agg(F.min("__id").alias("__min"), F.max("__id").alias("__max"))
                            .where(F.col("__min") != F.col("__max")).drop("__max"), "repeated-windows")
    late = (flanks.join(first, ["__h1", "__h2"]).where(F.col("__id") != F.col("__min"))
                  .select("__id", "__rk", F.explode("__at").alias("from")).withColumn("to", F.col("from")))
    return (inside.unionByName(late).groupBy("__id", "__rk")
                  .agg(F.collect_set(F.struct("from", "to")).alias("starts")))


def covered_words(n: int, starts, window: int) -> np.ndarray:
    """Flags of the words that a window starting in one of the runs covers."""
    mark = np.zeros(n + 1, dtype=np.int64)
    for a, b in starts:
        mark[a] += 1
        mark[min(n, b + window)] -= 1
    return np.cumsum(mark[:n]) > 0


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(b.column(1), b.column(2).to_pylist()):
                words = unpack_words(text)
                out = words
                if starts:
                    gone = covered_words(len(words), [(s["from"], s["to"]) for s in starts], window)
                    out = [w for w, g in zip(words, gone) if not g]
                n_words.append(len(words))
                n_removed.append(len(words) - len(out))
                kept.append(b" ".join(out))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([k.decode() for k in kept], pa.string())],
                names=["__id", "n_words", "n_removed", "kept_text"])
    return run


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 50, seed: int = 12) -> DataFrame:
    """One row per input row: ``__id, n_words, n_removed, kept_text`` (kept words
    joined by one space).

    * null or empty text, or fewer words than ``window``: nothing is removed
    * null id: smaller than any id (``NULL_ID``)
    * repeated rows, and other rows with the same id: windows count as removed
      only if a document with a smaller id holds them, so these rows do not
      remove each other's words
    * very long texts: one document's words are the largest unit held
    * empty table: empty result; other columns are not read
    """
    spans = repeated_spans(df, id_col, text_col, window, seed)
    return (packed_texts(keyed(df, id_col, text_col)).join(spans, ["__id", "__rk"], "left")
            .select("__id", "__packed", "starts")
            .mapInArrow(_remove(window), "__id long, n_words long, n_removed long, kept_text string"))


