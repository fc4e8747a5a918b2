"""Near-duplicate classes by order MinHash.

Shingles are runs of five words, each labelled with its occurrence number in
the text, so a text is a sequence of distinct labels. A sketch component draws
a hash function, takes the ``ell`` labels with the smallest values and keeps
them **in text order**; two texts agree on it about with probability J^ell, less
if their order differs. A component is a bucket key; texts that share a bucket
are candidates.

Similarity of two texts: labels matched by an alignment that keeps the order,
divided by the labels of either text. As labels are distinct, the alignment is
the longest increasing run of positions among common labels, and only matches
within a band can count: to reach the threshold no matched pair may shift by
more than ``max(n1, n2) - ceil(t / (1 + t) (n1 + n2))`` places.

Classes are the components of all candidate pairs that verify. Comparing every
pair of a large bucket is avoided, not capped. Texts with the same words are
one node. In a round each bucket compares its members with one leader, the
best connected member of a class that is not theirs; verified links merge
classes, and pairs inside a class need no further look. Once what is left
between classes is small, or a round merges nothing, every pair of the buckets
that still lies between two classes is compared: classes of a bucket are paired
first, then the members of the smaller one of each pair are joined with those of
the larger, so members of one class never meet. So each candidate pair is
verified or already inside one class.
"""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, hash_words, join_side, keyed, kgram_hashes, mix64, with_key
from ridewise.llm.components import components

WORD = re.compile(r"\w+")
SHINGLE = 5
SHORT_MAX, LONG_MIN = 32, 26       # labels; texts between have both kinds of sketch
SKETCHES = "__id long, __rk long, __c1 long, __c2 long, __keys array<long>"


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words."""
    return hash_words([w.encode() for w in WORD.findall((text or "").lower())])


def labels(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Occurrence-labelled shingles in text order, all distinct. A text of
    fewer than ``k`` words is one shingle; one without words has none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    g = kgram_hashes(words, min(k, n))
    order = np.argsort(g, kind="stable")
    s = g[order]
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    nth = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
    out = np.empty(len(g), np.uint64)
    with np.errstate(over="ignore"):
        out[order] = mix64(s + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


@functools.lru_cache(maxsize=8)
def _draws(m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2 ** 63, size=(m, 1)).astype(np.uint64),
            (rng.integers(0, 2 ** 63, size=(m, 1)).astype(np.uint64) << np.uint64(1)) | np.uint64(1))


def sketch(lab: np.ndarray, ell: int, m: int, seed: int, chunk: int = 1 << 13) -> np.ndarray:
    """``m`` order MinHash components as 64-bit bucket keys."""
    ell = min(ell, len(lab))
    add, mul = _draws(m, seed)
    best_v = best_p = None
    with np.errstate(over="ignore"):
        for lo in range(0, len(lab), chunk):           # bounded memory for very long texts
            part = lab[None, lo:lo + chunk]
            v = (part ^ add) * mul
            v ^= v >> np.uint64(32)
            p = np.broadcast_to(np.arange(lo, lo + part.shape[1]), v.shape)
            if best_v is not None:
                v, p = np.concatenate([best_v, v], axis=1), np.concatenate([best_p, p], axis=1)
            if v.shape[1] > ell:
                at = np.argpartition(v, ell - 1, axis=1)[:, :ell]
                v, p = np.take_along_axis(v, at, axis=1), np.take_along_axis(p, at, axis=1)
            best_v, best_p = v, p
        in_order = lab[np.sort(best_p, axis=1)]
        key = np.arange(m, dtype=np.uint64) + np.uint64(seed * 1000)
        for j in range(ell):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + in_order[:, j])
    return key


def bucket_keys(lab: np.ndarray, ell: int, m: int, short_ell: int, short_m: int) -> np.ndarray:
    out = []
    if 0 < len(lab) <= SHORT_MAX:
        out.append(sketch(lab, short_ell, short_m, 11))
    if len(lab) >= LONG_MIN:
        out.append(sketch(lab, ell, m, 12))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def band(n1: int, n2: int, threshold: float) -> int:
    """Largest shift of a matched pair that can still reach the threshold; below 0: none can."""
    return max(n1, n2) - math.ceil(threshold / (1 + threshold) * (n1 + n2) - 1e-9)


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Order-keeping similarity of two label sequences; 0 if the band shows it
    to be below the threshold."""
    n1, n2 = len(a), len(b)
    width = band(n1, n2, threshold)
    if not n1 or not n2 or width < 0 or min(n1, n2) < threshold * max(n1, n2) - 1e-9:
        return 0.0
    oa, ob = np.argsort(a), np.argsort(b)
    sa, sb = a[oa], b[ob]
    at = np.searchsorted(sb, sa)
    at[at == n2] = 0
    hit = sb[at] == sa
    i, j = oa[hit], ob[at[hit]]
    near = np.abs(i - j) <= width
    i, j = i[near], j[near]
    if len(i) < threshold / (1 + threshold) * (n1 + n2) - 1e-9:
        return 0.0
    seq = j[np.argsort(i)]
    if np.all(seq[1:] > seq[:-1]):
        m = len(seq)
    else:
        tails: list[int] = []
        for x in seq.tolist():
            k = bisect_left(tails, x)
            tails[k:k + 1] = [x]
        m = len(tails)
    return m / (n1 + n2 - m)


def _sketch_rows(params: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                c1, c2, keys = [], [], []
                for text in b.column(2)[lo:lo + 1024]:
                    w = word_hashes(text.as_py())
                    d = xxhash.xxh3_128_digest(w.tobytes())
                    c1.append(int.from_bytes(d[:8], "little", signed=True))
                    c2.append(int.from_bytes(d[8:], "little", signed=True))
                    keys.append(bucket_keys(labels(w), *params).view(np.int64))
                off = np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:lo + 1024], b.column(1)[lo:lo + 1024], pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(keys)))],
                    names=["__id", "__rk", "__c1", "__c2", "__keys"])
    return run


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            w = [labels(word_hashes(t.as_py())).astype("<u8").tobytes() for t in b.column(1)[lo:lo + 1024]]
            yield pa.RecordBatch.from_arrays([b.column(0)[lo:lo + 1024], pa.array(w, pa.binary())],
                                             names=["node", "labels"])


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [aligned_similarity(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), threshold)
                  >= threshold - 1e-9 for x, y in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])
    return run


def verify_pairs(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``a, b, ok`` for every pair of nodes; one written table."""
    left = texts.select(F.col("node").alias("a"), F.col("labels").alias("la"))
    right = texts.select(F.col("node").alias("b"), F.col("labels").alias("lb"))
    return cut_lineage(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "la", "lb")
                            .mapInArrow(_verify(threshold), "a long, b long, ok boolean"), "verified")


def _classes(members: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``members`` (key, node) with the present class of each node."""
    if not links:
        return members.withColumn("comp", F.col("node"))
    comp = components(functools.reduce(DataFrame.unionByName, [x.where("ok").select("a", "b") for x in links]))
    return members.join(comp, "node", "left").select("key", "node", "rank", F.coalesce("comp", "node").alias("comp"))


def _between(state: DataFrame, size: DataFrame) -> DataFrame:
    """``a < b``: the pairs of a bucket's members that lie in two classes.
    ``size``: key, comp, c (members) of the buckets with several classes. The
    rows made are the pairs themselves and one row per pair of classes."""
    one = size.select("key", F.col("comp").alias("x"), F.col("c").alias("nx"))
    two = size.select("key", F.col("comp").alias("y"), F.col("c").alias("ny"))
    classes = one.join(two, "key").where((F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y"))))
    small = cut_lineage(classes.join(state.select("key", F.col("comp").alias("x"), F.col("node").alias("p")), ["key", "x"])
                               .select("key", "y", "p"), "smaller-sides")
    pairs = small.join(state.select("key", F.col("comp").alias("y"), F.col("node").alias("q")), ["key", "y"])
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                 ell: int = 6, m: int = 40, short_ell: int = 2, short_m: int = 16, spare: float = 4.0) -> DataFrame:
    """One row per input row: ``__id, __rk, class_id, class_size, kept``.

    ``class_id`` is the smallest id in the class. ``spare``: pairs between
    classes are compared outright when at most ``spare`` times the rows of the
    shared buckets are left. ``threshold`` lies in 0.8..1: similar texts of up to
    32 labels and of 26 and more then always have a kind of sketch in common, and
    a pair at the threshold is missed by all components about 5 times in a million.

    * texts with the same lower-cased words are one class; so are all texts without words
    * null text: as an empty text; null id: ``NULL_ID``, shown as it is
    * repeated rows (same id, same text) are in one class and all have the
      same ``kept``; other rows with one id are documents of their own
    * very long texts: sketched in chunks, compared whole
    * empty table: empty result; other columns are not read
    """
    if not 0.8 <= threshold <= 1:
        raise ValueError("the sketches are sized for thresholds from 0.8 to 1")
    docs = keyed(df, id_col, text_col)
    rows = cut_lineage(docs.mapInArrow(_sketch_rows((ell, m, short_ell, short_m)), SKETCHES)
                           .withColumn("__ord", F.monotonically_increasing_id()), "sketches")
    # texts with the same words: one node, named by the row with the smallest id
    same = (rows.groupBy("__c1", "__c2").agg(F.min(F.struct("__id", "__rk", "__ord")).alias("best"))
                .select("__c1", "__c2", F.col("best.__ord").alias("node"), F.col("best.__id").alias("node_id"),
                        F.col("best.__rk").alias("node_rk")))
    known = cut_lineage(rows.join(join_side(same, "same-words"), ["__c1", "__c2"])
                            .select("__id", "__rk", "__ord", "node", "node_id", "node_rk",
                                    F.when(F.col("__ord") == F.col("node"), F.col("__keys")).alias("__keys")), "nodes")
    keys = known.where(F.col("__keys").isNotNull()).select(F.explode("__keys").alias("key"), "node").distinct()
    shared = (keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("size"))
                  .where(F.col("lo") != F.col("hi")).select("key", "size"))
    members = keys.join(join_side(shared, "shared-buckets"), "key")
    weight = members.groupBy("node").agg(F.sum("size").alias("rank"))
    members = cut_lineage(members.select("key", "node").join(weight, "node"), "members")
    wanted = members.select("node").distinct().join(known.where(F.col("__ord") == F.col("node")), "node") \
                    .select("node", F.col("node_id").alias("__id"), F.col("node_rk").alias("__rk"))
    texts = cut_lineage(docs.join(wanted, ["__id", "__rk"]).dropDuplicates(["node"]).select("node", "__text")
                            .mapInArrow(_word_rows, "node long, labels binary"), "labels")
    tested: list[DataFrame] = []
    total = members.count()
    while total:
        state = cut_lineage(_classes(members, tested), "bucket-classes")
        # pairs still between classes: (n^2 - sum of class sizes squared) / 2 per bucket
        size = state.groupBy("key", "comp").agg(F.count(F.lit(1)).cast("double").alias("c"))
        left = (size.groupBy("key").agg(((F.pow(F.sum("c"), 2) - F.sum(F.col("c") * F.col("c"))) / 2).alias("x"))
                    .agg(F.sum("x")).first()[0]) or 0
        if not left:
            break
        final = left <= spare * total or (tested and not tested[-1].where("ok").limit(1).count())
        top = (state.groupBy("key").agg(F.max(F.struct("rank", "comp", "node")).alias("t"), F.min("comp").alias("c0"),
                                        F.max("comp").alias("c1")).where(F.col("c0") != F.col("c1")).drop("c0", "c1"))
        if final:
            pairs = _between(state, join_side(size.join(top.select("key"), "key"), "bucket-classes-left"))
        else:
            pairs = (state.join(join_side(top, "leaders"), "key").where(F.col("comp") != F.col("t.comp"))
                          .select(F.least("node", "t.node").alias("a"), F.greatest("node", "t.node").alias("b")))
        pairs = pairs.select("a", "b").distinct()
        for x in tested:
            pairs = pairs.join(x.select("a", "b"), ["a", "b"], "left_anti")
        tested.append(verify_pairs(pairs, texts, threshold))
        if final:
            break
    if tested:
        comp = components(functools.reduce(DataFrame.unionByName, [x.where("ok").select("a", "b") for x in tested]))
        known = known.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    else:
        known = known.withColumn("comp", F.col("node"))
    known = cut_lineage(known.select("__id", "__rk", "comp"), "classes")
    best = known.groupBy("comp").agg(F.min(F.struct("__id", "__rk")).alias("best"), F.count(F.lit(1)).alias("class_size"))
    return known.join(join_side(best, "class-heads"), "comp").select("__id", "__rk", F.col("best.__id").alias("class_id"), "class_size",
                                           (F.struct("__id", "__rk") == F.col("best")).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of every class, all columns as they were. Of repeated rows (same id
    and text) the one whose other columns come first as JSON text stays. Other
    cases: as in ``near_classes``."""
    found = near_classes(df, id_col, text_col, **kw).where("kept")
    once = found.groupBy("__id", "__rk").agg(F.count(F.lit(1)).alias("n"))
    rows = with_key(df, id_col, text_col).join(join_side(once, "kept-rows"), ["__id", "__rk"])
    repeats = (rows.where(F.col("n") > 1).groupBy("__id", "__rk").agg(F.min_by("__row", F.to_json("__row")).alias("__row")))
    return (rows.where(F.col("n") == 1).select("__id", "__rk", "__row").unionByName(repeats)
                .select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns]))
