"""Quality by compression: zstandard dictionaries trained on blocks of good
labelled texts and on blocks of bad ones. A text is cut into blocks, every block
is compressed with either dictionary, and

    d = (bytes with the bad dictionary - bytes with the good one) / raw bytes

over the whole text is positive for text that looks like the good sample. The raw
size is the norm, since text that repeats itself shrinks to little with either
dictionary, which would blow up a share of the compressed size. Blocks keep the
dictionaries' share of a long text as large as of a short one. Small blocks tell
words and phrases apart, large ones what repeats over paragraphs; so ``d`` is the
mean over a few scales (block size and dictionary size), each with its own pair
of dictionaries. A curve fitted on other labelled texts, monotone and linear
between its knots, turns ``d`` into a probability.

Bounds. Fitting uses at most ``docs_per_class`` labelled documents a class,
half for the dictionaries and half for the curve, chosen by a hash of the id;
of the first half at most ``blocks_per_class`` blocks and ``sample_bytes`` bytes
a class and scale reach the driver. Class shares are counted over all labels.
Scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewise.llm.common import cut_lineage

#: (block bytes, greatest dictionary bytes)
SCALES = ((512, 96 << 10), (1024, 256 << 10), (4096, 256 << 10), (16384, 512 << 10))


@dataclass(frozen=True)
class Scale:
    block: int
    good: bytes
    bad: bytes


@dataclass(frozen=True)
class Model:
    scales: tuple[Scale, ...]
    knots: tuple[tuple[float, float], ...]  # (d, probability), both rising; empty: the prior for every text
    prior: float                            # share of label 1, the score of an empty text
    level: int = 3

    def probability(self, d: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
        if not self.knots:
            return np.full(len(d), self.prior)
        x, y = zip(*self.knots)
        return np.where(n_bytes > 0, np.interp(d, x, y), self.prior)


@functools.lru_cache(maxsize=16)
def _compressors(good: bytes, bad: bytes, level: int):
    out = []
    for raw in (good, bad):
        if not raw:
            out.append(zstandard.ZstdCompressor(level=level, write_content_size=False, write_dict_id=False))
            continue
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False))
    return out


def blocks(raw: bytes, size: int) -> list[bytes]:
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def size_difference(text: str | None, model: Model) -> tuple[float, int]:
    """``d`` and the bytes of a whole text; 0 and 0 for an empty one."""
    raw, total = (text or "").encode(), 0.0
    if not raw:
        return 0.0, 0
    for s in model.scales:
        good, bad = _compressors(s.good, s.bad, model.level)
        total += sum(len(bad.compress(x)) - len(good.compress(x)) for x in blocks(raw, s.block)) / len(raw)
    return total / max(len(model.scales), 1), len(raw)


def _differences(model: Model, extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [size_difference(t.as_py(), model) for t in b.column(0)]
            d, n = np.array([x[0] for x in got], dtype=np.float64), np.array([x[1] for x in got], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(d), pa.array(n), pa.array(model.probability(d, n))],
                                             names=[*extra, "difference", "n_bytes", "score"])
    return run


def _block_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, out, rank = [], [], []
            for label, text in zip(b.column(0).to_pylist(), b.column(1)):
                for x in blocks((text.as_py() or "").encode(), size):
                    cls.append(label)
                    out.append(x)
                    rank.append(int.from_bytes(hashlib.blake2b(x, digest_size=7).digest(), "little"))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int32()), pa.array(out, pa.binary()),
                                              pa.array(rank, pa.int64())], names=["label", "block", "rank"])
    return run


def fold(id_col: str | Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``; null for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("long").cast("string").cast("binary")) % folds


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Empty when the samples are too few for a dictionary."""
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 8:
        return b""
    return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 4), samples, d=8, k=256).as_bytes()


def fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[tuple[float, float], ...]:
    """Weighted monotone regression (pool adjacent violators): the knots are the
    pools' mean places and mean labels; equal places are one pool from the start."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []                            # sums of weighted places, weighted labels, weights
    at, first = np.unique(x[order], return_index=True)
    for place, wy, ws in zip(at, np.add.reduceat((w * y)[order], first), np.add.reduceat(w[order], first)):
        pools.append([place * ws, wy, ws])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return tuple((float(p / ws), float(wy / ws)) for p, wy, ws in pools)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 5, docs_per_class: int = 4000, blocks_per_class: int = 6000, sample_bytes: int = 16 << 20,
          scales: tuple[tuple[int, int], ...] = SCALES, level: int = 3) -> Model:
    """Fits on labelled rows whose fold is not 0.

    Rows with a null id, a null or other label, and ids with both labels are
    left out. With one class only, or none, every score is the smoothed share of
    label 1 (0.5 without labels). Null and empty texts give no block and no knot; of
    repeated rows each counts; very long texts give their blocks like many short ones.
    """
    lab = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("label"))
                 .where(F.col("__id").isNotNull() & F.col("label").isin(0, 1) & (fold("__id", folds) != 0))
                 .groupBy("__id").agg(F.min("label").alias("label"), F.max("label").alias("__max"))
                 .where(F.col("label") == F.col("__max")).drop("__max"))
    count = {r[0]: r[1] for r in lab.groupBy("label").count().collect()}
    total = sum(count.values())
    share = (count.get(1, 0) + 0.5) / (total + 1) if total else 0.5
    if len(count) < 2:
        return Model((), (), share, level)
    rank = F.xxhash64("__id", F.lit(1))
    # bounded by docs_per_class, hence a safe broadcast
    pick = functools.reduce(DataFrame.unionByName, [
        lab.where(F.col("label") == c).orderBy(rank, "__id").limit(docs_per_class) for c in (0, 1)])
    rows = (df.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
              .where(F.col("__text").isNotNull()).join(F.broadcast(pick), "__id")
              .select("label", "__text", (F.xxhash64("__id", F.lit(2)) % 2 == 0).alias("for_curve")))
    rows = cut_lineage(rows, "labelled-texts")      # a few thousand texts, read by every scale
    fitted = []
    for block, dict_bytes in scales:
        cut = (rows.where(~F.col("for_curve")).select("label", "__text")
                   .mapInArrow(_block_rows(block), "label int, block binary, rank long"))
        most = max(1, min(blocks_per_class, sample_bytes // block))
        got = functools.reduce(DataFrame.unionByName, [
            cut.where(F.col("label") == c).orderBy("rank", "block").limit(most) for c in (0, 1)]).collect()
        bad, good = (train_dictionary([bytes(r["block"]) for r in got if r["label"] == c], dict_bytes) for c in (0, 1))
        fitted.append(Scale(block, good, bad))
    raw = Model(tuple(fitted), (), share, level)
    got = (rows.where("for_curve").select("__text", "label")
               .mapInArrow(_differences(raw, ["label"]), "label int, difference double, n_bytes long, score double")
               .where(F.col("n_bytes") > 0).select("label", "difference").collect())
    y = np.array([r["label"] for r in got], dtype=np.float64)
    if len(set(y)) < 2:
        return raw
    w = np.where(y == 1, count[1] / (y == 1).sum(), count[0] / (y == 0).sum())
    return Model(tuple(fitted), fit_curve(np.array([r["difference"] for r in got]), y, w), share, level)


def score(df: DataFrame, model: Model, text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``keep`` columns beside ``difference``, ``n_bytes`` and ``score`` (0 to 1).

    A null or empty text has difference 0, 0 bytes and scores the share of label 1.
    Very long texts are read whole, block by block. Null ids and repeated rows score
    like any row; an empty table gives an empty result.
    """
    keep = keep or {}
    rows = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"),
                     *[c.alias(n) for n, c in keep.items()])
    fields = rows.schema.fields[1:]
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in (
        ("difference", T.DoubleType()), ("n_bytes", T.LongType()), ("score", T.DoubleType())))])
    return rows.mapInArrow(_differences(model, [f.name for f in fields]), schema)


def keep_good(df: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
              text_col: str = "text", **fit) -> DataFrame:
    """The rows of ``df`` that score at least ``threshold``, all columns as they were;
    every case is that of ``score`` and ``train``."""
    model = train(df, labels, id_col, text_col, **fit)
    row = {"__row": F.struct(*[F.col(f"`{c}`") for c in df.columns])}
    return (score(df, model, text_col, row).where(F.col("score") >= threshold)
            .select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns]))
