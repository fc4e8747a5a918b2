"""Benchmark decontamination by greedy string tiling.

1. Seeds. The benchmark's word ``seed``-grams are an index from hash to items:
   two sorted arrays, 12 bytes a gram, beside 8 bytes a word of the items. It is
   built in blocks of at most ``block_bytes`` of text (the size is measured first),
   each small enough to broadcast; every block meets every document in one scan
   without a shuffle of text. A benchmark of many blocks costs as many scans, and
   nothing is left out.
2. Tiles. For each document and item that share a seed, running Karp-Rabin
   greedy string tiling marks the longest common runs of words that overlap no
   earlier tile, in falling length, down to ``min_match`` words.
3. Decision. The share of the item's words under tiles is its coverage;
   tiles are unordered, so reordered passages are covered like whole ones.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import hash_words, join_side, keyed, kgram_hashes, with_key
from ridewise.sources.tables import maybe_broadcast

WORD = re.compile(r"\w+")
PAIRS = "__id long, __rk long, item_id long, n_tiles int, covered int, item_words int"


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words; punctuation and white space do not count."""
    return hash_words([w.encode() for w in WORD.findall((text or "").lower())])


def _unmarked_grams(h: np.ndarray, marked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the ``k``-grams without a marked word, and their places."""
    if len(h) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    blocked = np.cumsum(np.r_[0, marked])
    at = np.flatnonzero(blocked[k:] == blocked[:-k])
    return kgram_hashes(h, k)[at], at


def _matches(text, pattern, text_marked, pattern_marked, k: int) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches ``(length, pattern place, text place)`` of at least ``k`` words."""
    pg, pa_ = _unmarked_grams(pattern, pattern_marked, k)
    tg, ta = _unmarked_grams(text, text_marked, k)
    if not len(pg) or not len(tg):
        return []
    hit = np.isin(tg, pg)
    table = defaultdict(list)
    for g, p in zip(pg.tolist(), pa_.tolist()):
        table[g].append(p)
    out, seen = [], set()
    for g, t in zip(tg[hit].tolist(), ta[hit].tolist()):
        for p in table[g]:
            if (p, t) in seen:              # inside a match found already
                continue
            n = 0
            while (p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n]
                   and not pattern_marked[p + n] and not text_marked[t + n]):
                n += 1
            if n >= k:
                out.append((n, p, t))
                seen.update((p + d, t + d) for d in range(1, n - k + 1))
    return out


def greedy_tiles(text: np.ndarray, pattern: np.ndarray, min_match: int, start: int = 32) -> list[tuple[int, int, int]]:
    """Tiles ``(length, pattern place, text place)``: longest first, none overlapping."""
    tm, pm = np.zeros(len(text), dtype=bool), np.zeros(len(pattern), dtype=bool)
    tiles, s = [], max(min_match, min(start, len(pattern)))
    while True:
        # longer matches than 2s exist only in the first rounds; they come first by sorting
        queue = sorted(_matches(text, pattern, tm, pm, s), key=lambda m: (-m[0], m[1], m[2]))
        while queue:
            n, p, t = queue.pop(0)
            free = ~(pm[p:p + n] | tm[t:t + n])
            if free.all():
                pm[p:p + n] = tm[t:t + n] = True
                tiles.append((n, p, t))
                continue
            edges = np.flatnonzero(np.diff(np.r_[0, free.astype(np.int8), 0]))
            for a, b in zip(edges[::2], edges[1::2]):       # what earlier tiles left of the match
                if b - a >= s:
                    m = (int(b - a), p + int(a), t + int(a))
                    at = next((i for i, q in enumerate(queue) if (-q[0], q[1], q[2]) > (-m[0], m[1], m[2])), len(queue))
                    queue.insert(at, m)
        if s <= min_match:
            return tiles
        s = max(min_match, s // 2)


class SeedIndex:
    """Seed hash to places of item texts for one block of the benchmark; an id may
    have several texts, and ids may be null. Arrays only: grams in rising order with
    the place of their text, and the words of all texts end to end."""

    def __init__(self, items: Iterable[tuple[int | None, str]], seed: int):
        ids, words, grams, places = [], [], [], []
        for place, (item, text) in enumerate(items):
            h = word_hashes(text)
            g = np.unique(kgram_hashes(h, seed))
            ids.append(item)
            words.append(h)
            grams.append(g)
            places.append(np.full(len(g), place, dtype=np.int32))
        self.seed, self.ids = seed, ids
        self.ends = np.cumsum([0, *map(len, words)])
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)
        grams, places = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((grams, np.uint64), (places, np.int32)))
        order = np.argsort(grams, kind="stable")
        self.grams, self.places = grams[order], places[order]

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.grams.nbytes + self.places.nbytes + self.ends.nbytes + 32 * len(self.ids)

    def item(self, place: int) -> tuple[int | None, np.ndarray]:
        return self.ids[place], self.words[self.ends[place]:self.ends[place + 1]]

    def candidates(self, h: np.ndarray) -> list[int]:
        """Places of the texts that share a seed with ``h``."""
        g = kgram_hashes(h, self.seed)
        if not len(g) or not len(self.grams):
            return []
        at = np.searchsorted(self.grams, g)
        at[at == len(self.grams)] = 0
        g = np.unique(g[self.grams[at] == g])
        ranges = zip(np.searchsorted(self.grams, g, "left").tolist(), np.searchsorted(self.grams, g, "right").tolist())
        found = [self.places[lo:hi] for lo, hi in ranges]
        return np.unique(np.concatenate(found)).tolist() if found else []


def _tile_rows(index, min_match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx: SeedIndex = index.value
        for b in batches:
            rows = []
            for i, rk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                h = word_hashes(text.as_py())
                for k in idx.candidates(h):
                    item, pattern = idx.item(k)
                    tiles = greedy_tiles(h, pattern, min_match)
                    rows.append((i, rk, item, len(tiles), sum(t[0] for t in tiles), len(pattern)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64()] * 3 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["__id", "__rk", "item_id", "n_tiles", "covered", "item_words"])
    return run


def overlaps(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text: str = "text", seed: int = 5, min_match: int = 3, block_bytes: int = 32 << 20) -> DataFrame:
    """``__id, __rk, item_id, n_tiles, covered, item_words, coverage`` of every
    document and item text that share a run of ``seed`` words. Every distinct
    ``(item_id, text)`` is an item text of its own, whatever the blocks."""
    if not 1 <= min_match <= seed:
        raise ValueError("min_match must lie between 1 and seed")
    spark = df.sparkSession
    items = (benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("t"))
                      .where(F.col("t").isNotNull()))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    docs = keyed(df, id_col, text_col).select("__id", "__rk", "__text")
    parts = []
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == k) if n > 1 else items
        got = {(r["item"], r["t"]) for r in block.collect()}                   # about block_bytes
        ordered = sorted(got, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        index = spark.sparkContext.broadcast(SeedIndex(ordered, seed))
        parts.append(docs.mapInArrow(_tile_rows(index, min_match), PAIRS))
    pairs = functools.reduce(DataFrame.unionByName, parts)
    return pairs.withColumn("coverage", F.col("covered") / F.col("item_words"))


def contaminated(df: DataFrame, benchmark: DataFrame, threshold: float = 0.6, **kw) -> DataFrame:
    """``__id, __rk, items, coverage`` of the documents that cover at least
    ``threshold`` of the words of one of an item's texts; ``items`` are those
    items' ids (none for a null id)."""
    pairs = overlaps(df, benchmark, **kw).where(F.col("coverage") >= threshold)
    return pairs.groupBy("__id", "__rk").agg(F.sort_array(F.collect_set("item_id")).alias("items"),
                                             F.max("coverage").alias("coverage"))


def flag_documents(df: DataFrame, benchmark: DataFrame, threshold: float = 0.6, id_col: str = "doc_id",
                   text_col: str = "text", **kw) -> DataFrame:
    """One row per input row: ``__id``, contaminated, items, coverage.

    * null or empty text: clean; null id: ``NULL_ID``; repeated rows: alike
    * items with a null text, or fewer than ``seed`` words: match nothing
    * of items with one id every text counts; an item with a null id contaminates,
      too, but has no id to list
    * very long texts are tiled whole; empty tables: an empty result, or all clean
    * other columns are not read
    """
    hits = join_side(contaminated(df, benchmark, threshold, id_col=id_col, text_col=text_col, **kw), "contaminated")
    return (keyed(df, id_col, text_col).select("__id", "__rk").join(maybe_broadcast(hits), ["__id", "__rk"], "left")
            .select("__id", F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce("items", F.array().cast("array<long>")).alias("items"),
                    F.coalesce("coverage", F.lit(0.0)).alias("coverage")))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, threshold: float = 0.6, id_col: str = "doc_id",
                      text_col: str = "text", **kw) -> DataFrame:
    """The clean rows of ``df``, all columns as they were, in every case as
    ``flag_documents`` has it: rows with a null id or text and repeated rows are
    judged alike and each stays or goes; an empty table stays empty; column names
    do not matter. The hits, two numbers a row, are written first and broadcast
    only if they are small, so texts need not be shuffled."""
    hits = contaminated(df, benchmark, threshold, id_col=id_col, text_col=text_col, **kw).select("__id", "__rk")
    return (with_key(df, id_col, text_col).join(maybe_broadcast(join_side(hits, "contaminated")), ["__id", "__rk"], "left_anti")
            .select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns]))
