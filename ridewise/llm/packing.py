"""Packing of documents into token sequences: first-fit decreasing over a
tournament tree of bin capacities, in randomised groups of documents.

Documents are encoded where they are read. Pieces of a full sequence are cut
off first, so each document leaves one rest shorter than a sequence; only
lengths and checksums are shuffled. Groups are drawn by a hash of the row, about
``group_docs`` documents each, whatever source or copies they come from, and
packed independently. Rows that share id and text hash alike, so their place in
the written pieces joins the hash and spreads them over the groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, join_side, keyed
from ridewise.llm.tokens import encoder, slices

PIECES = "__id long, __rk long, start long, length long, ids_crc32 long, doc_tokens long"
ROW = ", __row long"


class TournamentTree:
    """Room left in ``n`` bins of equal capacity; ``first_fit(size)`` takes the
    leftmost bin with room for ``size`` in O(log n)."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)
        self.capacity = capacity

    def first_fit(self, size: int) -> tuple[int, int]:
        """Bin number and the offset in it."""
        room, at = self.room, 1
        if room[1] < size:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        offset = self.capacity - room[at]
        room[at] -= size
        leaf = at - self.leaves
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return leaf, offset


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per item; equal lengths in the order given."""
    tree = TournamentTree(max(1, len(lengths)), capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        out[i] = tree.first_fit(lengths[i])
    return out


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(2)
            for lo, hi in slices(text):
                rows = []
                for i, rk, row, ids in zip(*(b.column(c)[lo:hi].to_pylist() for c in (0, 1, 3)),
                                           encoder(tokenizer).encode_batch(text[lo:hi], end_id)):
                    for s in range(0, len(ids), capacity):
                        piece = ids[s:s + capacity]
                        rows.append((i, rk, s, len(piece), zlib.crc32(piece.tobytes()), len(ids), row))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["__id", "__rk", "start", "length", "ids_crc32", "doc_tokens", "__row"])
    return run


def _pack(capacity: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["__id", "__rk", "start"], kind="stable", ignore_index=True)
        bins = np.array(first_fit_decreasing(group["length"].tolist(), capacity), dtype=np.int64)
        group["sequence_id"] = (int(key[0]) << 32) | bins[:, 0]
        group["offset"] = bins[:, 1]
        return group.drop(columns="__group")
    return run


def pack_documents(df: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text", group_docs: int = 1024, seed: int = 0) -> DataFrame:
    """One row per piece: ``__id``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    * null or empty text: a piece with the end id alone
    * null id: ``NULL_ID``; repeated rows: packed each, spread over the groups by
      an ordinal, so their sequences depend on how the table is split
    * a text longer than a sequence: cut after every ``capacity`` ids
    * empty table: empty result; other columns are not read
    """
    if capacity < 1 or group_docs < 1:
        raise ValueError("capacity and group_docs must be positive")
    rows = keyed(df, id_col, text_col)
    groups = max(1, -(-df.count() // group_docs))
    # written, so that the ordinals hold when a later task is repeated
    pieces = cut_lineage(rows.withColumn("__row", F.monotonically_increasing_id())
                             .mapInArrow(_pieces(tokenizer, end_id, capacity), PIECES + ROW), "pieces")
    keys = ["__id", "__rk"]
    repeated = join_side(pieces.where(F.col("start") == 0).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                               .where(F.col("n") > 1).select(*keys, F.lit(True).alias("__again")), "repeated-rows")
    group = F.xxhash64(*keys, F.lit(seed))
    if not repeated.isEmpty():
        pieces = pieces.join(repeated, keys, "left")
        group = F.when(F.col("__again"), F.xxhash64(*keys, F.lit(seed), "__row")).otherwise(group)
    return (pieces.withColumn("__group", F.pmod(group, F.lit(groups))).drop("__row", "__again").groupBy("__group")
                  .applyInPandas(_pack(capacity), PIECES + ", sequence_id long, offset long").drop("__rk"))
