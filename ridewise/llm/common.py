"""Helpers shared by the corpus operators.

Row identity. An operator reads an id and a text column and nothing else, so
further columns, whatever their names, cannot clash. A row is addressed by
``(__id, __rk)``: the id (null becomes ``NULL_ID``, the smallest long) and a
64-bit hash of the text. Rows that share both are exact repeats of each other
and get the same decisions.
"""

from __future__ import annotations

import gc

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise import session
from ridewise.session import scratch_path, ship_package  # noqa: F401
from ridewise.sources.tables import read_table  # noqa: F401

NULL_ID = -(2 ** 63)
WS_CLASS = r"[\x20\x09-\x0D]+"


#: Rows in an Arrow batch of texts: with the default of 10,000 a task may hold 100 MB of text several times over.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Ships the package to the workers and bounds Arrow batches."""
    ship_package(spark)
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def id_value(col: str = "__id") -> Column:
    """The id as the caller gave it: ``NULL_ID`` back to null."""
    return F.when(F.col(col) != F.lit(NULL_ID), F.col(col))


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id long, __rk long, __text string``; a null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("__id"),
                     F.xxhash64(text).alias("__rk"), text.alias("__text"))


def with_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df`` in one struct ``__row`` beside ``__id``, ``__rk``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
                     F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("__id"),
                     F.xxhash64(text).alias("__rk"))


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table. Spark removes a finished step's shuffle files
    once the driver has collected their handles; asking for that here keeps
    the executors' disks at the files of one step instead of all."""
    out = session.cut_lineage(df, name)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return out


def join_side(df: DataFrame, name: str) -> DataFrame:
    """An aggregated join side as a written table. Both inputs of the join are
    then plain exchanges, which adaptive execution can split at a hot key; an
    aggregate right below a join on its key prevents that."""
    return cut_lineage(df, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- in tasks

def hash_words(words) -> np.ndarray:
    """64-bit hashes of byte strings, in order."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, vectorised."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def kgram_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (length ``n - k + 1``).

    The polynomial over the word hashes is built by doubling, so it costs
    about 2 log2(k) vector operations and not k.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    mult = (0x9E3779B97F4A7C15 + 2 * seed * 0xD1342543DE82EF95) & (2 ** 64 - 1) | 1
    with np.errstate(over="ignore"):
        acc, have = None, 0
        block, size = mix64(h + np.uint64((seed * 0xA0761D6478BD642F) & (2 ** 64 - 1))), 1
        left = k
        while left:
            if left & 1:
                if acc is None:
                    acc, have = block, size
                else:                      # acc covers [i, i+have), append block at i+have
                    m = len(h) - have - size + 1
                    acc = acc[:m] * np.uint64(pow(mult, size, 2 ** 64)) + block[have:have + m]
                    have += size
            left >>= 1
            if left:
                m = len(h) - 2 * size + 1
                block = block[:m] * np.uint64(pow(mult, size, 2 ** 64)) + block[size:size + m]
                size *= 2
        return mix64(acc[:n])
