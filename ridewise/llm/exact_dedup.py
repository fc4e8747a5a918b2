"""Exact deduplication by a tree merge of sorted digest runs (native).

Every input partition is a run of digests. A round deals the runs out by
``(run group, digest)``; before the exchange each task sorts what it holds and
merges equal digests (Spark's partial sort aggregate), afterwards the runs of
``fan`` partners are merged the same way. Runs ``r`` and ``r'`` belong to one
group of round ``i`` when ``r // fan**i == r' // fan**i``, so after
``ceil(log_fan(runs))`` rounds one group is left and each digest has one row.
A row holds the smallest identifier and the number of copies so far; a group
of copies that fills a third of the corpus leaves each task of each round as
one row.

"Verified": rows merge only when SHA-256, byte length and a second 64-bit hash
all agree, so a broken digest splits a group and never joins two texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import WS_CLASS, cut_lineage, join_side

VERIFY = ["__digest", "__bytes", "__check"]


def digest_runs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document, written once: id, digest, byte length,
    second hash, and an ordinal whose upper bits are the run number."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), WS_CLASS, " ")
    rows = (df.select(F.col(id_col).cast("long").alias("__id"), norm.alias("__norm"))
              .select("__id", F.unhex(F.sha2("__norm", 256)).alias("__digest"),
                      F.octet_length("__norm").alias("__bytes"), F.xxhash64("__norm").alias("__check"),
                      F.monotonically_increasing_id().alias("__ord")))
    return cut_lineage(rows, "digest-runs")


def merge_runs(runs: DataFrame, fan: int = 16) -> DataFrame:
    """Binomial merge rounds over ``runs``; one row per distinct text with
    ``__best`` (null flag, smallest id, its ordinal) and ``__copies``."""
    last = runs.agg(F.max(F.shiftright("__ord", 33))).first()[0]
    state = runs.select(F.shiftright("__ord", 33).alias("__run"), *VERIFY, F.lit(1).cast("long").alias("__copies"),
                        F.struct(F.col("__id").isNull().alias("is_null"), F.col("__id").alias("id"),
                                 F.col("__ord").alias("ord")).alias("__best"))
    width = (last or 0) + 1
    while True:
        state = (state.withColumn("__run", F.expr(f"__run div {fan}")).groupBy("__run", *VERIFY)
                      .agg(F.sum("__copies").alias("__copies"), F.min("__best").alias("__best")))
        width = -(-width // fan)
        if width <= 1:
            return state.drop("__run")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = 16) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space
    becomes one space. The row with the smallest id stays.

    * null text: as an empty text; empty texts are equal to each other
    * null id: larger than any id, so it stays only if all copies have none
    * repeated rows (same id, same text): exactly one of them is kept
    * empty table: empty result
    * other columns are not read
    """
    if fan < 2:
        raise ValueError("fan must be at least 2")
    runs = digest_runs(df, id_col, text_col)
    groups = join_side(merge_runs(runs, fan).where(F.col("__copies") > 1), "copies")
    joined = runs.join(groups, VERIFY, "left")
    return joined.select(F.col("__id").alias(id_col),
                         F.coalesce(F.col("__best.id"), F.col("__id")).alias("keep_id"),
                         F.coalesce(F.col("__copies"), F.lit(1)).cast("long").alias("group_size"),
                         F.coalesce(F.col("__best.ord") == F.col("__ord"), F.lit(True)).alias("kept"),
                         F.lower(F.hex("__digest")).alias("text_sha256"))
