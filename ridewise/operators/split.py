"""Deterministic splits and samples keyed by an md5 hash of the row key.

Hash-based assignment is stable under repartitioning and re-execution (an
executor lost mid-job recomputes the same split) and is expressible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_hash(key) -> Column:
    """First 32 bits of md5(key) as a non-negative bigint."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, test_pct: int = 20, out: str = "split") -> DataFrame:
    """Test when hash mod 100 < test_pct."""
    b = F.pmod(key_hash(key), F.lit(100))
    return df.withColumn("bucket", b.cast("int")).withColumn(
        out, F.when(F.col("bucket") < test_pct, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.2,
                     out: str = "split", bucket_bits: int = 16) -> DataFrame:
    """Exactly round(test_frac * n_class) rows of each class go to test:
    the rows with the smallest (hash, key) in their class.

    Exact without a per-class global sort: hashes are bucketed (2^bits
    buckets), bucket counts are aggregated (small table), cumulative counts
    locate the boundary bucket of each class, and only the rows of that one
    bucket are ranked. No task ever holds a whole class.
    """
    h = df.withColumn("__h", key_hash(key)).withColumn("__b", F.shiftright(F.col("__h"), 32 - bucket_bits))
    counts = h.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    wc = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    wt = Window.partitionBy(label)
    c = (counts.withColumn("__cum", F.sum("__cnt").over(wc))
               .withColumn("__n", F.sum("__cnt").over(wt))
               .withColumn("__k", F.floor(F.col("__n") * F.lit(test_frac) + F.lit(0.5))))
    # boundary bucket: first bucket whose cumulative count reaches k
    bnd = (c.where(F.col("__cum") >= F.col("__k"))
            .groupBy(label).agg(F.min(F.struct("__b", "__cum", "__cnt", "__k")).alias("__s"))
            .select(label, F.col("__s.__b").alias("__bb"),
                    (F.col("__s.__k") - (F.col("__s.__cum") - F.col("__s.__cnt"))).alias("__take")))
    # only the boundary bucket's rows (about n / 2^bits a class) are ranked; the
    # last one taken is the class's cut, and every row is compared with it
    edge = h.join(F.broadcast(bnd), label).where(F.col("__b") == F.col("__bb")).select(
        label, "__take", F.struct(F.col("__h"), F.col(key)).alias("__cut"))
    w = Window.partitionBy(label).orderBy("__cut")
    cut = edge.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == F.col("__take")).select(label, "__cut")
    # one row a class
    j = h.join(F.broadcast(bnd.join(cut, label, "left")), label, "left")
    in_test = F.when(F.col("__b") < F.col("__bb"), F.lit(True)) \
               .when(F.col("__b") > F.col("__bb"), F.lit(False)) \
               .otherwise(F.coalesce(F.struct(F.col("__h"), F.col(key)) <= F.col("__cut"), F.lit(False)))
    return (j.withColumn(out, F.when(in_test, F.lit("test")).otherwise(F.lit("train")))
             .drop("__h", "__b", "__bb", "__take", "__cut"))


def hash_sample(df: DataFrame, key: str | list[str], n: int) -> DataFrame:
    """N rows with the smallest key hash (a sampling operator; the limit
    is the feature). Runs as a per-partition top-n and a merge of n rows per
    partition."""
    keys = [key] if isinstance(key, str) else key
    h = key_hash(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("__h", h).orderBy("__h", *keys).limit(n).drop("__h")
