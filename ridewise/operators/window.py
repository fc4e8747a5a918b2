"""Window operators: running sums, rolling means, ranks, top-k.

An un-partitioned window runs in one task. That is fine for per-day series
(bounded by the calendar), and ``distributed=True`` switches to a prefix-sum
plan that spreads any long series over range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.session import cut_lineage


def _order(cols: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def prefix_sums(df: DataFrame, order_cols: list[str], values: dict[str, str],
                num_partitions: int | None = None) -> DataFrame:
    """Distributed running sums.

    1. range-partition by the order key and write the rows with their
       partition number, so both later reads see the same partitions (two
       plans over one ``repartitionByRange`` may each sample bounds of their
       own); 2. running sums inside each partition; 3. per-partition totals
       (one row per partition) turned into offsets with a tiny window;
       4. broadcast the offsets back.
    The order key must be unique (ties have no defined running order).
    """
    n = num_partitions or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    r = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("__pid", F.spark_partition_id()), "ranges")
    w_loc = Window.partitionBy("__pid").orderBy(*_order(order_cols)).rowsBetween(Window.unboundedPreceding, 0)
    loc = r.select("*", *[F.sum(c).over(w_loc).alias(f"__loc_{o}") for o, c in values.items()])
    tot = r.groupBy("__pid").agg(*[F.sum(c).alias(f"__tot_{o}") for o, c in values.items()])
    w_off = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__pid", *[F.coalesce(F.sum(f"__tot_{o}").over(w_off), F.lit(0)).alias(f"__off_{o}")
                                 for o in values])
    out = loc.join(F.broadcast(offs), "__pid")
    for o in values:
        out = out.withColumn(o, F.col(f"__off_{o}") + F.col(f"__loc_{o}"))
    return out.drop("__pid", *[f"__loc_{o}" for o in values], *[f"__off_{o}" for o in values])


def cumulative(df: DataFrame, order_col: str, values: dict[str, str],
               distributed: bool = False) -> DataFrame:
    """running totals in ``order_col`` order (not restarted by filters
    applied afterwards)."""
    if distributed:
        return prefix_sums(df, [order_col], values)
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    for o, c in values.items():
        df = df.withColumn(o, F.sum(c).over(w))
    return df


def rolling_mean(df: DataFrame, order_col: str, value: str, n: int, out: str,
                 distributed: bool = False) -> DataFrame:
    """mean of the last ``n`` rows; null until ``n`` non-null values are
    in the window (pandas ``rolling(n).mean()``)."""
    if not distributed:
        w = Window.orderBy(order_col).rowsBetween(-(n - 1), 0)
        return df.withColumn(out, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))
    # Distributed: prefix sums of value, non-null count and row count; the
    # window sum is a difference of two prefix rows joined on row index.
    p = prefix_sums(df.withColumn("__one", F.lit(1))
                      .withColumn("__v", F.coalesce(F.col(value), F.lit(0.0)))
                      .withColumn("__nn", F.col(value).isNotNull().cast("int")),
                    [order_col], {"__rn": "__one", "__sv": "__v", "__cn": "__nn"})
    prev = p.select((F.col("__rn") + n).alias("__rn"), F.col("__sv").alias("__psv"), F.col("__cn").alias("__pcn"))
    j = p.join(prev, "__rn", "left")
    sv = F.col("__sv") - F.coalesce("__psv", F.lit(0.0))
    cn = F.col("__cn") - F.coalesce("__pcn", F.lit(0))
    return (j.withColumn(out, F.when((cn == n) & (F.col("__rn") >= n), sv / n))
             .drop("__one", "__v", "__nn", "__rn", "__sv", "__cn", "__psv", "__pcn"))


def rank_within(df: DataFrame, group: str | list[str], score: str, tie: str,
                out: str = "rank", descending: bool = True) -> DataFrame:
    """1-based rank inside each group, unique tie-break."""
    keys = [group] if isinstance(group, str) else group
    s = F.col(score).desc() if descending else F.col(score).asc()
    w = Window.partitionBy(*keys).orderBy(s, F.col(tie))
    return df.withColumn(out, F.row_number().over(w))


def top_n(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    """G1: global top-n (TakeOrderedAndProject: per-partition top-n, then a
    merge of n rows per partition)."""
    return df.orderBy(F.col(col).desc(), F.col(tie)).limit(n)


def top_k_per_group(df: DataFrame, group: str | list[str], score: str, tie: str, k: int | str,
                    max_k: int | None = None, out: str = "rank", descending: bool = True) -> DataFrame:
    """Top-k rows per group, k a literal or a per-row column.

    With a literal bound Spark inserts a partial WindowGroupLimit before the
    shuffle, so at most k rows per group leave each map task, which keeps a
    hot group cheap. A per-row ``k`` column is first capped by ``max_k``
    (a literal) for the same effect.
    """
    r = rank_within(df, group, score, tie, out, descending)
    if isinstance(k, int):
        return r.where(F.col(out) <= k)
    if max_k is not None:
        r = r.where(F.col(out) <= max_k)
    return r.where(F.col(out) <= F.col(k))
