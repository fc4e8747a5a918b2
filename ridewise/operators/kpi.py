"""KPI roll-ups: cards, frequency tables, group means, resampling, pivots.

All of these are hash aggregations with map-side partial combine; the only
shuffle carries one partial row per (partition, group). Null group keys are
dropped, as a pandas ``groupby`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.functions.calendar import day_name, week_ending_sunday


def kpi_cards(df: DataFrame, sums: dict[str, str] | None = None,
              means: dict[str, str] | None = None,
              maxes: dict[str, str] | None = None) -> DataFrame:
    """One-row KPI table. Dicts map output name -> input column."""
    aggs: list[Column] = []
    for out, c in (sums or {}).items():
        aggs.append(F.sum(c).alias(out))
    for out, c in (means or {}).items():
        aggs.append(F.avg(c).alias(out))
    for out, c in (maxes or {}).items():
        aggs.append(F.max(c).alias(out))
    return df.agg(*aggs)


def frequency(df: DataFrame, key: str, count_name: str = "count") -> DataFrame:
    """E5: value counts, descending count, ties by key."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.col(count_name).desc(), F.col(key)))


def group_mean_count(df: DataFrame, key: str, value: str,
                     mean_name: str = "mean", count_name: str = "count",
                     ascending: bool = True) -> DataFrame:
    """Mean and non-null count per group, sorted by the mean."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.avg(value).alias(mean_name), F.count(value).alias(count_name)))
    order = F.col(mean_name).asc() if ascending else F.col(mean_name).desc()
    return out.orderBy(order, F.col(key))


def group_sum(df: DataFrame, key: str | list[str], values: dict[str, str]) -> DataFrame:
    """Sums per group (null keys dropped)."""
    keys = [key] if isinstance(key, str) else key
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond).groupBy(*keys).agg(*[F.sum(c).alias(o) for o, c in values.items()])


def with_share(df: DataFrame, value: str, share_name: str = "share") -> DataFrame:
    """Share of the grand total. The total is a one-row aggregate that is
    broadcast back; no global window (which would run in one task)."""
    total = df.agg(F.sum(value).alias("__total"))
    return (df.crossJoin(F.broadcast(total))
              .withColumn(share_name, F.try_divide(F.col(value), F.col("__total")))
              .drop("__total"))


def weekly_resample(df: DataFrame, date_col: str, values: dict[str, str],
                    week_col: str = "week", fill_empty: bool = True) -> DataFrame:
    """Weeks end on Sunday and are labelled by that Sunday.

    Empty weeks inside the range get 0, as a resample-sum does. Gaps are
    filled from the weekly table itself: each week row also emits the empty
    weeks up to the next present week (``lead`` over the week rows, whose
    count is bounded by the calendar), so the source is aggregated once.
    """
    wk = (df.where(F.col(date_col).isNotNull())
            .groupBy(week_ending_sunday(date_col).alias(week_col))
            .agg(*[F.sum(c).alias(o) for o, c in values.items()]))
    if not fill_empty:
        return wk
    nxt = F.lead(week_col).over(Window.orderBy(week_col))
    g = wk.withColumn("__next", nxt)
    last = F.coalesce(F.date_sub("__next", 7), F.col(week_col))
    e = g.withColumn("__wk", F.explode(F.sequence(F.col(week_col), last, F.expr("INTERVAL 7 DAYS"))))
    return e.select(F.col("__wk").alias(week_col),
                    *[F.when(F.col("__wk") == F.col(week_col), F.col(o)).otherwise(F.lit(0)).alias(o)
                      for o in values])


def pivot_mean(df: DataFrame, row: str, col: str, value: str, col_values: list) -> DataFrame:
    """Row x col -> mean; a missing cell is null. Column values are
    given, so Spark needs no extra pass to discover them."""
    return (df.where(F.col(row).isNotNull()).groupBy(row)
              .pivot(col, col_values).agg(F.avg(value)))


def pivot_count_ordered(df: DataFrame, row: str, date_col: str, order: list[str]) -> DataFrame:
    """Row x weekday-name counts, columns Monday..Sunday, only the days
    present; a missing cell is null (not 0)."""
    d = df.where(F.col(row).isNotNull() & F.col(date_col).isNotNull()).withColumn("__day", day_name(date_col))
    present = {r[0] for r in d.select("__day").distinct().collect()}   # at most 7 names
    cols = [x for x in order if x in present]
    p = d.groupBy(row).pivot("__day", cols).agg(F.count(F.lit(1)))
    return p.select(row, *cols)


def period_change(df: DataFrame, date_col: str, value: str,
                  first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Sums of two date ranges (inclusive) and the relative change."""
    d = F.col(date_col)
    in1 = (d >= F.lit(first[0]).cast("date")) & (d <= F.lit(first[1]).cast("date"))
    in2 = (d >= F.lit(second[0]).cast("date")) & (d <= F.lit(second[1]).cast("date"))
    out = df.where(in1 | in2).agg(F.sum(F.when(in1, F.col(value))).alias("first_total"),
                 F.sum(F.when(in2, F.col(value))).alias("second_total"))
    return out.withColumn("pct_change",
                          F.try_divide(F.col("second_total") - F.col("first_total"), F.col("first_total")) * 100)
