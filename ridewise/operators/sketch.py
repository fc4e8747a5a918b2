"""Mergeable quantile sketches: approximate quantiles of tables too large, or
kept too long, for the exact operator (``stats.percentile``, which stays exact at
every size; this one is chosen by name, never by size).

A sketch is Spark's KLL state, one binary a group. Groups of a day may be stored
and merged later into weeks or months without reading rows again. A quantile's
rank is off by at most ``rank_error(k)`` of the rows, with 99 % confidence a
quantile; a group of fewer than ``k`` rows is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 400


def rank_error(k: int = DEFAULT_K) -> float:
    """The error of a rank, as a share of the rows (99 %, one-sided)."""
    return 2.296 / k ** 0.9021


def sketch(df: DataFrame, value: str, groups: list[str], k: int = DEFAULT_K, out: str = "sketch") -> DataFrame:
    """One sketch a group, built map-side and merged by Spark. Null and NaN values are left out."""
    v = F.nanvl(F.col(value).cast("double"), F.lit(None))
    return df.select(*groups, v.alias("__v")).where(F.col("__v").isNotNull()).groupBy(*groups).agg(
        F.kll_sketch_agg_double("__v", k).alias(out))


def merge(sketches: DataFrame, groups: list[str], k: int = DEFAULT_K, out: str = "sketch") -> DataFrame:
    """Sketches of finer groups merged into those of coarser ones."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double(out, k).alias(out))


def quantiles(sketches: DataFrame, ps: list[float], col: str = "sketch") -> DataFrame:
    """Adds ``n``, and ``quantiles``, one value for each of ``ps``."""
    got = [F.kll_sketch_get_quantile_double(F.col(col), F.lit(float(p))) for p in ps]
    return sketches.withColumns({"n": F.kll_sketch_get_n_double(col), "quantiles": F.array(*got)})
