"""Encoders: declared-order ordinal codes, weather codes, alphabetical codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise.constants import WEATHER
from ridewise.sources.tables import maybe_broadcast


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordinal_code(c, values: list[str]) -> Column:
    """Position of the value in a declared list (0-based); unknown -> null."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), _c(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def weather_code(c) -> Column:
    return ordinal_code(c, WEATHER)


def fit_alphabetical(df: DataFrame, cols: list[str], code_name: str = "code") -> DataFrame:
    """Fit an alphabetical label encoder on the union of ``cols``.

    Returns a (value, code) table: code = rank of the value among the sorted
    distinct non-null values, 0-based. The distinct step is a partial
    aggregation, and the ranks are a distributed prefix sum, so neither a task
    nor the driver sees all values of a column with many.
    """
    from ridewise.operators.lookup import dense_index
    vals = None
    for c in cols:
        v = df.select(F.col(c).alias("value")).where(F.col("value").isNotNull())
        vals = v if vals is None else vals.unionByName(v)
    return dense_index(vals, "value", "__code").select("value", F.col("__code").cast("int").alias(code_name))


def apply_codes(df: DataFrame, codes: DataFrame, col: str, out: str,
                handle_invalid: str = "keep_null") -> DataFrame:
    """Join the fitted code table onto ``col`` (broadcast if its size allows).

    ``handle_invalid="error"`` mirrors a strict encoder: an unseen value makes
    the job fail when the result is computed.
    """
    c = codes.select(F.col("value").alias(col), F.col(codes.columns[1]).alias(out))
    res = df.join(maybe_broadcast(c), on=col, how="left")
    if handle_invalid == "error":
        res = res.withColumn(out, F.when(F.col(out).isNull() & F.col(col).isNotNull(),
                                         F.raise_error(F.concat(F.lit("unseen label: "), F.col(col))))
                             .otherwise(F.col(out)))
    return res
