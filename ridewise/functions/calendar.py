"""Calendar and cyclical features (column expressions, all JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridewise.constants import FARE_EVENING_HOURS, FARE_MORNING_HOURS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def weekday_of(ts) -> Column:
    """Day of week with Monday = 0 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(ts)).cast("int")


def month_of(ts) -> Column:
    return F.month(_c(ts)).cast("int")


def is_weekend(dow) -> Column:
    return (_c(dow) >= 5).cast("int")


def is_night(hour) -> Column:
    h = _c(hour)
    return ((h >= 22) | (h <= 5)).cast("int")


def is_rush_hour(hour) -> Column:
    return _c(hour).isin(FARE_MORNING_HOURS + FARE_EVENING_HOURS).cast("int")


def cyclical(c, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    angle = F.lit(2 * math.pi) * _c(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def day_name(d) -> Column:
    """Full weekday name (Monday ... Sunday)."""
    return F.date_format(_c(d), "EEEE")


def week_ending_sunday(d) -> Column:
    """Label of a week that ends on Sunday: the Sunday on or after ``d``."""
    return F.next_day(F.date_sub(_c(d), 1), "Sun")


def add_time_parts(df, ts_col: str = "ts"):
    """hour, day_of_week (Mon=0), month, is_weekend, is_night, is_rush_hour."""
    # two projections (withColumns), not six chained withColumn calls
    d = df.withColumns({"hour": hour_of(ts_col), "day_of_week": weekday_of(ts_col), "month": month_of(ts_col)})
    return d.withColumns({"is_weekend": is_weekend("day_of_week"), "is_night": is_night("hour"),
                          "is_rush_hour": is_rush_hour("hour")})


def add_cyclical(df, cols_periods: dict[str, tuple[str, float]]):
    """``{"hour": ("hour", 24), ...}`` adds ``<name>_sin`` / ``<name>_cos``."""
    cols = {}
    for name, (src, period) in cols_periods.items():
        s, c = cyclical(src, period)
        cols[f"{name}_sin"], cols[f"{name}_cos"] = s, c
    return df.withColumns(cols)
