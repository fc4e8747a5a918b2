"""Small derived-column expressions (projection layer)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """least/greatest skip nulls, so a null input must stay null explicitly."""
    x = _c(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def safe_div(num, den) -> Column:
    """Division that gives null instead of failing under ANSI mode."""
    return F.try_divide(_c(num), _c(den))


def demand_supply_ratio(pending, active) -> Column:
    return F.round(_c(pending) / (_c(active) + F.lit(1)), 2)


def fare_distance_ratio(fare, distance) -> Column:
    return F.round(_c(fare) / F.greatest(_c(distance), F.lit(0.1)), 2)


def duration_from_speed(distance, speed) -> Column:
    """Minutes from distance and speed, then clipped to 1..120."""
    raw = F.round(_c(distance) / F.greatest(_c(speed), F.lit(5.0)) * 60, 1)
    return clip(raw, 1.0, 120.0)


def driver_utilisation(trips, drivers) -> Column:
    return F.least(F.lit(0.97), _c(trips) / (_c(drivers) * 6 + 1))


def value_map(c, mapping: dict) -> Column:
    """Map values through a literal dictionary; unmapped values give null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def format_id(prefix: str, width: int, c) -> Column:
    return F.format_string(f"{prefix}%0{width}d", _c(c))


def supply_count(ratio, scale: int = 80) -> Column:
    """int(ratio * scale): truncation toward zero."""
    return (_c(ratio) * scale).cast("int")


def list_flag(list_str, value: str, sep: str = ",") -> Column:
    """1 when ``value`` is one element of a comma-joined list string."""
    return F.coalesce(F.array_contains(F.split(_c(list_str), sep), F.lit(value)).cast("int"), F.lit(0))


def scaled(c, divisor: float) -> Column:
    return _c(c) / F.lit(float(divisor))


def round_half_up(c, digits: int) -> Column:
    """Round half up on the binary value: floor(x * 10^d + 0.5) / 10^d.

    Every engine computes this with the same IEEE operations, so results are
    identical everywhere (``round`` differs between engines exactly at ties).
    """
    p = float(10 ** digits)
    return F.floor(_c(c) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def money(c, digits: int = 0) -> Column:
    """``$1,234`` style label (thousands separators, fixed decimals)."""
    return F.concat(F.lit("$"), F.format_number(_c(c), digits))


def percent(c, digits: int = 1) -> Column:
    """``12.3%`` style label of a ratio."""
    return F.concat(F.format_number(_c(c) * 100, digits), F.lit("%"))


def hour_label(c) -> Column:
    """``HH:00`` label of an hour."""
    return F.format_string("%02d:00", _c(c))
