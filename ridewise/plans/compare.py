"""Order-insensitive result comparison (Spark rows vs DuckDB rows)."""

from __future__ import annotations

import math


def norm(v, digits: int = 6):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(cols, rows, digits: int = 6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i], digits) for i in order) for r in rows), key=repr)


def compare(scols, srows, dcols, drows) -> str | None:
    """None when equal, else a short reason."""
    if sorted(scols) != sorted(dcols):
        return f"columns differ: {scols} vs {dcols}"
    if len(srows) != len(drows):
        return f"row counts differ: {len(srows)} vs {len(drows)}"
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"values differ, e.g. {diff}"
    return None
