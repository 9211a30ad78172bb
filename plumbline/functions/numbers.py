"""Rounding, cleaning and naming of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def significant(x: Column, digits: int = 4) -> Column:
    """Rounded to ``digits`` significant figures; 0 stays 0."""
    return F.when(x.isNotNull(), F.format_string(f"%.{digits - 1}e", x.cast("double")).try_cast("double"))


def finite(x: Column, digits: int = 6) -> Column:
    """NaN and -inf to 0, inf to 1, rounded."""
    inf = float("inf")
    return F.round(F.when(F.isnan(x) | (x == -inf), 0.0).when(x == inf, 1.0).otherwise(x), digits)


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def size_of(n: Column) -> Column:
    """Bytes in thousands with a unit."""
    out = F.format_string("%.1f TB", n / 1e12)
    for unit, scale in (("GB", 1e9), ("MB", 1e6), ("KB", 1e3)):
        out = F.when(n < scale * 1000, F.format_string(f"%.1f {unit}", n / scale)).otherwise(out)
    return F.when(n < 1000, F.format_string("%d B", n.cast("long"))).otherwise(out)


def metric_name(prefix: str, name: str) -> str:
    return prefix + "".join(w[:1].upper() + w[1:] for w in name.split("_")) + "Score"
