"""Score scales. All take and give double columns; a null gives null."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _finite(*bounds: float) -> None:
    if not all(math.isfinite(b) for b in bounds):
        raise ValueError(f"bounds must be finite: {bounds}")


def exact_round(v: Column, digits: int) -> Column:
    """v at so many decimals, by the exact value of the double and half to even on true ties; F.round() goes by its shortest decimal form, half up.

    The product with the power of ten is taken together with its rounding error (Dekker's product), which decides
    where the product itself ends on a half. Values too large for a fraction, infinities and NaN stay.
    """
    scale = 10.0**digits
    p = v * scale

    def halves(x):
        t = x * 134217729.0
        high = t - (t - x)
        return high, x - high

    (a, b), (c, d) = halves(v), halves(scale)
    error = (a * c - p) + a * d + b * c + b * d
    low = F.floor(p).cast("double")
    tie = F.when(error > 0, low + 1.0).when(error < 0, low).otherwise(F.rint(p))
    return F.when(F.isnan(v) | (F.abs(p) >= float(2**52)), v).otherwise(F.when(p - low == 0.5, tie).otherwise(F.rint(p)) / scale)


def interpolated(values: Column, q: float) -> Column:
    """The quantile q of an array of doubles, interpolated linearly between neighbours as low + (high - low) * t; null for an empty one."""
    rows = F.array_sort(values)
    place = (F.size(rows) - 1) * F.lit(float(q))
    low = F.floor(place).cast("int")
    a, b = F.get(rows, low), F.get(rows, F.least(low + 1, F.size(rows) - 1))
    return a + (b - a) * (place - low)


def clamp01(v: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))


def trapezoid_scale(v: Column, a: float, b: float, c: float, d: float) -> Column:
    """0 outside (a, d), 1 on [b, c], linear between."""
    _finite(a, b, c, d)
    if not a < b <= c < d:
        raise ValueError("bounds must satisfy a < b <= c < d")
    return (
        F.when(v.isNull(), None)
        .when((v <= a) | (v >= d), 0.0)
        .when(v < b, (v - a) / (b - a))
        .when(v > c, (d - v) / (d - c))
        .otherwise(1.0)
    )


def linear_growth(v: Column, low: float, high: float) -> Column:
    """0 up to low, 1 from high, linear between."""
    _finite(low, high)
    if low >= high:
        raise ValueError("low must be below high")
    return F.when(v.isNotNull(), clamp01((v - low) / (high - low)))


def linear_decay(v: Column, low: float, high: float) -> Column:
    """1 up to low, 0 from high, linear between."""
    return 1.0 - linear_growth(v, low, high)


def exp_saturation(v: Column, half: float) -> Column:
    """0 for v <= 0, a half at `half`, towards 1 beyond."""
    _finite(half)
    if half <= 0:
        raise ValueError("half must be positive")
    return F.when(v <= 0, 0.0).otherwise(1.0 - F.exp(-math.log(2.0) * v / half))


def motion_score(mean_motion: Column, cut_ratio: Column) -> Column:
    return exp_saturation(mean_motion, 8.0) * linear_decay(cut_ratio, 0.0, 0.05)


def text_score(area_quantile: Column) -> Column:
    return clamp01(1.0 - area_quantile)


def l2_normalised(v: Column) -> Column:
    """Unit-length array of doubles; null for a vector of zeros."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm))


def frame_rate(text: Column) -> Column:
    """'30000/1001' or '25' as frames per second; null if malformed or not positive."""
    parts = F.split(text, "/")
    rate = F.try_divide(F.expr("1D") * parts[0].try_cast("double"), F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.when(F.size(parts) == 1, F.lit(1.0))))
    return F.when(rate > 0, rate)


def seconds_to_frames(seconds: Column, fps: Column) -> Column:
    """Half-even rounding, one frame at least; a null rate counts as 24."""
    return F.greatest(F.lit(1), F.rint(seconds * F.coalesce(fps, F.lit(24.0))).cast("int"))
