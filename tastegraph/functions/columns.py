"""Small scalar expressions: guarded ratios, clamps, rescales, canonical pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums below this size are rounding noise of cancelled terms and count as zero.
ZERO = 1e-12


def near_zero(value: Column) -> Column:
    return F.abs(value) < F.lit(ZERO)


def ratio_or(num: Column, den: Column, default: Column | float) -> Column:
    """``num / den``, or ``default`` where either side is zero, noise or missing."""
    fallback = default if isinstance(default, Column) else F.lit(float(default))
    usable = num.isNotNull() & den.isNotNull() & ~near_zero(num) & ~near_zero(den)
    return F.when(usable, num / den).otherwise(fallback)


def clamp(value: Column, low: float = 1.0, high: float = 5.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def stretch(value: Column, lo: Column, hi: Column, low: float, high: float) -> Column:
    """Map [lo, hi] linearly on [low, high]; a range of zero leaves the value unchanged."""
    return F.when(
        hi - lo > F.lit(0.0), (value - lo) * F.lit(high - low) / (hi - lo) + F.lit(low)
    ).otherwise(value)


def correlation(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Pearson r from the six sums; 0 where one side does not vary."""
    var_x = sxx - sx * sx / n
    var_y = syy - sy * sy / n
    flat = (var_x < F.lit(ZERO)) | (var_y < F.lit(ZERO))
    return F.when(flat, F.lit(0.0)).otherwise((sxy - sx * sy / n) / F.sqrt(var_x * var_y))


def tidy(value: Column, digits: int = 6) -> Column:
    """Round for comparison across engines; negative zero becomes zero."""
    rounded = F.round(value, digits)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
