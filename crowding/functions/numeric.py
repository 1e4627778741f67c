"""Column-level numeric helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def stable_round(col, digits: int) -> Column:
    """Round half up on a fixed decimal grid, biased by 1e-4 of a unit.

    Sums of doubles differ in their last bits with summation order (and so
    between engines and runs). Snapping to ``digits`` decimals makes ranking
    ties and output values reproducible; the 0.5001 bias keeps values that sit
    exactly on a half from going different ways in different engines. Values
    whose grid steps a double can't count (from 2**53 of them on), NaN and
    infinities stay as they are.
    """
    scale = float(10**digits)
    steps = _c(col) * F.lit(scale) + F.lit(0.5001)
    return F.when(F.abs(steps) < F.lit(2.0**53), F.floor(steps) / F.lit(scale)).otherwise(
        _c(col).cast("double")
    )


def rank_key(col) -> Column:
    """The value with its 41 leading bits, about 12 significant digits.

    Sums of doubles differ in their last bits with the order of summation;
    ranks and top-k compare this key, so such differences make no order. The
    grid is relative: small values keep as many digits as large ones.
    """
    x = _c(col).cast("double")
    up = x * F.lit(4097.0)
    return F.when(F.abs(x) < F.lit(1e300), up - (up - x)).otherwise(x)


def safe_div(num, den) -> Column:
    """Division that yields null on a zero or null denominator (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def weighted_mean(x, w) -> Column:
    """Aggregate: sum(x*w) / sum(w).

    A null ``x`` leaves the numerator but its weight still counts in the
    denominator (the reference behaviour, kept on purpose).
    """
    return safe_div(F.sum(_c(x) * _c(w)), F.sum(_c(w)))


def hhi_from_moments(sum_sq, total) -> Column:
    """Herfindahl index from the first two moments of the shares' parts.

    sum over hours of (r_h / T)^2 equals (sum r_h^2) / T^2, so the index needs
    only two additive aggregates and no window over hour rows.
    """
    t = _c(total)
    return safe_div(_c(sum_sq), t * t)


def is_missing(col, dtype) -> Column:
    """Null test that also counts NaN on floating columns."""
    c = _c(col)
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def round_doubles(df, digits: int = 6):
    """Snap every double column of ``df`` with ``stable_round``."""
    cols = [
        stable_round(F.col(n), digits).alias(n) if t in ("double", "float") else F.col(n)
        for n, t in df.dtypes
    ]
    return df.select(*cols)
