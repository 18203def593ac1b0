"""Value comparison and lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 1e-9


def values_equal(a: Column, b: Column, tol: float = TOLERANCE) -> Column:
    """NULL = NULL, NaN = NaN, infinities exact, otherwise close within a relative or
    absolute tolerance. Never NULL."""
    inf = F.lit(float("inf"))
    finite = (F.abs(a) < inf) & (F.abs(b) < inf)
    near = F.abs(a - b) <= F.greatest(F.lit(tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(tol))
    return F.coalesce(a.eqNullSafe(b) | (finite & near), F.lit(False))


def float_or(value: Column, default: float = 0.0) -> Column:
    """A number, or the default when the text is not one."""
    return F.coalesce(value.try_cast("double"), F.lit(default))


def distinct_from(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def round_half_up(value: Column, places: int) -> Column:
    """Decimal rounding, half away from zero, returned as a double."""
    return F.round(value.cast("decimal(38,12)"), places).cast("double")
