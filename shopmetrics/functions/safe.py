"""ANSI-safe column helpers (Spark 4 runs with spark.sql.ansi.enabled=true)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """x / y, NULL when y is 0 or NULL (pandas would give inf/NaN)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def one_if_zero(c) -> Column:
    """pandas ``Series.replace(0, 1)``."""
    c = col_(c)
    return F.when(c == 0, F.lit(1)).otherwise(c)


def safe_corr(x, y) -> Column:
    """Pearson correlation that gives NULL (not an ANSI error) for constant or one-row groups.

    Both inputs are masked to NULL unless both are present, as ``corr`` does pairwise.
    """
    x, y = col_(x).cast("double"), col_(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xm, ym = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def sum_null_as_zero(c) -> Column:
    """sum(when(c is not null, c) else 0): 0 instead of NULL for an all-NULL group."""
    return F.sum(F.coalesce(col_(c).cast("double"), F.lit(0.0)))


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(~F.isnan(c), c)
