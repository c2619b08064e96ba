"""Row-wise statistics over a fixed list of columns, NULL-skipping.

Spark has no row-wise std; these are closed forms over the non-null count so
they stay plain codegen'd expressions (no arrays, no UDF).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip_lower(x: Column, lower: float = 0.0) -> Column:
    """``x`` clipped below at ``lower``; NULL stays NULL (unlike ``greatest``)."""
    return F.when(x < F.lit(lower), F.lit(lower)).otherwise(x)


def clip_upper(x: Column, upper: float) -> Column:
    return F.when(x > F.lit(upper), F.lit(upper)).otherwise(x)


def flag(cond: Column) -> Column:
    """Boolean condition → tinyint 0/1 with NULL counted as 0."""
    return F.coalesce(cond, F.lit(False)).cast("tinyint")


def row_count(cols) -> Column:
    return reduce(lambda a, b: a + b, [F.when(_c(c).isNotNull(), 1).otherwise(0) for c in cols])


def row_sum(cols) -> Column:
    """Sum of non-null values; NULL when all are NULL."""
    total = reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0.0)) for c in cols])
    return F.when(row_count(cols) > 0, total)


def row_mean(cols) -> Column:
    n = row_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def row_std(cols, ddof: int = 1, mean: Column | None = None) -> Column:
    """Sample standard deviation over non-null values (NULL when n <= ddof).

    Pass ``mean`` (an already projected row-mean column) to keep the
    generated code small."""
    n = row_count(cols)
    mean = row_mean(cols) if mean is None else mean
    ss = reduce(
        lambda a, b: a + b,
        [F.when(_c(c).isNotNull(), (_c(c) - mean) * (_c(c) - mean)).otherwise(F.lit(0.0)) for c in cols],
    )
    return F.when(n > ddof, F.sqrt(ss / (n - ddof)))


def row_min(cols) -> Column:
    return F.least(*[_c(c) for c in cols])


def row_max(cols) -> Column:
    return F.greatest(*[_c(c) for c in cols])


def row_rms(cols) -> Column:
    """sqrt(mean(x^2)) over non-null values."""
    n = row_count(cols)
    ss = reduce(lambda a, b: a + b, [F.coalesce(_c(c) * _c(c), F.lit(0.0)) for c in cols])
    return F.when(n > 0, F.sqrt(ss / n))


def row_abs_sum(cols) -> Column:
    total = reduce(lambda a, b: a + b, [F.coalesce(F.abs(_c(c)), F.lit(0.0)) for c in cols])
    return total
