"""Column expressions shared by the operators. All JVM-side, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scale of reported float results: registered queries round to it once, after every filter and sort.
RESULT_DECIMALS = 6


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column) -> Column:
    """Round a float result to the report scale."""
    return F.round(col(c), RESULT_DECIMALS)


def rounded(df: DataFrame) -> DataFrame:
    """Every double column at the report scale, for results that are compared or printed."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: r6(c) for c in doubles})


def is_finite(c: str | Column) -> Column:
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def pct_change_expr(new: str | Column, base: str | Column) -> Column:
    """100 * (new - base) / base; null when a side is null or the base is 0."""
    return F.try_multiply(F.try_divide(col(new) - col(base), col(base)), F.lit(100.0))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over the rows where both sides are present.

    Null (not an error, not NaN) when a side is constant or there is one pair:
    ANSI ``corr`` raises on a zero variance, so the ratio is formed with try_divide.
    """
    both = col(x).isNotNull() & col(y).isNotNull()
    xs = F.when(both, col(x).cast("double"))
    ys = F.when(both, col(y).cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def sorted_distinct_join(c: str | Column, sep: str = ", ") -> Column:
    """Distinct non-null values, sorted, joined by ``sep`` ('' when all are null)."""
    return F.array_join(F.array_sort(F.collect_set(col(c))), sep)


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(col(c), "month")


def any_true(c: str | Column) -> Column:
    """bool_or that is false, not null, for an all-null group."""
    return F.coalesce(F.bool_or(col(c)), F.lit(False))
