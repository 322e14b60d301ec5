"""Calendar gap fill: daily calendar, linear interpolation, edge fill, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.expect import guard, key_violations


def calendar(bounds: DataFrame, start: str = "start", end: str = "end", out: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` (inclusive) of each row of ``bounds``.

    The day count is bounded by the date range, not by the data volume.
    """
    other = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(
        *other, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias(out)
    )


def _interpolate(
    date: Column, v: Column, prev_d: Column, prev_v: Column, next_d: Column, next_v: Column
) -> Column:
    span = F.datediff(next_d, prev_d)
    step = F.datediff(date, prev_d)
    linear = prev_v + (next_v - prev_v) * step / span
    return (
        F.when(v.isNotNull(), v)
        .when(prev_d.isNotNull() & next_d.isNotNull(), linear)
        .otherwise(F.coalesce(next_v, prev_v))
    )


def _known(date: str, value: str) -> Column:
    return F.when(F.col(value).isNotNull(), F.struct(F.col(date).alias("d"), F.col(value).alias("v")))


def fill_calendar(
    series: DataFrame,
    days: DataFrame,
    date: str = "date",
    value: str = "dcoilwtico",
    keys: tuple[str, ...] = (),
    bucket: str | None = "month",
    validate: bool = True,
) -> DataFrame:
    """Put ``series`` on the calendar ``days`` and fill every gap.

    Inside the known range a missing value is interpolated linearly in days between
    its known neighbours; before the first known value the first one is used, after
    the last the last one (backward, then forward fill). Series dates outside the
    calendar are dropped. ``validate`` asserts the series is unique per key and date
    (the 1:1 join of the reference).

    ``bucket=None`` uses windows over the whole series ordered by date, which puts one
    series on one task. ``bucket="month"`` (default) never does: it finds the first
    and last known point of every month, carries them across months on that small
    month table, and only then windows inside each month, so the day-level work
    spreads over (series, month) tasks.
    """
    keys = tuple(keys)
    s = series.select(*keys, date, value)
    if validate:
        s = guard(s, key_violations(s, [*keys, date]),
                  f"series is not unique on {[*keys, date]}")
    joined = days.join(s, on=[*keys, date], how="left")
    if bucket is None:
        return _fill_plain(joined, date, value, keys)
    return _fill_bucketed(joined, date, value, keys, bucket)


def _fill_plain(df: DataFrame, date: str, value: str, keys: tuple[str, ...]) -> DataFrame:
    base = Window.partitionBy(*keys).orderBy(date) if keys else Window.orderBy(date)
    w_prev = base.rowsBetween(Window.unboundedPreceding, 0)
    w_next = base.rowsBetween(0, Window.unboundedFollowing)
    known = _known(date, value)
    prev = F.last(known, ignorenulls=True).over(w_prev)
    nxt = F.first(known, ignorenulls=True).over(w_next)
    out = df.withColumn("_p", prev).withColumn("_n", nxt)
    return out.select(
        *keys,
        date,
        _interpolate(F.col(date), F.col(value), F.col("_p.d"), F.col("_p.v"),
                     F.col("_n.d"), F.col("_n.v")).alias(value),
    )


def _fill_bucketed(
    df: DataFrame, date: str, value: str, keys: tuple[str, ...], unit: str
) -> DataFrame:
    b = "_bucket"
    df = df.withColumn(b, F.trunc(date, unit))
    known = _known(date, value)
    # 1. First and last known point of each (series, bucket): one row per bucket.
    #    min/max and min_by/max_by over primitives keep this a hash aggregation.
    kd = F.when(F.col(value).isNotNull(), F.col(date))
    ends = df.groupBy(*keys, b).agg(
        F.min(kd).alias("_fd"), F.min_by(value, kd).alias("_fv"),
        F.max(kd).alias("_ld"), F.max_by(value, kd).alias("_lv"),
    ).select(
        *keys, b,
        F.when(F.col("_fd").isNotNull(), F.struct(F.col("_fd").alias("d"), F.col("_fv").alias("v")))
        .alias("_first"),
        F.when(F.col("_ld").isNotNull(), F.struct(F.col("_ld").alias("d"), F.col("_lv").alias("v")))
        .alias("_last"),
    )
    # 2. Carry across buckets on the small bucket table.
    wb = Window.partitionBy(*keys).orderBy(b) if keys else Window.orderBy(b)
    carried = ends.select(
        *keys,
        b,
        F.last("_last", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_cp"),
        F.first("_first", ignorenulls=True).over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_cn"),
    )
    # 3. Windows inside each bucket, falling back to the carried points.
    wd = Window.partitionBy(*keys, b).orderBy(date)
    prev = F.coalesce(F.last(known, ignorenulls=True).over(wd.rowsBetween(Window.unboundedPreceding, 0)),
                      F.col("_cp"))
    nxt = F.coalesce(F.first(known, ignorenulls=True).over(wd.rowsBetween(0, Window.unboundedFollowing)),
                     F.col("_cn"))
    out = df.join(carried, on=[*keys, b]).withColumn("_p", prev).withColumn("_n", nxt)
    return out.select(
        *keys,
        date,
        _interpolate(F.col(date), F.col(value), F.col("_p.d"), F.col("_p.v"),
                     F.col("_n.d"), F.col("_n.v")).alias(value),
    )


def assert_filled(df: DataFrame, value: str) -> DataFrame:
    """Fail the consuming job if any value is still null (all-null input series)."""
    return guard(df, df.where(F.col(value).isNull()),
                 f"gap fill left nulls in {value}: the series has no known value")


def gap_fill_metrics(
    series: DataFrame, filled: DataFrame, date: str = "date", value: str = "dcoilwtico"
) -> DataFrame:
    """Counts before and after the fill, in one row.

    ``fechas_diarias_agregadas`` is the net change used by the reference,
    ``final - (original - duplicates)``; ``fechas_nuevas`` counts calendar days that
    had no row in the series at all (an anti join), which differs when series rows
    fall outside the calendar.
    """
    before = series.agg(
        F.count(F.lit(1)).alias("filas_originales"),
        F.count_if(F.col(value).isNull()).alias("nulos_antes"),
    )
    distinct_rows = series.select(date, value).distinct().agg(F.count(F.lit(1)).alias("_d"))
    after = filled.agg(
        F.count(F.lit(1)).alias("filas_finales"),
        F.count_if(F.col(value).isNull()).alias("nulos_despues"),
    )
    new_days = filled.select(date).join(series.select(date), on=date, how="left_anti").agg(
        F.count(F.lit(1)).alias("fechas_nuevas")
    )
    dup = F.col("filas_originales") - distinct_rows.scalar()
    return before.select(
        F.col("filas_originales").cast("bigint").alias("filas_originales"),
        after.select("filas_finales").scalar().cast("bigint").alias("filas_finales"),
        (after.select("filas_finales").scalar() - (F.col("filas_originales") - dup))
        .cast("bigint").alias("fechas_diarias_agregadas"),
        new_days.scalar().cast("bigint").alias("fechas_nuevas"),
        dup.cast("bigint").alias("duplicados_eliminados"),
        F.col("nulos_antes").cast("bigint").alias("nulos_antes"),
        after.select("nulos_despues").scalar().cast("bigint").alias("nulos_despues"),
    )
