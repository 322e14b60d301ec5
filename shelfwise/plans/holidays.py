"""Holiday impact: holiday vs normal days, ±3-day event windows, family sensitivity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import is_finite, pct_change_expr
from shelfwise.functions.exact import totals
from shelfwise.operators.expect import require_columns, require_rows
from shelfwise.operators.ranking import listed, top
from shelfwise.plans.cells import SALES, dimensions, measure
from shelfwise.sources.sinks import materialize_small

FLAG = "es_feriado_nacional"
# Fixed values of the reference: days around a holiday (the day itself excluded).
WINDOW_OFFSETS = [-3, -2, -1, 1, 2, 3]


def _flagged(df: DataFrame) -> DataFrame:
    require_columns(df, dimensions(df, "date", "family", FLAG), "fact")
    return df.withColumn(FLAG, F.coalesce(F.col(FLAG), F.lit(False)))


def holiday_dates(df: DataFrame) -> DataFrame:
    """Distinct national-holiday dates in the fact."""
    return _flagged(df).where(F.col(FLAG)).select("date").distinct()


def _daily(df: DataFrame) -> DataFrame:
    return totals(_flagged(df), ["date", FLAG], SALES, "ventas_diarias").select("date", FLAG, "ventas_diarias")


def _mean() -> Column:
    """Mean over all rows of a total, days without a known value included."""
    return F.try_divide("ventas_totales", F.col("_rows").cast("double"))


def holiday_vs_normal(df: DataFrame) -> DataFrame:
    """Daily totals per flag, then per flag: total, daily mean and median, days.

    The median is over days (bounded by the calendar), so Spark's exact ``median``
    is used directly.
    """
    daily = _daily(df)
    medians = daily.groupBy(FLAG).agg(F.median("ventas_diarias").alias("venta_mediana_diaria"))
    return totals(daily, [FLAG], "ventas_diarias", "ventas_totales").join(medians, FLAG).select(
        FLAG, "ventas_totales", _mean().alias("venta_promedio_diaria"), "venta_mediana_diaria", F.col("_rows").alias("cantidad_dias"))


def holiday_change(df: DataFrame) -> DataFrame:
    """One row: mean daily sales on holidays and normal days, and the % change."""
    means = totals(_daily(df), [FLAG], "ventas_diarias", "ventas_totales").withColumn("m", _mean())
    return means.agg(F.max(F.when(F.col(FLAG), F.col("m"))).alias("promedio_feriado"), F.max(F.when(~F.col(FLAG), F.col("m"))).alias("promedio_normal")).withColumn(
        "cambio_porcentual", pct_change_expr("promedio_feriado", "promedio_normal"))


def holiday_window(df: DataFrame, offsets: list[int] = WINDOW_OFFSETS) -> DataFrame:
    """Sales per family on each day around each holiday, summarised across holidays.

    The offsets are exploded on the holiday side (dates x 6 rows) and joined to the
    fact by equality on the shifted date: an interval join without a theta join.
    That small table is materialized first so the join is planned on its real size
    (broadcast under the threshold) instead of shuffling the fact by date.
    A day near two holidays counts for both; days outside the data vanish.
    """
    f = _flagged(df)
    dates = require_rows(holiday_dates(f), 1, "no national holiday in the fact")
    windows = materialize_small(dates.select(
        F.col("date").alias("fecha_feriado"),
        F.explode(F.array(*[F.lit(k) for k in offsets])).alias("dias_relativo_feriado"),
    ).withColumn("date", F.date_add("fecha_feriado", F.col("dias_relativo_feriado"))), "holiday_windows")
    near = f.select("date", "family", *measure(f)).join(windows, on="date")
    # One row per holiday, offset and family: bounded by the calendar.
    per_event = materialize_small(totals(near, ["fecha_feriado", "family", "dias_relativo_feriado"], SALES, "v").drop("_count", "_rows"), "holiday_events")
    keys = ["family", "dias_relativo_feriado"]
    others = per_event.groupBy(*keys).agg(F.median("v").alias("venta_mediana_por_feriado"), F.count_distinct("fecha_feriado").cast("bigint").alias("cantidad_feriados"))
    return totals(per_event, keys, "v", "ventas_totales").join(others, keys).select(
        *keys, "ventas_totales", _mean().alias("venta_promedio_por_feriado"), "venta_mediana_por_feriado", "cantidad_feriados")


def holiday_sensitivity(df: DataFrame) -> DataFrame:
    """Per family: mean daily sales on holidays vs normal days, % change and |change|.

    Families without both sides, a zero base or a non-finite change are left out.
    """
    daily = totals(_flagged(df), ["date", "family", FLAG], SALES, "v").select("date", "family", FLAG, "v")
    sides = totals(daily, ["family", FLAG], "v", "ventas_totales").withColumn("m", _mean())
    h, n = F.col(FLAG), ~F.col(FLAG)
    per_family = sides.groupBy("family").agg(
        F.max(F.when(h, F.col("m"))).alias("venta_promedio_diaria_feriado"),
        F.max(F.when(n, F.col("m"))).alias("venta_promedio_diaria_normal"),
        F.max(F.when(h, F.col("_rows"))).alias("dias_feriado"),
        F.max(F.when(n, F.col("_rows"))).alias("dias_normales"),
    )
    change = pct_change_expr("venta_promedio_diaria_feriado", "venta_promedio_diaria_normal")
    return (
        per_family.withColumn("cambio_porcentual", change)
        .where(is_finite("cambio_porcentual"))
        .withColumn("sensibilidad_absoluta", F.abs("cambio_porcentual"))
    )


def positive_families(sens: DataFrame) -> DataFrame:
    """Families that sell more on holidays, the largest change first."""
    return listed(sens.where(F.col("cambio_porcentual") > 0), [F.desc("cambio_porcentual"), F.asc("family")])


def negative_families(sens: DataFrame) -> DataFrame:
    """Families that sell less on holidays, the largest loss first."""
    return listed(sens.where(F.col("cambio_porcentual") < 0), [F.asc("cambio_porcentual"), F.asc("family")])


def top_sensitive_families(sens: DataFrame, n: int = 10) -> DataFrame:
    """The families whose sales change most on holidays, in either direction."""
    return top(sens, [F.desc("sensibilidad_absoluta"), F.asc("family")], n)


def first_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of the event windows by family and day."""
    return top(windows, [F.asc("family"), F.asc("dias_relativo_feriado")], n)
