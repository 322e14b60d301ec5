"""Oil price vs sales: monthly correlation, percent changes, lag scan, city sensitivity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import col, is_finite, month_start, safe_corr
from shelfwise.functions.exact import totals
from shelfwise.operators.expect import require_columns, require_rows
from shelfwise.operators.ranking import top
from shelfwise.operators.series import best_lag, lag_scan, pct_change, shift_within
from shelfwise.plans.cells import SALES, dimensions
from shelfwise.sources.sinks import materialize_small

# The reference's period (2015-01 .. 2016-12) mapped onto the fixture calendar.
PERIOD = (dt.date(1997, 1, 1), dt.date(1998, 12, 1))
LAGS = list(range(0, 7))


def _check(df: DataFrame, *columns: str) -> None:
    require_columns(df, dimensions(df, "date", *columns), "fact")


def oil_monthly(df: DataFrame) -> DataFrame:
    """Monthly sales joined to the monthly mean price over distinct dates.

    The price depends on the date only, so one value per date is taken with ``max``
    (deterministic, where keeping an arbitrary duplicate is not) before averaging.
    """
    _check(df, "dcoilwtico")
    sales = totals(df, [month_start("date").alias("fecha_mes")], SALES, "ventas_totales")
    days = df.groupBy("date").agg(F.max("dcoilwtico").alias("p")).where(F.col("p").isNotNull())
    price = totals(days, [month_start("date").alias("fecha_mes")], "p").select(
        "fecha_mes", F.try_divide("total", F.col("_count").cast("double")).alias("precio_petroleo_promedio"))
    return sales.join(price, on="fecha_mes").select(
        "fecha_mes", "ventas_totales", "precio_petroleo_promedio",
        F.year("fecha_mes").alias("anio"), F.month("fecha_mes").alias("mes"),
    )


def require_months(monthly: DataFrame, period=PERIOD) -> DataFrame:
    """The monthly series, or an error when it is too short: 3 months in all, 4 in the period."""
    require_rows(monthly, 3, "fewer than 3 months with sales and price")
    require_rows(in_period(monthly, period), 4, f"fewer than 4 months between {period[0]} and {period[1]}")
    return monthly


def oil_correlation(monthly: DataFrame) -> DataFrame:
    """One row: correlation of the monthly mean price with monthly sales, and months."""
    return monthly.agg(
        safe_corr("precio_petroleo_promedio", "ventas_totales").alias("c"),
        F.count(F.lit(1)).cast("bigint").alias("meses"),
    ).select(F.when(is_finite("c"), col("c")).alias("correlacion"), "meses")


def oil_variations(monthly: DataFrame) -> DataFrame:
    """Month-over-month % change of price and sales over the whole monthly series.

    Month-grain: the unpartitioned window holds one row per month, a bounded count.
    """
    return pct_change(monthly, "fecha_mes", {
        "precio_petroleo_promedio": "variacion_petroleo_pct",
        "ventas_totales": "variacion_ventas_pct",
    })


def in_period(df: DataFrame, period=PERIOD) -> DataFrame:
    return df.where(F.col("fecha_mes").between(F.lit(period[0]), F.lit(period[1])))


def oil_variation_period(monthly: DataFrame, period=PERIOD) -> DataFrame:
    """Changes computed on the full series, then kept for the period only."""
    return in_period(oil_variations(monthly), period)


def oil_lag_scan(monthly: DataFrame, period=PERIOD, lags=LAGS) -> DataFrame:
    """Correlation of the price change with the sales change k months later, k = 0..6.

    The shift runs after the period filter, so the last k months have no partner.
    """
    per = oil_variation_period(monthly, period)
    scan = lag_scan(per, "fecha_mes", "variacion_petroleo_pct", "variacion_ventas_pct", lags)
    return scan.withColumn("correlacion", col("correlacion"))


def oil_best_lag(scan: DataFrame) -> DataFrame:
    return best_lag(scan)


def city_months(df: DataFrame, period=PERIOD) -> DataFrame:
    """Sales per city and month up to the period's end.

    Later months have no part in the period and are not read where the table is laid out by month
    (``fecha_mes``); an earlier one may be the month that the period's first one is compared with.
    """
    month = F.col("fecha_mes") if "fecha_mes" in df.columns else month_start("date")
    return totals(df.where(month <= F.lit(period[1])), ["city", month.alias("fecha_mes")], SALES, "ventas_ciudad").drop("_count", "_rows")


def oil_city_sensitivity(df: DataFrame, monthly: DataFrame, period=PERIOD, lags=LAGS) -> DataFrame:
    """Per city: correlation of the national price change with the city's sales change,
    shifted by the best lag of the national scan (0 when none is positive).

    The lag stays a scalar subquery: it parametrises the positional self join per city
    without a collect.
    """
    _check(df, "city")
    scan = lag_scan(oil_variation_period(monthly, period), "fecha_mes",
                    "variacion_petroleo_pct", "variacion_ventas_pct", lags)
    best = materialize_small(best_lag(scan).select("lag_meses"), "best_lag")
    lag = F.coalesce(best.scalar(), F.lit(0))
    city_var = pct_change(city_months(df, period), "fecha_mes", {"ventas_ciudad": "variacion_ventas_ciudad_pct"},
                          by=("city",))
    oil_var = oil_variations(monthly).select("fecha_mes", "variacion_petroleo_pct")
    # One row per city and month, read twice below.
    joined = materialize_small(in_period(city_var.join(oil_var, on="fecha_mes"), period), "city_months")
    shifted = shift_within(joined, ["city"], "fecha_mes", "variacion_ventas_ciudad_pct", lag,
                           "variacion_ventas_desfasada_pct")
    pairs = shifted.where(is_finite("variacion_petroleo_pct") & is_finite("variacion_ventas_desfasada_pct"))
    per_city = pairs.groupBy("city").agg(
        safe_corr("variacion_petroleo_pct", "variacion_ventas_desfasada_pct").alias("c"),
        F.count(F.lit(1)).cast("bigint").alias("meses_comparados"),
    )
    return per_city.where(is_finite("c")).select(
        "city",
        col("c").alias("correlacion_petroleo_ventas"),
        "meses_comparados",
        col(F.abs("c")).alias("sensibilidad_absoluta"),
        lag.cast("int").alias("lag_meses_utilizado"),
    )


def top_sensitive_cities(cities: DataFrame, n: int = 10) -> DataFrame:
    """The cities whose sales follow the price most, in either direction."""
    return top(cities, [F.desc("sensibilidad_absoluta"), F.asc("city")], n)
