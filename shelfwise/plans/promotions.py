"""Promotion effect: overall and per family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import is_finite, pct_change_expr
from shelfwise.functions.exact import totals
from shelfwise.operators.expect import require_columns
from shelfwise.operators.median import exact_median
from shelfwise.operators.ranking import listed, top
from shelfwise.plans.cells import SALES, dimensions

FLAG = "en_promocion"


def _flagged(df: DataFrame) -> DataFrame:
    require_columns(df, dimensions(df, "family", "onpromotion"), "fact")
    return df.withColumn(FLAG, F.coalesce(F.col("onpromotion"), F.lit(0)) > 0)


def promo_general(df: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Per promotion flag: total, mean, record-level median and row count.

    Two groups split the whole fact, so the median is the distributed exact one
    (``exact_median``), not Spark's single-task ``median``. The sums come from ``cells`` where given.
    """
    sums = totals(_flagged(df if cells is None else cells), [FLAG], SALES, "ventas_totales")
    med = exact_median(_flagged(df).select(FLAG, SALES), [FLAG], SALES, "venta_mediana")
    return sums.join(med, on=FLAG, how="left").select(
        FLAG, "ventas_totales", F.try_divide("ventas_totales", F.col("_count").cast("double")).alias("venta_promedio"), "venta_mediana",
        F.col("_rows").alias("cantidad_registros"),
    )


def promo_by_family(df: DataFrame) -> DataFrame:
    """Per family: mean sales with and without promotion, counts, difference, % change.

    Families lacking either side, with a zero base or a non-finite change are left out.
    """
    sides = totals(_flagged(df), ["family", FLAG], SALES).withColumn("m", F.try_divide("total", F.col("_count").cast("double")))
    on, off = F.col(FLAG), ~F.col(FLAG)
    per = sides.groupBy("family").agg(
        F.max(F.when(on, F.col("m"))).alias("con"),
        F.max(F.when(off, F.col("m"))).alias("sin"),
        F.coalesce(F.max(F.when(on, F.col("_count"))), F.lit(0)).alias("registros_con_promocion"),
        F.coalesce(F.max(F.when(off, F.col("_count"))), F.lit(0)).alias("registros_sin_promocion"),
    )
    return (
        per.withColumn("incremento_porcentual", pct_change_expr("con", "sin"))
        .where(is_finite("incremento_porcentual"))
        .select(
            "family",
            F.col("con").alias("venta_promedio_con_promocion"),
            F.col("sin").alias("venta_promedio_sin_promocion"),
            "registros_con_promocion",
            "registros_sin_promocion",
            (F.col("con") - F.col("sin")).alias("diferencia_promedio"),
            "incremento_porcentual",
            F.abs("incremento_porcentual").alias("efecto_absoluto"),
        )
    )


def promo_top(effect: DataFrame, n: int = 10) -> DataFrame:
    return top(effect, [F.col("incremento_porcentual").desc(), F.col("family").asc()], n)


def promo_negative(effect: DataFrame) -> DataFrame:
    """Families that sell less under promotion, the largest loss first."""
    return listed(effect.where(F.col("incremento_porcentual") < 0), [F.asc("incremento_porcentual"), F.asc("family")])


def promo_smallest(effect: DataFrame, n: int = 10) -> DataFrame:
    return top(effect.where(F.col("incremento_porcentual") >= 0),
               [F.col("incremento_porcentual").asc(), F.col("family").asc()], n)
