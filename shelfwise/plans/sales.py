"""Sales by family, store, city, state, year and month, with shares and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import month_start
from shelfwise.functions.exact import totals
from shelfwise.operators.expect import require_columns
from shelfwise.operators.ranking import ordinal_rank, reverse_rank, share_of_total, top
from shelfwise.plans.cells import SALES, dimensions

def total_by(df: DataFrame, keys: list, with_mean: bool = True, with_count: bool = False) -> DataFrame:
    """Exact total (and mean, row count) of the sales per key, from the fact or from cells."""
    t = totals(df, keys, SALES, "ventas_totales")
    names = t.columns[: len(keys)]
    mean = [F.try_divide("ventas_totales", F.col("_count").cast("double")).alias("venta_promedio")] if with_mean else []
    count = [F.col("_rows").alias("numero_registros")] if with_count else []
    return t.select(*names, "ventas_totales", *mean, *count)


def by_family(df: DataFrame) -> DataFrame:
    require_columns(df, dimensions(df, "family"), "fact")
    return share_of_total(total_by(df, ["family"], with_count=True), "ventas_totales", "participacion_porcentual")


def by_store(df: DataFrame) -> DataFrame:
    """Totals per store with ordinal ranks 1..n, largest and smallest first.

    Ties on the total go to the smaller store number in the descending rank; the
    ascending rank is ``n + 1 -`` it.
    """
    require_columns(df, dimensions(df, "store_nbr"), "fact")
    t = total_by(df, ["store_nbr"])
    ranked = ordinal_rank(t, [F.col("ventas_totales").desc(), F.col("store_nbr").asc()],
                          "ranking_mayor_venta")
    return reverse_rank(ranked, "ranking_mayor_venta", "ranking_menor_venta")


def by_city(df: DataFrame) -> DataFrame:
    return total_by(df, ["city"])


def by_state(df: DataFrame) -> DataFrame:
    return total_by(df, ["state"])


def by_year(df: DataFrame) -> DataFrame:
    return total_by(df, [F.year("date").alias("anio")])


def by_month(df: DataFrame) -> DataFrame:
    t = total_by(df, [month_start("date").alias("fecha_mes")], with_mean=False)
    return t.select("fecha_mes", "ventas_totales",
                    F.year("fecha_mes").alias("anio"), F.month("fecha_mes").alias("mes"))


def top_stores(stores: DataFrame, n: int = 10) -> DataFrame:
    return top(stores, [F.col("ventas_totales").desc(), F.col("store_nbr").asc()], n)


def bottom_stores(stores: DataFrame, n: int = 10) -> DataFrame:
    return top(stores, [F.col("ventas_totales").asc(), F.col("store_nbr").asc()], n)


def top_cities_by_mean(cities: DataFrame, n: int = 5) -> DataFrame:
    return top(cities, [F.col("venta_promedio").desc(), F.col("city").asc()], n)


def top_families(families: DataFrame, n: int = 10) -> DataFrame:
    return top(families, [F.col("ventas_totales").desc(), F.col("family").asc()], n)
