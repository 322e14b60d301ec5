"""The whole batch: inputs -> consolidated fact -> 18 result tables -> Parquet + manifest.

Result tables keep the reference's names. Each is a lazy DataFrame over the staged
fact; ``run`` writes them under one root and returns the manifest (rows counted
during each write, no second scan).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.plans import catalog as Q
from shelfwise.sources.contract import load_sources
from shelfwise.sources.sinks import estimated_rows, materialize_small, register_and_analyze, require_complete, write_jdbc, write_with_manifest

# Fixed values of the reference: the exported table names, in export order.
RESULT_TABLES: dict[str, Callable[[Q.Context], DataFrame]] = {
    "consolidado": Q.consolidate_q,
    "ventas_por_familia": Q.sales_by_family,
    "ventas_por_tienda": Q.sales_by_store,
    "ventas_por_ciudad": Q.sales_by_city,
    "ventas_por_provincia": Q.sales_by_state,
    "ventas_por_anio": Q.sales_by_year,
    "ventas_por_mes": Q.sales_by_month,
    "feriados_vs_dias_normales": Q.holiday_vs_normal,
    "feriados_ventana_tres_dias": Q.holiday_window,
    "feriados_sensibilidad_familias": Q.holiday_sensitivity,
    "promociones_general": Q.promo_general,
    "promociones_por_familia": Q.promo_by_family,
    "petroleo_ventas_mensuales": Q.oil_monthly,
    "petroleo_variaciones_2015_2016": Q.oil_variation_period,
    "petroleo_lags": Q.oil_lag_scan,
    "petroleo_sensibilidad_ciudades": Q.oil_city_sensitivity,
    "transacciones_ventas_diarias": Q.traffic_daily,
    "transacciones_por_tienda": Q.ticket_by_store,
    "transacciones_clasificacion_ticket": Q.ticket_class,
}


# Fixed values of the reference: the row order of each written table ("-" = descending).
SORT_ORDER = {
    "ventas_por_familia": ["-ventas_totales"],
    "ventas_por_tienda": ["-ventas_totales"],
    "ventas_por_ciudad": ["-ventas_totales"],
    "ventas_por_provincia": ["-ventas_totales"],
    "ventas_por_anio": ["anio"],
    "ventas_por_mes": ["fecha_mes"],
    "feriados_vs_dias_normales": ["-es_feriado_nacional"],
    "feriados_ventana_tres_dias": ["family", "dias_relativo_feriado"],
    "feriados_sensibilidad_familias": ["-sensibilidad_absoluta"],
    "promociones_general": ["-en_promocion"],
    "promociones_por_familia": ["-incremento_porcentual"],
    "petroleo_ventas_mensuales": ["fecha_mes"],
    "petroleo_variaciones_2015_2016": ["fecha_mes"],
    "petroleo_lags": ["lag_meses"],
    "petroleo_sensibilidad_ciudades": ["-sensibilidad_absoluta"],
    "transacciones_ventas_diarias": ["store_nbr", "date"],
}


def _order(key: str) -> F.Column:
    return F.desc(key[1:]) if key.startswith("-") else F.asc(key)


def result_tables(spark: SparkSession, sf_dir: str, sorted_rows: bool = False,
                  sources: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The 19 tables; ``sorted_rows`` applies the reference's row order (a range-
    partitioned global sort, distributed) for tables that are written."""
    c = Q.Context(spark, sf_dir, sources)
    _ = c.fact
    with ThreadPoolExecutor(max_workers=2) as pool:  # stage the shared tables once, up front
        list(pool.map(lambda name: getattr(c, name), ["family_cells", "store_cells"]))
    _ = (c.monthly, c.store_traffic)
    # Some frames run a small job while being built (a median's size check, a rank's
    # checkpoint, the event-window table); building them side by side overlaps those.
    with ThreadPoolExecutor(max_workers=4) as pool:
        out = dict(pool.map(lambda item: (item[0], item[1](c)), RESULT_TABLES.items()))
    if sorted_rows:
        out = {name: df.orderBy(*[_order(k) for k in SORT_ORDER[name]]) if name in SORT_ORDER else df
               for name, df in out.items()}
    return out


def run(spark: SparkSession, sf_dir: str, out_root: str, csv: bool = False) -> list[dict]:
    """Write all 19 tables as Parquet under ``out_root``; return the manifest rows.

    ``sf_dir`` holds the star schema, or with ``csv`` the five input files of the CSV contract.
    """
    tables = result_tables(spark, sf_dir, sorted_rows=True, sources=load_sources(spark, sf_dir) if csv else None)
    require_complete(tables, list(RESULT_TABLES))
    rows = write_with_manifest(tables, out_root.rstrip("/"))
    total = {"tabla": "TOTAL", "filas": sum(r["filas"] for r in rows),
             "columnas": None, "segundos": round(sum(r["segundos"] for r in rows), 3)}
    return rows + [total]


def register(spark: SparkSession, out_root: str, rows: list[dict]) -> dict[str, DataFrame]:
    """The tables that ``run`` wrote as catalog tables of the current database, with statistics that the planner uses.

    ``rows`` is the manifest. A table whose analyzed row count differs from what was written raises an error.
    """
    spark.conf.set("spark.sql.cbo.enabled", "true")  # row counts and column statistics, not file sizes alone
    out = {}
    for row in rows:
        name = row["tabla"]
        if name not in RESULT_TABLES:
            continue
        out[name] = register_and_analyze(spark, name, f"{out_root.rstrip('/')}/{name}")
        counted = estimated_rows(out[name])
        if counted != row["filas"]:
            raise RuntimeError(f"{name}: {row['filas']} rows written, {counted} analyzed")
    return out


def export(spark: SparkSession, sf_dir: str, url: str, schema_name: str = "public", properties: dict | None = None, csv: bool = False,
           write: Callable[..., int] = write_jdbc) -> list[dict]:
    """Export all 19 tables to a relational target, one after the other (each is parallel in itself); the manifest rows.

    Nothing is exported before every table exists; each is counted, swapped in with its indexes and analyzed on its own.
    """
    tables = result_tables(spark, sf_dir, sources=load_sources(spark, sf_dir) if csv else None)
    require_complete(tables, list(RESULT_TABLES))
    return [{"tabla": name, "filas": write(df, url, schema_name, name, properties), "columnas": len(df.columns)} for name, df in tables.items()]


def headline(c: Q.Context) -> DataFrame:
    """The scalars each analysis reports, in one row (ties broken by key)."""
    from shelfwise.plans import holidays as H
    from shelfwise.plans import oil as O
    from shelfwise.plans import promotions as PR
    from shelfwise.plans import sales as S
    from shelfwise.plans import traffic as TR

    # Everything comes from cells; what is asked more than once is written once (a few rows per table).
    small = lambda df, name: materialize_small(df, f"headline_{name}")
    fam = small(S.total_by(c.family_cells, ["family"], with_mean=False), "families")
    store = small(S.total_by(c.store_cells, ["store_nbr"], with_mean=False), "stores")
    sens = small(H.holiday_sensitivity(c.family_cells), "holidays")
    promo = small(PR.promo_by_family(c.family_cells), "promotions")
    city = small(O.oil_city_sensitivity(c.store_cells, c.monthly), "cities")
    classes = small(TR.ticket_class(c.store_traffic), "classes")
    best = small(O.oil_best_lag(O.oil_lag_scan(c.monthly)), "lag")
    corr = TR.correlated_stores(c.store_traffic)

    def first(df: DataFrame, col: str, order: list[str]) -> F.Column:
        return df.orderBy(*[_order(k) for k in order]).limit(1).select(col).scalar()

    return c.spark.range(1).select(
        first(fam, "family", ["-ventas_totales", "family"]).alias("familia_mayor_venta"),
        first(store, "store_nbr", ["-ventas_totales", "store_nbr"]).alias("tienda_mayor_venta"),
        first(store, "store_nbr", ["ventas_totales", "store_nbr"]).alias("tienda_menor_venta"),
        H.holiday_dates(c.family_cells).agg(F.count(F.lit(1))).scalar().cast("bigint").alias("cantidad_feriados_nacionales"),
        first(sens, "family", ["-sensibilidad_absoluta", "family"]).alias("familia_mayor_sensibilidad"),
        sens.where("cambio_porcentual > 0").agg(F.count(F.lit(1))).scalar().cast("bigint")
        .alias("familias_impacto_positivo"),
        sens.where("cambio_porcentual < 0").agg(F.count(F.lit(1))).scalar().cast("bigint")
        .alias("familias_impacto_negativo"),
        first(promo, "family", ["-incremento_porcentual", "family"]).alias("familia_mayor_incremento"),
        best.select("lag_meses").scalar().alias("mejor_lag_meses"),
        first(city, "city", ["-sensibilidad_absoluta", "city"]).alias("ciudad_mayor_sensibilidad"),
        first(corr, "store_nbr", ["-correlacion_transacciones_ventas", "store_nbr"])
        .alias("tienda_mayor_correlacion"),
        classes.where(F.col("clasificacion_ticket") == TR.HIGH).agg(F.count(F.lit(1))).scalar()
        .cast("bigint").alias("cantidad_tiendas_ticket_alto"),
        classes.where(F.col("clasificacion_ticket") == TR.LOW).agg(F.count(F.lit(1))).scalar()
        .cast("bigint").alias("cantidad_tiendas_ticket_bajo"),
    )
