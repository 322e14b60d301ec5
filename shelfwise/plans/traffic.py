"""Store traffic vs sales: daily reduce, per-store summary, average-ticket classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import col, is_finite, safe_corr
from shelfwise.functions.exact import has_state, totals
from shelfwise.operators.clean import column_medians
from shelfwise.operators.expect import require_columns
from shelfwise.operators.ranking import listed
from shelfwise.plans.cells import SALES, TRAFFIC, dimensions, two_values, with_traffic

# Fixed values of the reference: the ticket class labels.
HIGH, LOW, MIDDLE = "Ticket alto", "Ticket bajo", "Intermedio"


def _check(df: DataFrame) -> None:
    require_columns(df, dimensions(df, "date", "store_nbr", *([] if has_state(df) else ["transactions"])), "fact")


def fd_violations(df: DataFrame) -> DataFrame:
    """(store, date) pairs carrying more than one ``transactions`` value (null counts)."""
    _check(df)
    return (
        df.groupBy("store_nbr", "date")
        .agg((F.count_distinct("transactions")
              + F.max(F.col("transactions").isNull().cast("int"))).alias("valores"))
        .where(F.col("valores") > 1)
        .select("store_nbr", "date", F.col("valores").cast("bigint").alias("valores"))
    )


def traffic_daily(df: DataFrame) -> DataFrame:
    """Per store and day: total sales and the day's transactions, days with traffic only.

    ``max`` reads the one transactions value per (store, date); the same pass fails if a store's day
    carries two of them (null counts as a value).
    """
    _check(df)
    message = "transactions has more than one value for a store and date"
    daily = totals(with_traffic(df), ["store_nbr", "date"], SALES, "ventas_diarias", extra=TRAFFIC, many=True)
    value = F.when(two_values(F.col("_rows")), F.raise_error(F.lit(message)).cast("bigint")).otherwise(F.col("transactions_most"))
    return daily.select("store_nbr", "date", "ventas_diarias", value.alias("transactions")).where(F.col("transactions") > 0)


def traffic_correlation(daily: DataFrame) -> DataFrame:
    return daily.agg(safe_corr("transactions", "ventas_diarias").alias("c")).select(
        F.when(is_finite("c"), col("c")).alias("correlacion")
    )


def ticket_by_store(daily: DataFrame) -> DataFrame:
    """Per store: totals, daily means, traffic/sales correlation, days, average ticket."""
    sums = totals(daily, ["store_nbr"], "ventas_diarias", "ventas_totales")
    others = daily.groupBy("store_nbr").agg(
        F.sum("transactions").cast("bigint").alias("total_transacciones"),
        F.avg("transactions").alias("transacciones_promedio_diarias"),
        safe_corr("transactions", "ventas_diarias").alias("correlacion_transacciones_ventas"),
    )
    per = sums.join(others, "store_nbr").select(
        "store_nbr", "total_transacciones", "ventas_totales", "transacciones_promedio_diarias",
        F.try_divide("ventas_totales", F.col("_count").cast("double")).alias("ventas_promedio_diarias"),
        "correlacion_transacciones_ventas", F.col("_rows").alias("dias_analizados"))
    return per.withColumn(
        "ticket_promedio",
        F.when(F.col("total_transacciones") > 0,
               F.col("ventas_totales") / F.col("total_transacciones")),
    )


def _rounded(stores: DataFrame) -> DataFrame:
    return stores.select(
        "store_nbr", "total_transacciones", "ventas_totales",
        col("transacciones_promedio_diarias").alias("transacciones_promedio_diarias"),
        col("ventas_promedio_diarias").alias("ventas_promedio_diarias"),
        col("correlacion_transacciones_ventas").alias("correlacion_transacciones_ventas"),
        "dias_analizados",
        col("ticket_promedio").alias("ticket_promedio"),
        *[c for c in stores.columns if c == "clasificacion_ticket"],
    )


def ticket_by_store_report(daily: DataFrame) -> DataFrame:
    return _rounded(ticket_by_store(daily))


def ticket_class(stores: DataFrame) -> DataFrame:
    """Quadrant of each store against the medians of daily sales and daily traffic.

    High ticket: sales >= median and traffic <= median; low: sales <= and traffic >=;
    otherwise intermediate. Bounds are inclusive and the high test runs first. The
    medians are exact, distributed, and enter as scalar subqueries.
    """
    both = column_medians(stores, ["ventas_promedio_diarias", "transacciones_promedio_diarias"])
    m_sales = both.where(F.col("column") == "ventas_promedio_diarias").select("median").scalar()
    m_traffic = both.where(F.col("column") == "transacciones_promedio_diarias").select("median").scalar()
    s, t = F.col("ventas_promedio_diarias"), F.col("transacciones_promedio_diarias")
    label = (
        F.when((s >= m_sales) & (t <= m_traffic), F.lit(HIGH))
        .when((s <= m_sales) & (t >= m_traffic), F.lit(LOW))
        .otherwise(F.lit(MIDDLE))
    )
    return _rounded(stores.withColumn("clasificacion_ticket", label))


def ticket_high(classes: DataFrame) -> DataFrame:
    """Stores of the high class, the highest average ticket first."""
    return listed(classes.where(F.col("clasificacion_ticket") == HIGH), [F.desc("ticket_promedio"), F.asc("store_nbr")])


def ticket_low(classes: DataFrame) -> DataFrame:
    """Stores of the low class, the lowest average ticket first."""
    return listed(classes.where(F.col("clasificacion_ticket") == LOW), [F.asc("ticket_promedio"), F.asc("store_nbr")])


def correlated_stores(stores: DataFrame) -> DataFrame:
    """Stores whose traffic and sales have a correlation."""
    return _rounded(stores.where(is_finite("correlacion_transacciones_ventas")))


def top_correlated_stores(stores: DataFrame) -> DataFrame:
    """The same, the strongest correlation first."""
    return listed(correlated_stores(stores), [F.desc("correlacion_transacciones_ventas"), F.asc("store_nbr")])
