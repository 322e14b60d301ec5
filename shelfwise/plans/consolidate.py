"""Holiday rollup and the consolidated fact: one row per sales row, 18 columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import any_true, sorted_distinct_join
from shelfwise.operators.expect import key_violations, require_columns
from shelfwise.operators.gapfill import assert_filled, calendar, fill_calendar
from shelfwise.operators.joins import join_validated, one_per_key
from shelfwise.sources.sinks import materialize_small, written_bytes

# Fixed values of the reference: the holiday types that make a national holiday.
NATIONAL_TYPES = ["Holiday", "Additional", "Bridge", "Transfer"]


def event_rollup(
    events: DataFrame,
    date: str = "date",
    national_types: list[str] = NATIONAL_TYPES,
) -> DataFrame:
    """One row per date: event count, sorted distinct types / locales / descriptions,
    any transferred, any national holiday (National, a holiday type, not transferred).

    Output columns keep the reference's names.
    """
    require_columns(events, [date, "type", "locale", "description", "transferred"], "holidays_events")
    national = (
        (F.col("locale") == "National")
        & F.col("type").isin(*national_types)
        & ~F.col("transferred")
    )
    return events.groupBy(date).agg(
        F.count(F.lit(1)).cast("bigint").alias("cantidad_eventos"),
        sorted_distinct_join("type").alias("tipos_evento"),
        sorted_distinct_join("locale").alias("locales_evento"),
        sorted_distinct_join("description").alias("descripciones_evento"),
        any_true("transferred").alias("evento_transferido"),
        any_true(national).alias("es_feriado_nacional"),
        F.lit(True).alias("es_feriado_evento"),
    )


def sales_calendar(train: DataFrame, date: str = "date") -> DataFrame:
    """Every day from the first to the last sales date."""
    bounds = train.agg(F.min(date).alias("start"), F.max(date).alias("end"))
    return calendar(bounds, out=date)


def daily_price(train: DataFrame, oil: DataFrame, bucket: str | None = "month",
                check_filled: bool = True) -> DataFrame:
    """The oil series deduplicated and gap-filled on the sales calendar.

    Unique per date by construction (a calendar left-joined to a series asserted
    unique). ``check_filled`` fails the job if a value is still null.
    """
    series = oil.select("date", "dcoilwtico").dropDuplicates()
    filled = fill_calendar(series, sales_calendar(train), "date", "dcoilwtico", bucket=bucket)
    return assert_filled(filled, "dcoilwtico") if check_filled else filled


# What fills the nulls of unmatched rows.
FACT_FILL = {
    "transactions": 0,
    "cantidad_eventos": 0,
    "es_feriado_evento": False,
    "es_feriado_nacional": False,
    "evento_transferido": False,
}

# The fact's columns, after the sales row's ``id`` where it has one.
FACT_COLUMNS = [
    "date", "store_nbr", "family", "sales", "onpromotion",
    "city", "state", "type", "cluster",
    "transactions", "dcoilwtico",
    "cantidad_eventos", "tipos_evento", "locales_evento", "descripciones_evento",
    "evento_transferido", "es_feriado_nacional", "es_feriado_evento",
]
# Not in the reference: a day without a traffic row, which the fill makes look like a day without traffic.
MISSING = "transactions_missing"


def unique_stores(stores: DataFrame) -> DataFrame:
    return one_per_key(stores, ["store_nbr"], "join key ['store_nbr'] is not unique on the right side (m:1)")


@dataclass
class Consolidated:
    fact: DataFrame
    holidays: DataFrame  # the rollup, one row per event date
    price: DataFrame  # daily price on the calendar


def consolidate(
    train: DataFrame,
    stores: DataFrame,
    transactions: DataFrame,
    oil: DataFrame,
    holidays_events: DataFrame,
    validate: bool = True,
    guard_quality: bool = True,
    price: DataFrame | None = None,
    rollup: DataFrame | None = None,
    checked_stores: DataFrame | None = None,
) -> Consolidated:
    """Four left joins onto the sales rows, each asserted many-to-one.

    Stores, daily price and the holiday rollup are small dimension tables (store-,
    day- and date-grain); sales-by-day-and-store transactions is as large as the fact
    at scale and joins on two keys. No broadcast is forced: AQE measures each side
    after its stage and broadcasts the ones that are small, and splits skewed keys of
    the two-key join. ``guard_quality`` fails the job if a row lacks store metadata or
    a price (the reference's post-join checks), inside the same job.

    ``price`` and ``rollup`` may be passed in already built (e.g. staged); otherwise
    they are materialized here. Either way the day-grain tables are planned by their
    real file size, so Spark broadcasts them under its threshold instead of shuffling
    the fact by date.

    Keys are checked in the joins' own shuffles. One store may hold much of the sales, and Spark
    splits a hot key only next to a plain table, so the stores (one row per key) are checked and written
    first, or passed in as ``checked_stores``; a (store, day) has one sales row per family at most.
    """
    require_columns(train, ["date", "store_nbr", "family", "sales", "onpromotion"], "train")
    require_columns(stores, ["store_nbr", "city", "state", "type", "cluster"], "stores")
    require_columns(transactions, ["date", "store_nbr", "transactions"], "transactions")
    v = "m:1" if validate else None
    # The rollup (grouped by date) and the price (a calendar) are unique by
    # construction, so only the caller's tables are asserted; a null price left by
    # the fill (all-null series) fails the fact's row guard below.
    if rollup is None:
        rollup = materialize_small(event_rollup(holidays_events), "holiday_rollup")
    if price is None:
        price = materialize_small(daily_price(train, oil, check_filled=not guard_quality), "daily_price")
    if validate and checked_stores is None:
        checked_stores = materialize_small(unique_stores(stores), "stores")
    fact = (
        # First the join that shuffles the sales rows, while they are narrow.
        join_validated(train, transactions, ["store_nbr", "date"], validate=v)
        .transform(lambda d: join_validated(d, checked_stores if validate else stores, ["store_nbr"], validate=None))
        .join(price, on="date", how="left")
        .join(rollup, on="date", how="left")
        .withColumn(MISSING, F.col("transactions").isNull())
        .fillna(FACT_FILL)
        .select(*[c for c in ("id",) if c in train.columns], *FACT_COLUMNS, MISSING)
    )
    if guard_quality:
        ok = (
            F.when(F.col("city").isNull(), F.raise_error(F.lit("fact row without store metadata")))
            .when(F.col("dcoilwtico").isNull(), F.raise_error(F.lit("fact row without oil price")))
            .otherwise(F.lit(True))
        )
        fact = fact.where(ok)
    return Consolidated(fact=fact, holidays=rollup, price=price)


def consolidation_metrics(train: DataFrame, c: Consolidated, path: str | None = None) -> DataFrame:
    """Rows in and out, columns, event dates, rows without transactions / price; with ``path``, the
    bytes of the written fact too (``bytes_consolidado``), from its file system."""
    f = c.fact
    size = [F.lit(written_bytes(f.sparkSession, path)).cast("bigint").alias("bytes_consolidado")] if path else []
    return f.agg(
        F.count(F.lit(1)).cast("bigint").alias("filas_consolidado"),
        F.count_if(F.col("transactions") == 0).cast("bigint").alias("filas_sin_transacciones"),
        F.count_if(F.col(MISSING)).cast("bigint").alias("filas_transacciones_ausentes"),
        F.count_if(F.col("dcoilwtico").isNull()).cast("bigint").alias("filas_sin_precio_petroleo"),
        F.count_if(F.col("city").isNull()).cast("bigint").alias("filas_sin_ciudad"),
    ).select(
        train.agg(F.count(F.lit(1))).scalar().cast("bigint").alias("filas_train"),
        "filas_consolidado",
        F.lit(len(f.columns)).alias("columnas_consolidado"),
        c.holidays.agg(F.count(F.lit(1))).scalar().cast("bigint").alias("fechas_eventos_unicas"),
        "filas_sin_transacciones",
        "filas_transacciones_ausentes",
        "filas_sin_precio_petroleo",
        "filas_sin_ciudad",
        *size,
    )


def join_key_report(
    stores: DataFrame, transactions: DataFrame, price: DataFrame, rollup: DataFrame
) -> DataFrame:
    """Duplicated right-side keys of each consolidation join (all should be 0)."""
    sides = [
        ("stores", "store_nbr", stores, ["store_nbr"]),
        ("transactions", "store_nbr, date", transactions, ["store_nbr", "date"]),
        ("oil", "date", price, ["date"]),
        ("holidays", "date", rollup, ["date"]),
    ]
    parts = [
        key_violations(df, keys).agg(F.count(F.lit(1)).cast("bigint").alias("claves_duplicadas"))
        .select(F.lit(name).alias("tabla"), F.lit(k).alias("clave"), "claves_duplicadas")
        for name, k, df, keys in sides
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
