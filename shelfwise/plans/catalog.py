"""Named queries over the driver's tables: the registry behind ``__spark_entry__``.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables. Building
one may run jobs: shared tables are staged, gates on small derived tables are checked. ``Context`` builds the shared pieces (inputs, consolidated fact, monthly oil
series) once per call, lazily.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import rounded
from shelfwise.operators import clean as C
from shelfwise.operators import profile as P
from shelfwise.operators.expect import (
    expect,
    expect_in_one_pass,
    key_violations,
    require_rows,
    union_reports,
)
from shelfwise.operators.gapfill import fill_calendar, gap_fill_metrics
from shelfwise.operators.joins import fanout
from shelfwise.plans import holidays as H
from shelfwise.plans import oil as O
from shelfwise.plans import promotions as PR
from shelfwise.plans import sales as S
from shelfwise.plans import traffic as TR
from shelfwise.plans.cells import TRAFFIC, family_cells, store_cells, two_values
from shelfwise.plans.consolidate import (
    Consolidated,
    consolidate,
    daily_price,
    event_rollup,
    consolidation_metrics,
    join_key_report,
    sales_calendar,
    unique_stores,
)
from shelfwise.sources import fixtures as FX
from shelfwise.session import size_shuffles
from shelfwise.sources.sinks import stage_table, staged_counts, written_bytes


def _input_key(spark: SparkSession, root: str) -> str:
    """Folder plus length and modification time of every file in it, through Hadoop's file system,
    so a changed table is staged anew wherever it lives."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [root]
    for entry in fs.listStatus(path):
        for file in fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry]:
            parts.append(f"{file.getPath().getName()}:{file.getLen()}:{file.getModificationTime()}")
    return "|".join(sorted(parts))


# Inputs that the clean stage cleans; the price series is only gap-filled.
CLEANED = ("train", "stores", "transactions", "holidays_events")


class Context:
    """The shared tables over the driver's star schema, or over ``sources`` (five input frames, as
    ``load_sources`` returns them; ``sf_dir`` is then the folder that they come from)."""

    def __init__(self, spark: SparkSession, sf_dir: str, sources: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.t = FX.Tables(spark, sf_dir)
        self.sources = sources

    @cached_property
    def key(self) -> str:
        return _input_key(self.spark, self.t.root) + ("|sources" if self.sources else "")

    def _staged(self, name: str, build: Callable[[], DataFrame], sort_by: list[str] | None = None, **more) -> DataFrame:
        return stage_table(build, name, self.key, sort_by=sort_by, spark=self.spark, **more)

    def counts(self, name: str) -> dict[str, int]:
        """Rows and null cells counted while the stage table ``name`` was written."""
        return staged_counts(self.spark, name, self.key)

    @cached_property
    def raw_inputs(self) -> dict[str, DataFrame]:
        """The five inputs as they come, each staged once per application. Profile and cleaning queries
        read these."""
        _ = self.key
        tables = [self.t.root] if self.sources else [f"{self.t.root.rstrip('/')}/{name}.parquet" for name in FX.SALES_TABLES]
        size_shuffles(self.spark, sum(written_bytes(self.spark, path) for path in tables))

        def stage(name: str) -> tuple[str, DataFrame]:
            build = (lambda: self.sources[name]) if self.sources else (lambda: FX.VIEWS[name](self.t))
            return name, self._staged(f"input_{name}", build, ["date"] if name != "stores" else None)

        # Independent jobs: Spark runs them side by side from one session.
        with ThreadPoolExecutor(max_workers=len(FX.VIEWS)) as pool:
            return dict(pool.map(stage, FX.VIEWS))

    @cached_property
    def inputs(self) -> dict[str, DataFrame]:
        """The inputs after the clean stage (strict dates, exact dedup, imputation), staged: gap fill,
        checks and the consolidation start from these, the calendar from the cleaned ``train``."""
        raw = self.raw_inputs

        def stage(name: str) -> tuple[str, DataFrame]:
            if name not in CLEANED:
                return name, raw[name]
            return name, self._staged(f"clean_{name}", lambda: C.clean_table(raw[name], name)[0], ["date"] if name != "stores" else None)

        with ThreadPoolExecutor(max_workers=len(raw)) as pool:
            return dict(pool.map(stage, raw))

    @cached_property
    def consolidated(self):
        """Consolidation over the staged inputs, with its two day-grain dimension
        tables (daily price, holiday rollup) staged too: their real, small file size is
        then what the planner's broadcast threshold checks, so the fact is never
        shuffled by date."""
        i = self.inputs
        key = self.key
        price = stage_table(lambda: daily_price(i["train"], i["oil"]), "daily_price", key,
                            spark=self.spark)
        rollup = stage_table(lambda: event_rollup(i["holidays_events"]), "holiday_rollup", key,
                             spark=self.spark)
        stores = stage_table(lambda: unique_stores(i["stores"]), "unique_stores", key, spark=self.spark)
        return consolidate(i["train"], i["stores"], i["transactions"], i["oil"], i["holidays_events"],
                           price=price, rollup=rollup, checked_stores=stores)

    @cached_property
    def fact(self) -> DataFrame:
        """The consolidated fact, written once per application as a stage table.

        Every analysis starts from this Parquet scan (pruned to its columns) or from the cells of it, as the
        reference's analyses start from its consolidated file; the joins, guards and
        gap fill run once, not once per analysis and subquery. The write fails if it did not keep the sales rows.
        The wide rows are written where the join leaves them: no query reads the fact by date, and neither a shuffle
        nor a sort of them grows with it.
        """

        def kept(counts: dict[str, int]) -> None:
            before = self.counts("clean_train")["rows"]
            if counts["rows"] != before:
                raise ValueError(f"the consolidation made {counts['rows']} rows of {before} sales rows")

        _ = self.inputs
        return self._staged("fact", lambda: self.consolidated.fact, check=kept)

    @cached_property
    def family_cells(self) -> DataFrame:
        return self._staged("family_cells", lambda: family_cells(self.fact), ["date"])

    @cached_property
    def store_cells(self) -> DataFrame:
        fact = self.fact
        return self._staged("store_cells", lambda: store_cells(fact, self.counts("fact")["rows"]), ["date"], partition_by=["fecha_mes"], dealt=True)

    @cached_property
    def monthly(self) -> DataFrame:
        """Monthly sales and price (one row per month), staged: six oil queries and the
        checks start from it."""
        monthly = stage_table(lambda: O.oil_monthly(self.family_cells), "oil_monthly", self.key,
                              spark=self.spark)
        return O.require_months(monthly)

    @cached_property
    def daily_traffic(self) -> DataFrame:
        """Sales and traffic per store and day (a result table of its own), staged."""
        daily = stage_table(lambda: TR.traffic_daily(self.store_cells), "traffic_daily", self.key,
                            sort_by=["store_nbr", "date"], spark=self.spark)
        return require_rows(daily, 1, "no day with transactions")

    @cached_property
    def store_traffic(self) -> DataFrame:
        return self._staged("store_traffic", lambda: TR.ticket_by_store(self.daily_traffic))


def _q(fn: Callable[[Context], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(Context(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---- sources, profile, cleaning -------------------------------------------------

def load_summary(c: Context) -> DataFrame:
    return P.load_summary(c.raw_inputs)


def profile_nulls(c: Context) -> DataFrame:
    return P.profile_all(c.raw_inputs)


def profile_duplicates(c: Context) -> DataFrame:
    return P.duplicate_count_all(c.raw_inputs)


def profile_range(c: Context) -> DataFrame:
    return P.value_range(c.raw_inputs, "date")


def parse_date(c: Context) -> DataFrame:
    """Transactions as read from text: the date column rendered ISO and parsed strictly."""
    text = c.raw_inputs["transactions"].withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return C.parse_date(text, "date")


def dedup_rows(c: Context) -> DataFrame:
    return C.dedup(c.raw_inputs["transactions"])


def impute_median(c: Context) -> DataFrame:
    """The generic imputation applied to the input with nulls (the price series)."""
    out, _ = C.impute(c.raw_inputs["oil"], "oil")
    return out


def impute_mode(c: Context) -> DataFrame:
    """The value the mode rule would impute for every text/boolean input column."""
    parts = []
    for name, df in c.raw_inputs.items():
        _, other = C._imputable(df)
        if other:
            parts.append(C.column_modes(df, other).select(
                F.lit(name).alias("dataset"), "column", "mode_value",
                F.col("mode_count").cast("bigint").alias("mode_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def impute_log(c: Context) -> DataFrame:
    parts = [C.impute(df, name)[1] for name, df in c.raw_inputs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cleaning_metrics(c: Context) -> DataFrame:
    """Rows and null cells before and after the clean stage, counted while its tables were written."""
    _ = c.inputs
    rows = [(n, c.counts(f"input_{n}"), c.counts(f"clean_{n}")) for n in CLEANED]
    return c.spark.createDataFrame(
        [(n, a["rows"], b["rows"], a["rows"] - b["rows"], a["nulls"], b["nulls"]) for n, a, b in rows],
        "dataset string, filas_originales bigint, filas_finales bigint, duplicados_eliminados bigint, nulos_antes bigint, nulos_despues bigint")


def _gap_fill(c: Context, bucket):
    i = c.inputs
    series = i["oil"].select("date", "dcoilwtico").dropDuplicates()
    filled = fill_calendar(series, sales_calendar(i["train"]), bucket=bucket)
    return filled


def gap_fill(c: Context) -> DataFrame:
    """The daily price; the plain form, one ordered window over all days, is left to the tests."""
    return _gap_fill(c, "month")


def gap_fill_bucketed(c: Context) -> DataFrame:
    return _gap_fill(c, "month")


def gap_fill_metrics_q(c: Context) -> DataFrame:
    return gap_fill_metrics(c.inputs["oil"], c.consolidated.price)


# ---- consolidation ---------------------------------------------------------------

def holiday_rollup(c: Context) -> DataFrame:
    return c.consolidated.holidays


def consolidate_q(c: Context) -> DataFrame:
    return c.fact


def consolidation_metrics_q(c: Context) -> DataFrame:
    staged = Consolidated(fact=c.fact, holidays=c.consolidated.holidays, price=c.consolidated.price)
    return consolidation_metrics(c.inputs["train"], staged)


def join_key_violations(c: Context) -> DataFrame:
    i = c.inputs
    return join_key_report(i["stores"], i["transactions"], c.consolidated.price, c.consolidated.holidays)


def join_fanout(c: Context) -> DataFrame:
    return fanout(c.inputs["train"], c.inputs["holidays_events"], ["date"]).select(
        "date", F.col("len").cast("bigint").alias("len"),
        F.col("filas_train").cast("bigint").alias("filas_train"),
        F.col("filas_adicionales").cast("bigint").alias("filas_adicionales"))


def duplicate_keys(c: Context) -> DataFrame:
    return key_violations(c.inputs["holidays_events"], ["date"]).select(
        "date", F.col("filas").cast("bigint").alias("len"))


def dq_checks(c: Context) -> DataFrame:
    """The reference's runtime gates as one report: ``(check, violations)``.

    Row-level checks on the fact share one aggregation pass, as do the month counts;
    key checks group each right-hand table once.
    """
    i, f = c.inputs, c.fact
    per_day = c.store_cells.groupBy("store_nbr", "date").agg(
        *[{"min": F.min, "max": F.max, "sum": F.sum}[how](column).alias(name) for name, (how, column) in TRAFFIC.items()], F.sum("_rows").alias("rows"))
    lost = c.counts("fact")["rows"] - c.counts("clean_train")["rows"]
    return union_reports(
        expect({
            "stores_key_unique": key_violations(i["stores"], ["store_nbr"]),
            "transactions_key_unique": key_violations(i["transactions"], ["store_nbr", "date"]),
            "oil_key_unique": key_violations(c.consolidated.price, ["date"]),
            "holidays_key_unique": key_violations(c.consolidated.holidays, ["date"]),
            "oil_series_key_unique": key_violations(i["oil"].dropDuplicates(), ["date"]),
            "gap_fill_nulls": c.consolidated.price.where(F.col("dcoilwtico").isNull()),
        }),
        expect_in_one_pass(f, {
            "fact_rows_without_store": F.count_if(F.col("city").isNull()),
            "fact_rows_without_price": F.count_if(F.col("dcoilwtico").isNull()),
            "no_national_holiday": F.when(F.count_if(F.coalesce(F.col("es_feriado_nacional"), F.lit(False))) == 0,
                                          1).otherwise(0),
        }),
        expect_in_one_pass(c.monthly, {
            "fewer_than_3_months": F.when(F.count(F.lit(1)) < 3, 1).otherwise(0),
            "fewer_than_4_period_months": F.when(
                F.count_if(F.col("fecha_mes").between(F.lit(O.PERIOD[0]), F.lit(O.PERIOD[1]))) < 4, 1
            ).otherwise(0),
        }),
        expect_in_one_pass(per_day, {
            "transactions_not_functional": F.count_if(two_values(F.col("rows"))),
            "no_traffic_days": F.when(F.count_if(F.col("transactions_most") > 0) == 0, 1).otherwise(0),
        }),
        c.spark.createDataFrame([("rows_lost_or_added", abs(lost))], "check string, violations bigint"),
    )


# ---- sales -----------------------------------------------------------------------

def sales_by_family(c: Context) -> DataFrame:
    return S.by_family(c.family_cells)


def sales_by_store(c: Context) -> DataFrame:
    return S.by_store(c.store_cells)


def sales_by_city(c: Context) -> DataFrame:
    return S.by_city(c.store_cells)


def sales_by_state(c: Context) -> DataFrame:
    return S.by_state(c.store_cells)


def sales_by_year(c: Context) -> DataFrame:
    return S.by_year(c.family_cells)


def sales_by_month(c: Context) -> DataFrame:
    return S.by_month(c.family_cells)


def top_stores(c: Context) -> DataFrame:
    return S.top_stores(S.total_by(c.store_cells, ["store_nbr"]))


def bottom_stores(c: Context) -> DataFrame:
    return S.bottom_stores(S.total_by(c.store_cells, ["store_nbr"]))


def top_cities_by_mean(c: Context) -> DataFrame:
    return S.top_cities_by_mean(S.by_city(c.store_cells))


def top_families(c: Context) -> DataFrame:
    return S.top_families(S.by_family(c.family_cells))


# ---- holidays --------------------------------------------------------------------

def holiday_dates(c: Context) -> DataFrame:
    return H.holiday_dates(c.family_cells)


def holiday_vs_normal(c: Context) -> DataFrame:
    return H.holiday_vs_normal(c.family_cells)


def holiday_change(c: Context) -> DataFrame:
    return H.holiday_change(c.family_cells)


def holiday_window(c: Context) -> DataFrame:
    return H.holiday_window(c.family_cells)


def holiday_sensitivity(c: Context) -> DataFrame:
    return H.holiday_sensitivity(c.family_cells)


def holiday_positive(c: Context) -> DataFrame:
    return H.positive_families(H.holiday_sensitivity(c.family_cells))


def holiday_negative(c: Context) -> DataFrame:
    return H.negative_families(H.holiday_sensitivity(c.family_cells))


# ---- promotions ------------------------------------------------------------------

def promo_general(c: Context) -> DataFrame:
    return PR.promo_general(c.fact, c.family_cells)


def promo_by_family(c: Context) -> DataFrame:
    return PR.promo_by_family(c.family_cells)


def promo_top(c: Context) -> DataFrame:
    return PR.promo_top(PR.promo_by_family(c.family_cells))


def promo_negative(c: Context) -> DataFrame:
    return PR.promo_negative(PR.promo_by_family(c.family_cells))


def promo_smallest(c: Context) -> DataFrame:
    return PR.promo_smallest(PR.promo_by_family(c.family_cells))


# ---- oil -------------------------------------------------------------------------

def oil_monthly(c: Context) -> DataFrame:
    return c.monthly


def oil_correlation(c: Context) -> DataFrame:
    return O.oil_correlation(c.monthly)


def oil_variation_period(c: Context) -> DataFrame:
    return O.oil_variation_period(c.monthly).select(
        "fecha_mes", "ventas_totales", "precio_petroleo_promedio",
        "anio", "mes", "variacion_petroleo_pct",
        "variacion_ventas_pct")


def oil_lag_scan(c: Context) -> DataFrame:
    return O.oil_lag_scan(c.monthly)


def oil_best_lag(c: Context) -> DataFrame:
    return O.oil_best_lag(O.oil_lag_scan(c.monthly))


def oil_city_sensitivity(c: Context) -> DataFrame:
    return O.oil_city_sensitivity(c.store_cells, c.monthly)


# ---- traffic ---------------------------------------------------------------------

def fd_violations(c: Context) -> DataFrame:
    return TR.fd_violations(c.fact)


def traffic_daily(c: Context) -> DataFrame:
    return c.daily_traffic


def traffic_correlation(c: Context) -> DataFrame:
    return TR.traffic_correlation(c.daily_traffic)


def ticket_by_store(c: Context) -> DataFrame:
    return TR.ticket_by_store_report(c.daily_traffic)


def ticket_class(c: Context) -> DataFrame:
    return TR.ticket_class(c.store_traffic)


def ticket_high(c: Context) -> DataFrame:
    return TR.ticket_high(TR.ticket_class(c.store_traffic))


def ticket_low(c: Context) -> DataFrame:
    return TR.ticket_low(TR.ticket_class(c.store_traffic))


def traffic_top_stores(c: Context) -> DataFrame:
    return TR.top_correlated_stores(c.store_traffic)


# ---- previews, samples, reports ---------------------------------------------------

def preview(c: Context) -> DataFrame:
    """First and last 10 fact rows in (date, store, family) order, tagged."""
    keys = ["date", "store_nbr", "family"]
    head = c.fact.orderBy(*keys).limit(10).withColumn("posicion", F.lit("head"))
    tail = c.fact.orderBy(*[F.desc(k) for k in keys]).limit(10).withColumn("posicion", F.lit("tail"))
    return head.unionByName(tail)


def distinct_values(c: Context) -> DataFrame:
    """A sample of distinct cities: the first 10 in sort order (a sampling operator)."""
    return c.fact.select("city").dropna().distinct().orderBy("city").limit(10)


def headline_q(c: Context) -> DataFrame:
    from shelfwise.plans.pipeline import headline
    return headline(c)


def oil_top_cities(c: Context) -> DataFrame:
    return O.top_sensitive_cities(O.oil_city_sensitivity(c.store_cells, c.monthly))


def holiday_top_families(c: Context) -> DataFrame:
    return H.top_sensitive_families(H.holiday_sensitivity(c.family_cells))


def holiday_first_windows(c: Context) -> DataFrame:
    return H.first_windows(H.holiday_window(c.family_cells))


def export_manifest(c: Context) -> DataFrame:
    """Rows and columns of the exported tables, each written once and counted while it was written."""
    from shelfwise.plans.pipeline import RESULT_TABLES

    _ = (c.fact, c.family_cells, c.store_cells, c.monthly, c.store_traffic)

    def stage(item) -> tuple[str, int, int]:
        name, fn = item
        table = fn(c) if name == "consolidado" else c._staged(f"result_{name}", lambda: fn(c))
        return name, c.counts("fact" if name == "consolidado" else f"result_{name}")["rows"], len(table.columns)

    with ThreadPoolExecutor(max_workers=4) as pool:
        rows = list(pool.map(stage, RESULT_TABLES.items()))
    return c.spark.createDataFrame(rows, "tabla string, filas bigint, columnas int")


QUERIES: dict[str, Callable[[Context], DataFrame]] = {
    "load_summary": load_summary,
    "profile_nulls": profile_nulls,
    "profile_duplicates": profile_duplicates,
    "profile_range": profile_range,
    "parse_date": parse_date,
    "dedup_rows": dedup_rows,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "impute_log": impute_log,
    "cleaning_metrics": cleaning_metrics,
    "gap_fill": gap_fill,
    "gap_fill_bucketed": gap_fill_bucketed,
    "gap_fill_metrics": gap_fill_metrics_q,
    "holiday_rollup": holiday_rollup,
    "consolidate": consolidate_q,
    "consolidation_metrics": consolidation_metrics_q,
    "join_key_violations": join_key_violations,
    "join_fanout": join_fanout,
    "duplicate_keys": duplicate_keys,
    "dq_checks": dq_checks,
    "sales_by_family": sales_by_family,
    "sales_by_store": sales_by_store,
    "sales_by_city": sales_by_city,
    "sales_by_state": sales_by_state,
    "sales_by_year": sales_by_year,
    "sales_by_month": sales_by_month,
    "top_stores": top_stores,
    "bottom_stores": bottom_stores,
    "top_cities_by_mean": top_cities_by_mean,
    "top_families": top_families,
    "holiday_dates": holiday_dates,
    "holiday_vs_normal": holiday_vs_normal,
    "holiday_change": holiday_change,
    "holiday_window": holiday_window,
    "holiday_sensitivity": holiday_sensitivity,
    "holiday_positive": holiday_positive,
    "holiday_negative": holiday_negative,
    "promo_general": promo_general,
    "promo_by_family": promo_by_family,
    "promo_top": promo_top,
    "promo_negative": promo_negative,
    "promo_smallest": promo_smallest,
    "oil_monthly": oil_monthly,
    "oil_correlation": oil_correlation,
    "oil_variation_period": oil_variation_period,
    "oil_lag_scan": oil_lag_scan,
    "oil_best_lag": oil_best_lag,
    "oil_city_sensitivity": oil_city_sensitivity,
    "oil_top_cities": oil_top_cities,
    "holiday_top_families": holiday_top_families,
    "holiday_first_windows": holiday_first_windows,
    "fd_violations": fd_violations,
    "traffic_daily": traffic_daily,
    "traffic_correlation": traffic_correlation,
    "ticket_by_store": ticket_by_store,
    "ticket_class": ticket_class,
    "ticket_high": ticket_high,
    "ticket_low": ticket_low,
    "traffic_top_stores": traffic_top_stores,
    "preview": preview,
    "distinct_values": distinct_values,
    "headline": headline_q,
    "export_manifest": export_manifest,
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in QUERIES.items()}
