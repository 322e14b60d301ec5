"""The driver's star-schema tables, reshaped into the retailer's five inputs.

``FIXTURES.md`` §3 defines these views; this module is their DataFrame form. Every
view is lazy and reads only the columns it needs, so Catalyst prunes the Parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import apply_required_conf



def money_sum(c: str) -> Column:
    """Sum of a driver amount (whole cents below 10**16), the same in every order. Sums of the
    retailer's own values are exact whatever they are: ``functions.exact``."""
    return F.sum(F.col(c).cast("decimal(28,12)")).cast("double")


SALES_TABLES = ("lineitem", "orders", "part", "supplier")  # what the views read that grows with the sales
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@dataclass
class Tables:
    """Lazy handles on the driver's Parquet tables under one folder."""

    spark: SparkSession
    root: str
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        apply_required_conf(self.spark)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)


def stores(t: Tables) -> DataFrame:
    """One row per supplier, playing a store; nation and region are tiny dimensions."""
    s = t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    bal = F.col("s_acctbal")
    store_type = (
        F.when(bal < 0, "E").when(bal < 2500, "D").when(bal < 5000, "C")
        .when(bal < 7500, "B").otherwise("A")
    )
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("s_suppkey").alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            store_type.alias("type"),
            F.col("s_nationkey").alias("cluster"),
        )
    )


def train(t: Tables) -> DataFrame:
    """Daily sales per store and product family; unique on (date, store_nbr, family)."""
    li = t.lineitem.select("l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice", "l_discount")
    p = t.part.select("p_partkey", "p_type")
    return (
        li.join(p, li.l_partkey == p.p_partkey)
        .groupBy(
            F.to_date("l_shipdate").alias("date"),
            F.col("l_suppkey").alias("store_nbr"),
            F.col("p_type").alias("family"),
        )
        .agg(
            money_sum("l_extendedprice").alias("sales"),
            F.sum(F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)).cast("bigint").alias("onpromotion"),
        )
    )


def transactions(t: Tables) -> DataFrame:
    """Distinct orders per store and day; the 13th of each month is absent."""
    li = t.lineitem.select("l_shipdate", "l_suppkey", "l_orderkey")
    return (
        li.where(F.dayofmonth("l_shipdate") != 13)
        .groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("store_nbr"))
        .agg(F.count_distinct("l_orderkey").cast("bigint").alias("transactions"))
    )


def oil(t: Tables) -> DataFrame:
    """A weekday price series with gaps and nulls (days 2 and 10 of each month)."""
    o = t.orders.select(F.to_date("o_orderdate").alias("date"), "o_totalprice")
    weekday = F.pmod(F.datediff("date", F.lit("1995-01-01").cast("date")), F.lit(7))
    price = (
        o.where(~weekday.isin(0, 6))
        .groupBy("date")
        .agg((money_sum("o_totalprice") / F.count(F.lit(1))).alias("price"))
    )
    return price.select(
        "date",
        F.when(F.dayofmonth("date").isin(2, 10), F.lit(None).cast("double"))
        .otherwise(F.col("price"))
        .alias("dcoilwtico"),
    )


def holidays(t: Tables) -> DataFrame:
    """Holiday and event calendar; several rows can share a date.

    Every block filters the distinct order dates; Catalyst pushes each filter below the
    distinct, so each block aggregates only its own few dates from a one-column scan.
    """
    days = t.orders.select(F.to_date("o_orderdate").alias("date")).distinct()
    day, month = F.dayofmonth("date"), F.month("date")

    def block(cond, type_, locale, locale_name, description, transferred):
        return days.where(cond).select(
            "date",
            F.lit(type_).alias("type"),
            F.lit(locale).alias("locale"),
            F.lit(locale_name).alias("locale_name"),
            F.lit(description).alias("description"),
            transferred.alias("transferred"),
        )

    openers = block((day == 1) & month.isin(1, 5, 8, 11), "Holiday", "National", "ALL",
                    "Month opener", month == 5)
    moved = block((day == 4) & (month == 5), "Transfer", "National", "ALL", "Moved opener",
                  F.lit(False))
    year_end = block(day.isin(24, 25) & (month == 12), "Additional", "National", "ALL", "Year end",
                     F.lit(False))
    r = t.region.select("r_regionkey", "r_name")
    fairs = days.where(day == 1).join(r, F.month("date") == F.col("r_regionkey") + 1).select(
        "date",
        F.lit("Event").alias("type"),
        F.lit("Regional").alias("locale"),
        F.col("r_name").alias("locale_name"),
        F.concat(F.lit("Fair "), F.col("r_name")).alias("description"),
        F.lit(False).alias("transferred"),
    )
    return openers.unionByName(moved).unionByName(year_end).unionByName(fairs)


VIEWS = {
    "train": train,
    "stores": stores,
    "transactions": transactions,
    "holidays_events": holidays,
    "oil": oil,
}


def retail_inputs(t: Tables) -> dict[str, DataFrame]:
    """The five inputs under the retailer's dataset names (lazy views)."""
    return {name: view(t) for name, view in VIEWS.items()}
