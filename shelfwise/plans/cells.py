"""Staged cell tables: the exact sums that every coarser aggregate is answered from.

Two mergeable aggregates of the fact are written once:

- ``family_cells``: day x family x holiday flag x promotion flag, one scan combined on the map side, bounded by the calendar and the product
  families however large the fact is, with the day's price;
- ``store_cells``: day x store, with city and state, and what the checks of ``transactions`` need; one scan, one shuffle.

A cell carries the state of its sum (``functions.exact``), not a rounded double, so a total over cells is the
double nearest to the true sum of the sales rows. The analyses take a fact or cells alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import month_start
from shelfwise.functions.exact import STATE, accumulate, has_state

SALES = "sales"
SPREAD_ROWS = 50_000_000  # a month's store cells are dealt over one more partition for each so many rows of the fact
TRAFFIC = {"transactions_least": ("min", "transactions_least"), "transactions_most": ("max", "transactions_most"), "transactions_known": ("sum", "transactions_known")}


def measure(df: DataFrame) -> list[str]:
    """The columns that a sum of sales reads: the values, or their state."""
    return STATE if has_state(df) else [SALES]


def dimensions(df: DataFrame, *columns: str) -> list[str]:
    """Columns to require of ``df``: these, and the measure."""
    return [*columns, *measure(df)]


def with_traffic(df: DataFrame) -> DataFrame:
    """Least, most and number of known ``transactions`` per row (a cell has them already)."""
    if "transactions_known" in df.columns:
        return df
    t = F.col("transactions")
    return df.withColumns({"transactions_least": t, "transactions_most": t, "transactions_known": t.isNotNull().cast("bigint")})


def two_values(rows: Column) -> Column:
    """Whether merged ``with_traffic`` columns show more than one value (null counts as one)."""
    known = F.col("transactions_known")
    return (F.col("transactions_least") < F.col("transactions_most")) | ((known > 0) & (known < rows))


def family_cells(fact: DataFrame) -> DataFrame:
    flags = fact.withColumns({
        "es_feriado_nacional": F.coalesce("es_feriado_nacional", F.lit(False)),
        "onpromotion": (F.coalesce("onpromotion", F.lit(0)) > 0).cast("bigint"),
    })
    return accumulate(flags, ["date", "family", "es_feriado_nacional", "onpromotion"], SALES, extra={"dcoilwtico": ("max", "dcoilwtico")})


def store_cells(fact: DataFrame, rows: int = 0) -> DataFrame:
    """The cells of a month lie in as many partitions as the fact's number of ``rows`` asks for, each month apart.

    A store and day has about as many cells as sales rows where families are few, so the narrow rows are dealt
    once, by month and a hash of store and day, for the sums and for the month folders that they are written to.
    """
    spread = F.pmod(F.xxhash64("store_nbr", "date"), F.lit(rows // SPREAD_ROWS + 1))
    dealt = with_traffic(fact).select(month_start("date").alias("fecha_mes"), spread.alias("_spread"), "date", "store_nbr", "city", "state", *measure(fact), *TRAFFIC)
    return accumulate(dealt.repartition("fecha_mes", "_spread"), dealt.columns[:6], SALES, extra=TRAFFIC).drop("_spread")
