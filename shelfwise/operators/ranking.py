"""Shares of a grand total, global ordinal ranks and top-k, without one-partition windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.exact import totals
from shelfwise.session import checkpoint_dir
from shelfwise.sources.sinks import materialize_small

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | row index


def share_of_total(df: DataFrame, value: str, out: str, scale: float = 100.0) -> DataFrame:
    """``scale * value / sum(value)``; the total is a one-row scalar subquery.

    ``sum(...) over ()`` would move every row to a single partition; the scalar
    subquery is computed once and shipped to the tasks. ``df`` is written first, so what it derives
    from is read once for both; the total is exact.
    """
    df = materialize_small(df, "shares")
    total = totals(df, [], value).select("total").scalar()
    return df.withColumn(out, F.try_divide(F.col(value) * F.lit(scale), total))


def ordinal_rank(
    df: DataFrame,
    order: list[Column],
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """Dense ordinal rank 1..n of every row under ``order`` (give it a unique tie-break).

    Range-partitions by ``order`` and sorts each partition, numbers rows inside each
    partition, then adds the row counts of all earlier partitions (a table with one
    row per partition). The ranged data is checkpointed to the shared checkpoint
    folder first: range bounds come from a sample, and both uses must see the same
    partitions, also after an executor is lost.
    """
    checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    local = F.col("_pos") - F.shiftleft(F.col("_pid").cast("bigint"), _LOCAL_BITS)
    # ``offsets`` has one row per range partition: a proven bound, broadcast it.
    return (
        ranged.join(F.broadcast(offsets), on="_pid")
        .withColumn(out, (F.col("_off") + local + 1).cast("int"))
        .drop("_pid", "_pos", "_off")
    )


def reverse_rank(df: DataFrame, rank_col: str, out: str) -> DataFrame:
    """``n + 1 - rank``: the ascending rank from a descending one, n as a scalar."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return df.withColumn(out, (n + 1 - F.col(rank_col)).cast("int"))


def listed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Every row with its place in the list under ``order`` as ``posicion`` (give it a unique tie-break)."""
    return ordinal_rank(df, order, "posicion")


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows under ``order``: each task keeps its own n best, then merges."""
    return df.orderBy(*order).limit(n)
