"""Data-quality profile: shape, types, nulls, duplicates, date range."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def profile(df: DataFrame, dataset: str) -> DataFrame:
    """Per column: type name, rows, nulls and ``round(100 * nulls / rows, 4)``.

    One aggregation pass computes ``count(*)`` and ``count(col)`` for every column;
    the wide one-row result is turned long with ``inline`` (no second pass).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(t).alias("data_type"),
            (F.col("_rows") - F.col(f"_nn{i}")).alias("nulls"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    long = wide.select(F.col("_rows").alias("rows"), F.inline(F.array(*entries)))
    pct = F.when(
        F.col("rows") > 0, F.round(F.col("nulls") * 100.0 / F.col("rows"), 4)
    ).otherwise(F.lit(0.0))
    return long.select(
        F.lit(dataset).alias("dataset"),
        "column",
        "data_type",
        F.col("rows").cast("bigint").alias("rows"),
        F.col("nulls").cast("bigint").alias("nulls"),
        pct.alias("null_pct"),
    )


def profile_all(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _union_all([profile(df, name) for name, df in frames.items()])


def duplicate_count(df: DataFrame, dataset: str) -> DataFrame:
    """Rows, distinct full rows and their difference, from one hash aggregation.

    Grouping by every column gives each distinct row with its multiplicity; summing
    the multiplicities gives the row count, counting the groups gives the distinct
    count. Nulls group together, as in a whole-row ``unique``.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
    ).select(
        F.lit(dataset).alias("dataset"),
        "rows",
        "distinct_rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
    )


def duplicate_count_all(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _union_all([duplicate_count(df, name) for name, df in frames.items()])


def value_range(frames: Mapping[str, DataFrame], column: str = "date") -> DataFrame:
    """Min and max of ``column`` for the datasets that have it."""
    parts = [
        df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))
        .select(F.lit(name).alias("dataset"), "min_value", "max_value")
        for name, df in frames.items()
        if column in df.columns
    ]
    return _union_all(parts)


def load_summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per dataset. The counts prune every column from the scans."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("filas")).select(
            F.lit(name).alias("dataset"), "filas", F.lit(len(df.columns)).alias("columnas")
        )
        for name, df in frames.items()
    ]
    return _union_all(parts)
