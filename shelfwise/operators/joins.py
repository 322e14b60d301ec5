"""Validated equi joins and join fan-out prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VALIDATIONS = {"m:1": ("right",), "1:1": ("left", "right"), "1:m": ("left",), "m:m": ()}


def one_per_key(df: DataFrame, on: list[str], message: str) -> DataFrame:
    """``df``, but the job that reads it fails if a key occurs twice.

    Rows are grouped by the key into (count, first row). The grouping is dealt by the key, and an
    equi join on it asks for nothing else: the check costs no scan and no shuffle beside the join's own.
    Keys hardly repeat, so rows are dealt before they are grouped: no task sorts a whole input split first.
    """
    others = [c for c in df.columns if c not in on]
    row = [F.first(F.struct(*others)).alias("_row")] if others else []
    grouped = df.repartition(*on).groupBy(*on).agg(F.count(F.lit(1)).alias("_copies"), *row)
    ok = F.when(F.col("_copies") > 1, F.raise_error(F.lit(message))).otherwise(F.lit(True))
    return grouped.where(ok).select(*[F.col(c) if c in on else F.col(f"_row.{c}").alias(c) for c in df.columns])


def join_validated(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    validate: str | None = "m:1",
    fill: dict | None = None,
) -> DataFrame:
    """Equi join whose cardinality is asserted inside the same job, in the join's own shuffle.

    ``validate="m:1"`` fails the job when a key occurs twice on the right (which is
    also what proves a left join keeps the left row count, so no recount is needed).
    ``fill`` replaces nulls brought in by unmatched rows. A job that reads left columns alone has no
    use for the join, and Spark drops it with its check.

    Spark splits a hot key's partition only where both sides come straight from a shuffle. Where one key
    may hold much of ``left``, hand in a ``right`` that is checked and written already
    (``materialize_small(one_per_key(...))``) and ``validate=None``.
    """
    if validate is not None:
        sides = _VALIDATIONS[validate]
        if "right" in sides:
            right = one_per_key(right, on, f"join key {on} is not unique on the right side ({validate})")
        if "left" in sides:
            left = one_per_key(left, on, f"join key {on} is not unique on the left side ({validate})")
    out = left.join(right, on=on, how=how)
    if fill:
        out = out.fillna(fill)
    return out


def fanout(fact: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Keys duplicated on ``right`` and the extra rows a join with ``fact`` would make.

    Output: the key columns, ``len`` (copies on the right), ``filas_train`` (fact rows
    with that key) and ``filas_adicionales = filas_train * (len - 1)``.
    """
    dup = right.groupBy(*on).agg(F.count(F.lit(1)).alias("len")).where(F.col("len") > 1)
    per_key = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("filas_train"))
    return dup.join(per_key, on=on, how="left").withColumn(
        "filas_adicionales", F.col("filas_train") * (F.col("len") - 1)
    )
