"""Time-series operators: percent change, positional shifts, lag scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import is_finite, safe_corr


def pct_change(df: DataFrame, order: str, cols: dict[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """``100 * (x / previous x - 1)`` for each ``{source: output}``, row by row in ``order``.

    Positional, as in the reference: a missing month compares with the last present
    one. A zero base gives null. ``by`` runs it per series; without ``by`` the window
    is unpartitioned, which is only meant for series of bounded length (months).
    """
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    for src, dst in cols.items():
        prev = F.lag(src).over(w)
        df = df.withColumn(dst, F.try_multiply(F.try_divide(F.col(src), prev) - 1, F.lit(100.0)))
    return df


def number_rows(df: DataFrame, order: str, by: tuple[str, ...] = (), out: str = "_rn") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return df.withColumn(out, F.row_number().over(w))


def lag_scan(
    df: DataFrame,
    order: str,
    x: str,
    y: str,
    lags: list[int],
    min_pairs: int = 3,
) -> DataFrame:
    """Correlation of ``x`` with ``y`` shifted back by k rows, for every k in one job.

    The shift is a positional self join ``b.rn = a.rn + k`` with the lags exploded on
    one side, so all lags share one scan. Pairs with a missing or non-finite side are
    dropped; fewer than ``min_pairs`` pairs give a null correlation.
    Output: ``lag_meses``, ``correlacion``, ``meses_comparados``.
    """
    numbered = number_rows(df.select(order, x, y), order)
    a = _with_lags(numbered.select(F.col("_rn").alias("_a_rn"), F.col(x).alias("_x")), lags)
    a = a.withColumn("_b_rn", F.col("_a_rn") + F.col("lag_meses"))
    b = numbered.select(F.col("_rn").alias("_b_rn"), F.col(y).alias("_y"))
    pairs = a.join(b, on="_b_rn").where(is_finite("_x") & is_finite("_y"))
    scored = pairs.groupBy("lag_meses").agg(
        safe_corr("_x", "_y").alias("_r"), F.count(F.lit(1)).alias("meses_comparados")
    )
    # Lags with no pair at all still get a row (count 0), as in the reference's loop.
    all_lags = _lag_frame(df, lags)
    return all_lags.join(scored, on="lag_meses", how="left").select(
        "lag_meses",
        F.when(
            (F.col("meses_comparados") >= min_pairs) & is_finite("_r"), F.col("_r")
        ).alias("correlacion"),
        F.coalesce(F.col("meses_comparados"), F.lit(0)).cast("bigint").alias("meses_comparados"),
    )


def _lag_frame(df: DataFrame, lags: list[int]) -> DataFrame:
    return df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag_meses")
    )


def _with_lags(df: DataFrame, lags: list[int]) -> DataFrame:
    """Each row once per lag (a fixed, small multiplier)."""
    return df.withColumn("lag_meses", F.explode(F.array(*[F.lit(k) for k in lags])))


def best_lag(scan: DataFrame) -> DataFrame:
    """The lag with the highest positive correlation; the smaller lag wins ties.

    Zero rows when no correlation is positive.
    """
    return (
        scan.where(F.col("correlacion") > 0)
        .orderBy(F.col("correlacion").desc(), F.col("lag_meses").asc())
        .limit(1)
    )


def shift_within(
    df: DataFrame, by: list[str], order: str, value: str, lag: Column, out: str
) -> DataFrame:
    """``value`` taken ``lag`` rows later inside each ``by`` series (lead by a data-dependent k).

    ``lead`` needs a literal offset, so this numbers the rows per series and joins each
    row to the row ``lag`` positions ahead. ``lag`` may be a scalar subquery.
    """
    numbered = number_rows(df, order, tuple(by))
    ahead = numbered.select(*by, F.col("_rn").alias("_ahead_rn"), F.col(value).alias(out))
    return (
        numbered.withColumn("_ahead_rn", F.col("_rn") + lag)
        .join(ahead, on=[*by, "_ahead_rn"], how="left")
        .drop("_rn", "_ahead_rn")
    )
