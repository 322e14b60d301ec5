"""Data-quality gates: key checks, lazy in-plan assertions and a check report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A frame misses columns an operator requires."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "frame") -> None:
    """Fail, naming the sorted missing columns, when ``df`` lacks any of ``columns``.

    Reads only the schema: no job runs.
    """
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{what} is missing columns: {missing}")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("filas"))
        .where(F.col("filas") > 1)
    )


def guard(df: DataFrame, violations: DataFrame, message: str) -> DataFrame:
    """Return ``df`` unchanged, but fail the job that reads it if ``violations`` has rows.

    The check is an uncorrelated scalar subquery in a filter, so it runs inside the
    consumer's job (once, its one-row result shipped to executors) rather than as a
    separate action on the driver.
    """
    n_bad = violations.agg(F.count(F.lit(1))).scalar()
    ok = F.when(n_bad > 0, F.raise_error(F.lit(message))).otherwise(F.lit(True))
    return df.where(ok)


def require_rows(df: DataFrame, least: int, message: str) -> DataFrame:
    """Return ``df``, or raise when it has fewer than ``least`` rows.

    Runs at once (an empty frame has no row on which a lazy check could fail), and reads no more
    than ``least`` rows of what are small derived tables.
    """
    if df.limit(least).count() < least:
        raise ValueError(message)
    return df


def expect(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: ``(check, violations)``. Each input holds the violating rows."""
    parts = [
        frame.agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
        .select(F.lit(name).alias("check"), "violations")
        for name, frame in checks.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def expect_in_one_pass(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Several checks over one frame in a single aggregation: ``{name: count expr}``.

    Each expression counts the violations (e.g. ``count_if(col is null)``); the one-row
    result is turned into ``(check, violations)`` rows with ``inline``.
    """
    wide = df.agg(*[expr.cast("bigint").alias(f"_c{i}") for i, expr in enumerate(checks.values())])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").alias("violations"))
        for i, name in enumerate(checks)
    ])))


def union_reports(*reports: DataFrame) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def raise_on_failures(report: DataFrame) -> None:
    """Report edge: collect the (small) check report and raise on any violation."""
    failed = [(r["check"], r["violations"]) for r in report.where("violations > 0").collect()]
    if failed:
        raise ValueError(f"data-quality checks failed: {failed}")
