"""Cleaning: strict date parsing, exact deduplication, median / mode imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.median import exact_median
from shelfwise.sources.sinks import materialize_small

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def parse_date(df: DataFrame, column: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Strict text-to-date: under ANSI any text not matching ``fmt`` fails the job.

    A column that is already a DATE, or absent, is left alone. Nulls stay null.
    """
    if column not in df.columns or isinstance(df.schema[column].dataType, T.DateType):
        return df
    return df.withColumn(column, F.to_date(F.col(column), fmt))


def parse_date_quarantine(
    df: DataFrame, column: str = "date", fmt: str = "yyyy-MM-dd"
) -> tuple[DataFrame, DataFrame]:
    """Lenient variant: ``(good rows parsed, bad rows as text)`` instead of failing."""
    parsed = F.try_to_date(F.col(column), fmt)
    bad = df.where(F.col(column).isNotNull() & parsed.isNull())
    good = df.where(F.col(column).isNull() | parsed.isNotNull()).withColumn(column, parsed)
    return good, bad


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact whole-row duplicates (nulls compare equal), one hash shuffle."""
    return df.dropDuplicates()


def total_nulls(df: DataFrame) -> DataFrame:
    """One-row frame: number of null cells over all columns."""
    if not df.columns:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("nulls"))
    expr = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(expr.cast("bigint").alias("nulls"))


def _imputable(df: DataFrame) -> tuple[list[str], list[str]]:
    numeric, other = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, _NUMERIC):
            numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            other.append(f.name)
    return numeric, other  # dates, timestamps and nested types are never imputed


def _long(df: DataFrame, cols: list[str], cast: str) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value")) for c in cols]
    return df.select(F.inline(F.array(*entries)))


def column_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent non-null value per column, ties to the smallest value.

    Values are compared as text (string and boolean columns). Two hash aggregations:
    counts per (column, value), then the max count per column; no window over a
    column's values.
    """
    counts = (
        _long(df, cols, "string")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("mode_count"))
    )
    best = counts.groupBy("column").agg(F.max("mode_count").alias("mode_count"))
    return (
        counts.join(best, on=["column", "mode_count"])
        .groupBy("column", "mode_count")
        .agg(F.min("value").alias("mode_value"))
    )


def column_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median per numeric column, ``(column, median)``, one distributed pass over ``df``; the few rows are written."""
    return materialize_small(exact_median(_long(df, cols, "double"), ["column"], "value", "median"), "medians")


def _null_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    if not cols:
        return {}
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def impute(df: DataFrame, dataset: str = "", before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Fill nulls: numeric columns with their median, text/boolean with their mode.

    Statistics come from ``df`` as given (the reference imputes after dedup). One pass
    counts the nulls of every column (a one-row result); medians and modes are then
    computed only for the columns that have nulls, so a clean 100 TB table costs one
    scan, not a median per column. Integer columns keep their type (median rounded
    half up). Returns ``(imputed, log)``; the log has one row per column that had
    nulls: ``dataset, column, cantidad, criterio, valor_numerico, valor_texto``. The
    fill values enter the plan as scalar subqueries.

    ``before`` may be the rows that ``df`` is the distinct rows of: a column without nulls there has none
    in ``df`` either, so without any the distinct rows are not shuffled just to be counted. With some,
    ``df`` is written first: counts, statistics and the filled rows then read it back.
    """
    numeric, other = _imputable(df)
    log_schema = "column string, cantidad bigint, criterio string, valor_numerico double, valor_texto string"
    counts = _null_counts(df if before is None else before, numeric + other)
    if before is not None and any(counts.values()):
        df = materialize_small(df, "distinct")
        counts = _null_counts(df, numeric + other)
    numeric = [c for c in numeric if counts.get(c)]
    other = [c for c in other if counts.get(c)]
    spark = df.sparkSession
    log_parts = []
    out = df
    if numeric:
        med = column_medians(df, numeric)
        for c in numeric:
            value = med.where(F.col("column") == c).select("median").scalar()
            dtype = df.schema[c].dataType
            # The schema must not depend on the data, so integer columns keep their
            # type and take the median rounded half up.
            fill = F.round(value) if isinstance(dtype, _INTEGRAL) else value
            out = out.withColumn(c, F.coalesce(F.col(c), fill.cast(dtype)))
        n = spark.createDataFrame([(c, counts[c]) for c in numeric], "column string, cantidad bigint")
        log_parts.append(
            n.join(med, on="column").select(
                "column", "cantidad", F.lit("mediana").alias("criterio"),
                F.col("median").alias("valor_numerico"), F.lit(None).cast("string").alias("valor_texto"))
        )
    if other:
        modes = column_modes(df, other)
        for c in other:
            value = modes.where(F.col("column") == c).select("mode_value").scalar()
            out = out.withColumn(c, F.coalesce(F.col(c), value.cast(df.schema[c].dataType)))
        n = spark.createDataFrame([(c, counts[c]) for c in other], "column string, cantidad bigint")
        log_parts.append(
            n.join(modes, on="column").select(
                "column", "cantidad", F.lit("moda").alias("criterio"),
                F.lit(None).cast("double").alias("valor_numerico"), F.col("mode_value").alias("valor_texto"))
        )
    log = log_parts[0] if log_parts else spark.createDataFrame([], log_schema)
    for p in log_parts[1:]:
        log = log.unionByName(p)
    log = log.select(F.lit(dataset).alias("dataset"), *log.columns)
    return out, log


def cleaning_metrics(df: DataFrame, dataset: str) -> DataFrame:
    """Rows before/after dedup, removed duplicates, null cells before/after imputation.

    All from one pass: grouping by every column yields each distinct row with its
    multiplicity ``n``; rows = sum(n), distinct rows = count, nulls before =
    sum(n * nulls in the row). A null survives imputation only in a column that is
    never imputed (dates) or that has no value at all, so the count after needs no
    imputed values.
    """
    parsed = parse_date(df)
    numeric, other = _imputable(parsed)
    imputable = set(numeric + other)
    groups = parsed.groupBy(*parsed.columns).agg(F.count(F.lit(1)).alias("_n"))
    row_nulls = sum((F.col(c).isNull().cast("bigint") for c in parsed.columns), F.lit(0))
    after = [
        F.count_if(F.col(c).isNull()) if c not in imputable
        else F.when(F.count(F.col(c)) == 0, F.count(F.lit(1))).otherwise(F.lit(0))
        for c in parsed.columns
    ]
    m = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") * row_nulls), F.lit(0)).alias("nulls_before"),
        sum(after, F.lit(0)).alias("nulls_after"),
    )
    return m.select(
        F.lit(dataset).alias("dataset"),
        F.col("rows").cast("bigint").alias("filas_originales"),
        F.col("distinct_rows").cast("bigint").alias("filas_finales"),
        (F.col("rows") - F.col("distinct_rows")).cast("bigint").alias("duplicados_eliminados"),
        F.col("nulls_before").cast("bigint").alias("nulos_antes"),
        F.col("nulls_after").cast("bigint").alias("nulos_despues"),
    )


def clean_table(df: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse dates, drop duplicates, impute. Returns ``(clean, metrics, imputation log)``.

    Metrics: ``dataset, filas_originales, filas_finales, duplicados_eliminados,
    nulos_antes, nulos_despues``.
    """
    parsed = parse_date(df)
    clean, log = impute(dedup(parsed), dataset, before=parsed)
    return clean, cleaning_metrics(df, dataset), log
