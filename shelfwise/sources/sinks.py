"""Sinks: Parquet stage tables, typed DDL for relational targets, JDBC writes, manifests."""

from __future__ import annotations

import hashlib
import re
import threading
import uuid
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import checkpoint_dir

# ---- stage tables --------------------------------------------------------------------

_STAGED: dict[tuple[str, str], str] = {}
_COUNTS: dict[str, dict[str, int]] = {}
_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock_for(path: str) -> threading.Lock:
    """One lock per stage table: concurrent callers write a table once, while
    different tables (e.g. the five inputs) are staged side by side."""
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(path, threading.Lock())


def stage_path(spark: SparkSession, name: str, key: str) -> str:
    digest = hashlib.sha1(f"{spark.sparkContext.applicationId}|{key}".encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/shelfwise-stage/{name}-{digest}"


def _null_cells(df: DataFrame) -> Column:
    return sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).cast("bigint")


def stage_table(
    df: DataFrame | Callable[[], DataFrame],
    name: str,
    key: str,
    sort_by: list[str] | None = None,
    spark: SparkSession | None = None,
    partition_by: list[str] | None = None,
    check: Callable[[dict[str, int]], None] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (later plans start from a pruned, pushed-down Parquet scan instead
    of re-deriving the table) and survives executor loss, since the files live in the
    shared folder. Within one application the same ``(name, key)`` is written once.
    ``sort_by`` clusters rows inside each file so Parquet min/max statistics can skip
    row groups (no extra shuffle); ``partition_by`` lays the table out in folders (``write_table``).
    ``df`` may be a function building the frame, so a staged table costs no plan construction at all.

    Rows and null cells are counted on the rows as they are written (``Observation`` on the last
    stage, whose tasks count once whatever is retried) and kept: ``staged_counts``. ``check`` gets the
    counts after the write and may raise; then the table is not taken over.
    """
    from pyspark.sql import Observation

    spark = spark or df.sparkSession
    path = stage_path(spark, name, key)
    with _lock_for(path):
        if (name, path) not in _STAGED:
            frame = df() if callable(df) else df
            seen = Observation()
            counted = lambda d: d.observe(seen, F.count(F.lit(1)).alias("rows"), _null_cells(d).alias("nulls"))
            write_table(frame, path, partition_by, sort_by, last=counted, dealt=dealt)
            counts = {"rows": int(seen.get["rows"]), "nulls": int(seen.get["nulls"])}
            if check is not None:
                check(counts)
            _COUNTS[path] = counts
            _STAGED[(name, path)] = path
    return spark.read.parquet(path)


def staged_counts(spark: SparkSession, name: str, key: str) -> dict[str, int]:
    """``rows`` and ``nulls`` counted while the stage table was written."""
    return dict(_COUNTS[stage_path(spark, name, key)])


def written_bytes(spark: SparkSession, path: str) -> int:
    """Size of what was written under ``path``, from its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength())


def materialize_small(df: DataFrame, name: str) -> DataFrame:
    """Write a small derived table (e.g. holiday dates x offsets) and read it back.

    Catalyst estimates a table derived from the fact by the fact's size, so a join
    with it would shuffle the fact. Read back from its own files, the planner sees the
    real size and broadcasts it only if it is under the broadcast threshold: a size
    check by Spark itself, with a sort-merge join beyond it.
    """
    return stage_table(df, name, uuid.uuid4().hex)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
    last: Callable[[DataFrame], DataFrame] = lambda df: df,
    dealt: bool = False,
) -> None:
    """Parquet sink, optionally partitioned (e.g. by month) and clustered for skipping.

    Partitioned rows are dealt by the partition columns first, or every task would write a file in
    every folder; the rebalance splits a large month over tasks and joins small ones, unless the rows are ``dealt``
    by these columns already. ``last`` is applied to the frame that is written.
    """
    if partition_by and not dealt:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    order = [*(partition_by or []), *(sort_by or [])]
    out = last(df.sortWithinPartitions(*order) if order else df)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_and_analyze(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register written Parquet files as a catalog table and compute its statistics
    (row count, size, per-column min/max/nulls/distinct), which the planner then uses
    for join and broadcast decisions: the ANALYZE step after an export."""
    ident = quote_identifier(name).replace('"', "`")
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    spark.catalog.createTable(name, path=path, source="parquet")
    spark.sql(f"ANALYZE TABLE {ident} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.table(name)


def estimated_rows(df: DataFrame) -> int | None:
    """Rows that the planner expects of ``df``; None where it has no row count to go by."""
    count = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(count.get())) if count.isDefined() else None


# ---- relational target: identifiers and types ----------------------------------------

IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quote_identifier(name: str) -> str:
    """Validate ``[A-Za-z_][A-Za-z0-9_]*`` and double-quote it."""
    if not IDENTIFIER.match(name):
        raise ValueError(f"invalid identifier: {name!r}")
    return f'"{name}"'


def sql_type(dt: T.DataType) -> str:
    """Target column type for a Spark type; nested types are rejected."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return "INTEGER"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.DecimalType):
        return f"NUMERIC({dt.precision},{dt.scale})"
    if isinstance(dt, T.FloatType):
        return "REAL"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE PRECISION"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP WITH TIME ZONE"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP WITHOUT TIME ZONE"
    if isinstance(dt, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "INTERVAL"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "TEXT"
    if isinstance(dt, T.BinaryType):
        return "BYTEA"
    if isinstance(dt, T.NullType):
        return "TEXT"
    if hasattr(T, "TimeType") and isinstance(dt, getattr(T, "TimeType")):
        return "TIME"
    raise TypeError(f"no target type for {dt.simpleString()}")


def create_table_ddl(schema_name: str, table: str, schema: T.StructType) -> str:
    cols = ", ".join(f"{quote_identifier(f.name)} {sql_type(f.dataType)}" for f in schema.fields)
    return f"CREATE TABLE {quote_identifier(schema_name)}.{quote_identifier(table)} ({cols})"


# Indexed columns per exported table.
INDEXES = {
    "consolidado": [["date"], ["store_nbr"], ["family"]],
    "ventas_por_tienda": [["store_nbr"]],
    "ventas_por_mes": [["anio", "mes"]],
    "feriados_ventana_tres_dias": [["family"], ["dias_relativo_feriado"]],
    "promociones_por_familia": [["family"]],
    "petroleo_ventas_mensuales": [["anio", "mes"]],
    "petroleo_sensibilidad_ciudades": [["city"]],
    "transacciones_por_tienda": [["store_nbr"]],
}


def index_ddl(schema_name: str, table: str, columns: list[str]) -> list[str]:
    """CREATE INDEX statements for the table's indexes whose columns all exist."""
    out = []
    for cols in INDEXES.get(table, []):
        if all(c in columns for c in cols):
            idx = quote_identifier(f"idx_{table}_{'_'.join(cols)}")
            out.append(
                f"CREATE INDEX IF NOT EXISTS {idx} ON {quote_identifier(schema_name)}."
                f"{quote_identifier(table)} ({', '.join(quote_identifier(c) for c in cols)})"
            )
    return out


STAGING = "__staging"


def staging_table(table: str, run: str) -> str:
    return f"{table}{STAGING}_{run}"


def jdbc_options(url: str, schema_name: str, staging: str, batch_size: int = 50_000,
                 num_partitions: int | None = None) -> dict[str, str]:
    """Options for a parallel JDBC append to the staging table, which exists with its own types.

    Executors insert their partitions concurrently in batches of ``batch_size``. Spark commits per
    partition, so readers see the table only after the swap (``swap_statements``).
    """
    opts = {
        "url": url,
        "dbtable": f"{quote_identifier(schema_name)}.{quote_identifier(staging)}",
        "batchsize": str(batch_size),
        "isolationLevel": "READ_COMMITTED",
    }
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    return opts


def prepare_statements(schema_name: str, staging: str, schema: T.StructType) -> list[str]:
    """Before the write: the schema, then an empty staging table with the target types."""
    s = quote_identifier(schema_name)
    return [
        f"CREATE SCHEMA IF NOT EXISTS {s}",
        f"DROP TABLE IF EXISTS {s}.{quote_identifier(staging)}",
        create_table_ddl(schema_name, staging, schema),
    ]


def drop_statements(schema_name: str, staging: str) -> list[str]:
    return [f"DROP TABLE IF EXISTS {quote_identifier(schema_name)}.{quote_identifier(staging)}"]


def swap_statements(schema_name: str, table: str, staging: str, columns: list[str]) -> list[str]:
    """After the write, as one transaction: rename, indexes, statistics."""
    s, t = quote_identifier(schema_name), quote_identifier(table)
    return [
        f"DROP TABLE IF EXISTS {s}.{t}",
        f"ALTER TABLE {s}.{quote_identifier(staging)} RENAME TO {t}",
        *index_ddl(schema_name, table, columns),
        f"ANALYZE {s}.{t}",
    ]


def execute_statements(spark: SparkSession, url: str, statements: list[str], properties: dict | None = None) -> None:
    """Run statements over one JDBC connection of the driver, all or none."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(str(k), str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def count_rows(spark: SparkSession, url: str, dbtable: str, properties: dict | None = None) -> int:
    """Rows that the target table holds, counted by the database."""
    query = f"SELECT COUNT(*) AS n FROM {dbtable}"
    return int(spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load().first()[0])


class IncompleteExport(RuntimeError):
    """The staging table holds other rows than were sent."""


def write_jdbc(df: DataFrame, url: str, schema_name: str, table: str, properties: dict | None = None,
               batch_size: int = 50_000, num_partitions: int | None = None, run: str | None = None, attempts: int = 2,
               execute=execute_statements, count=count_rows) -> int:
    """Export one table: a staging table of this run, a parallel append, a count, and only then the swap.

    Spark commits partition by partition, so a task that is lost after its commit and run again has
    sent its rows twice. The rows sent are counted while they are written (on the last stage, once per
    partition) and compared with the rows that the database counts: only equal counts are swapped in.
    Otherwise the staging table is dropped and filled anew, at most ``attempts`` times, then
    ``IncompleteExport`` is raised; readers keep the former table throughout. A run that dies leaves its
    own staging table behind and nothing else. Returns the rows exported.

    Needs a reachable database and its driver; ``execute`` runs statements, ``count`` counts the staging table.
    """
    from pyspark.sql import Observation

    spark = df.sparkSession
    staging = staging_table(table, run or uuid.uuid4().hex[:12])
    opts = {**jdbc_options(url, schema_name, staging, batch_size, num_partitions), **(properties or {})}
    for _ in range(attempts):
        execute(spark, url, prepare_statements(schema_name, staging, df.schema), properties)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("jdbc").options(**opts).mode("append").save()
        sent, held = int(seen.get["rows"]), count(spark, url, opts["dbtable"], properties)
        if sent == held:
            execute(spark, url, swap_statements(schema_name, table, staging, df.columns), properties)
            return sent
        execute(spark, url, drop_statements(schema_name, staging), properties)
    raise IncompleteExport(f"{table}: {sent} rows sent, {held} in the staging table")


# ---- manifest and completeness --------------------------------------------------------

def require_complete(tables: Mapping[str, DataFrame | None], expected: list[str]) -> None:
    """Every expected table must be present before anything is exported."""
    missing = [n for n in expected if tables.get(n) is None]
    if missing:
        raise FileNotFoundError(f"missing tables, run the earlier stages first: {missing}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, one count job per table, unioned lazily."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("filas")).select(
            F.lit(name).alias("tabla"), "filas", F.lit(len(df.columns)).alias("columnas"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_with_manifest(tables: Mapping[str, DataFrame], root: str, parallel: int = 4) -> list[dict]:
    """Write every table as Parquet under ``root``; rows are counted during the write
    with an ``Observation`` (no second scan). Returns the manifest rows in input order.

    Up to ``parallel`` tables are written at once: Spark runs concurrent jobs of one
    session side by side, so small tables do not leave the cluster idle one by one.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import Observation

    def write(item: tuple[str, DataFrame]) -> dict:
        name, df = item
        obs = Observation(f"manifest_{name}")
        t0 = time.time()
        df.observe(obs, F.count(F.lit(1)).alias("filas")).write.mode("overwrite").parquet(f"{root}/{name}")
        return {"tabla": name, "filas": obs.get["filas"], "columnas": len(df.columns),
                "segundos": round(time.time() - t0, 3)}

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(write, tables.items()))
