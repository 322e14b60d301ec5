"""CSV sources under a column contract: read as text, check names, cast by name.

Types are not inferred (inference is a pass over the data and guesses); the file is
read as strings, the required columns are checked from the header alone, and each
contracted column is cast explicitly. Extra columns and any column order are allowed,
as in the reference. Under ANSI a bad value fails the job instead of becoming null.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.expect import require_columns

# Fixed values of the reference: input files and their required columns.
FILES = {
    "train": "train.csv",
    "stores": "stores.csv",
    "transactions": "transactions.csv",
    "holidays_events": "holidays_events.csv",
    "oil": "oil.csv",
}
CONTRACTS: dict[str, dict[str, T.DataType]] = {
    "train": {"id": T.LongType(), "date": T.DateType(), "store_nbr": T.LongType(),
              "family": T.StringType(), "sales": T.DoubleType(), "onpromotion": T.LongType()},
    "stores": {"store_nbr": T.LongType(), "city": T.StringType(), "state": T.StringType(),
               "type": T.StringType(), "cluster": T.LongType()},
    "transactions": {"date": T.DateType(), "store_nbr": T.LongType(), "transactions": T.LongType()},
    "holidays_events": {"date": T.DateType(), "type": T.StringType(), "locale": T.StringType(),
                        "locale_name": T.StringType(), "description": T.StringType(),
                        "transferred": T.BooleanType()},
    "oil": {"date": T.DateType(), "dcoilwtico": T.DoubleType()},
}


def typed(raw: DataFrame, columns: dict[str, T.DataType], what: str = "file",
          date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Check the contracted names, then cast them; other columns stay text."""
    require_columns(raw, columns, what)
    out = []
    for c in raw.columns:
        t = columns.get(c)
        if t is None:
            out.append(F.col(c))
        elif isinstance(t, T.DateType):
            out.append(F.to_date(F.col(c), date_format).alias(c))
        elif isinstance(t, T.StringType):
            out.append(F.col(c))
        else:
            out.append(F.col(c).cast(t).alias(c))
    return raw.select(*out)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file or folder is there, asked of the file system that Spark would read it from."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def read_contract(spark: SparkSession, path: str, columns: dict[str, T.DataType],
                  date_format: str = "yyyy-MM-dd") -> DataFrame:
    """One CSV file (or folder of parts) with a header, typed by ``columns``."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"required file does not exist: {path}")
    try:
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    except Exception as error:  # noqa: BLE001 - re-raised with the file named
        raise RuntimeError(f"could not read {path}") from error
    return typed(raw, columns, os.path.basename(path.rstrip("/")), date_format)


def load_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The five inputs from ``root``; a missing file or column fails before any job."""
    return {name: read_contract(spark, f"{root.rstrip('/')}/{fname}", CONTRACTS[name])
            for name, fname in FILES.items()}
