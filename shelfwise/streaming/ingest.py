"""Incremental arrival of input files: the CSV contract as a Structured Streaming source.

The reference is a batch pipeline and has no streams. When new CSV files for an input
keep landing in a folder, this reads them with the same contract as the batch source
(text schema, checked names, explicit casts) and appends them to a Parquet stage
table; the batch operators then read that table. Exactly-once comes from the stream's
checkpoint plus the file sink's commit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.sources.contract import typed


def contract_stream(spark: SparkSession, folder: str, header: list[str],
                    columns: dict[str, T.DataType], max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame over CSV files in ``folder`` with columns ``header`` (text),
    typed by ``columns``. A stream needs its schema up front, hence ``header``."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = (spark.readStream.schema(text).option("header", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(folder))
    return typed(raw, columns, folder)


def append_to_stage(stream: DataFrame, out_path: str, checkpoint: str,
                    partition_by: list[str] | None = None, available_now: bool = True) -> StreamingQuery:
    """Append each micro-batch to Parquet at ``out_path``.

    ``available_now`` processes what is there and stops (a scheduled incremental batch);
    otherwise the query keeps running.
    """
    w = stream.writeStream.format("parquet").option("path", out_path).option(
        "checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
