"""Cleaning of record files as they arrive.

Cleaning and the row filters keep no state, so the batch functions run unchanged on a stream.
Sampling, splits and metrics look at whole tables and stay batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docketry.operators.frames import prepare_base
from docketry.schema import RecordSchema
from docketry.sources.tables import csv_options, null_strings


def read_arriving(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    encoding: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """New CSV files of a folder, all columns as text; without ``multi_line``, large UTF-8 files are split."""
    fields = ", ".join(f"`{c}` string" for c in columns)
    options = csv_options(folder, encoding, multi_line)
    return null_strings(spark.readStream.schema(fields).options(**options).csv(folder))


def clean_arriving(
    raw: DataFrame, table_path: str, checkpoint: str, schema: RecordSchema = RecordSchema()
) -> StreamingQuery:
    """Clean everything that has arrived so far into a Parquet table, then stop."""
    return (
        prepare_base(raw, schema)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
