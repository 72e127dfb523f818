"""The keyed operators on Structured Streaming.

The operators are plain DataFrame functions, so they apply to a streaming
DataFrame unchanged: ``count_by_value`` and ``sum_by_key`` become stateful
streaming aggregations (update or complete mode), ``words`` / ``flat_map``
stay stateless (append mode), and ``join`` with a static table is a
stream-static join.  This module only opens sources and starts queries;
the checkpoint of every query lives under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pairflow.session import ensure_checkpoint_dir


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files in ``path`` as a stream (schema declared, never inferred)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before starting a streaming query")
    return f"{base.rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"


def start_to_memory(df: DataFrame, name: str, output_mode: str = "update", available_now: bool = True) -> StreamingQuery:
    """Run a streaming DataFrame into an in-memory table ``name`` (tests, notebooks)."""
    writer = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_to_parquet(df: DataFrame, path: str, name: str, available_now: bool = False) -> StreamingQuery:
    """Append a stateless (or watermarked) stream to Parquet files, exactly once."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
