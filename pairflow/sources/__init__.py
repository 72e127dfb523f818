"""Sources (S1, S2): in-memory rows with an explicit schema, and Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def rows_to_df(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """``parallelize``: a bag of rows with a declared schema (never inferred)."""
    return spark.createDataFrame(list(rows), schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor folder; column pruning and
    filter pushdown reach the scan because nothing is read eagerly."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame, partitions: int, *cols: str) -> DataFrame:
    """Hash-repartition an input that the caller knows to have too few splits
    for heavy per-row work (a table of one row group is one task).  Hashing on
    ``cols`` keeps the placement the same when a task is run again."""
    return df.repartition(partitions, *cols)
