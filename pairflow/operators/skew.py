"""Splitting hot keys for operators that keep every value of a group.

Sums and counts pre-aggregate on the map side, so a hot key costs nothing
extra.  An operator that keeps a group's values gives one row per key unless
the caller asks for a split with ``Split``.  The layout then is the chunked
one for every key, whatever the size of the data:

* ``by`` names columns that tell a key's rows apart (an id, a position).
  Their hash deals the rows of a key to ``parts`` parts, so no task sees a
  whole hot key.
* Within a part, rows are numbered in the order of ``by``; a chunk holds at
  most ``max_rows`` of them, exactly, and ends where ``max_bytes`` of ``size``
  would be passed by the next row but one.

Numbering and gathering share one exchange on (key, part).  The parts depend
on content alone, so a task that is run again deals rows as before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairflow.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Split:
    """How to split every key: see the module's text."""

    by: Sequence[str]
    max_rows: int
    parts: int = 32
    size: Column | None = None
    max_bytes: int = 64 << 20

    def __post_init__(self):
        if self.max_rows < 1 or self.parts < 1 or self.max_bytes < 1 or not self.by:
            raise ValueError("a split needs columns and positive bounds")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate result with a reliable checkpoint."""
    if not ensure_checkpoint_dir(df.sparkSession):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint(eager=True)


def with_chunks(df: DataFrame, keys: list[str], split: Split) -> DataFrame:
    """Add a string column ``chunk`` that names a row's chunk within its key."""
    refuse(df, keys, "chunk", "_part", "_row", "_sum")
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*split.by), F.lit(split.parts)))
    order = Window.partitionBy(*keys, "_part").orderBy(*split.by)
    rows = F.floor((F.row_number().over(order) - 1) / split.max_rows)
    full = F.lit(0)
    if split.size is not None:
        full = F.floor((F.sum(split.size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - split.size) / split.max_bytes)
    numbered = dealt.withColumn("_row", rows).withColumn("_sum", full)
    return numbered.withColumn("chunk", F.concat_ws("-", "_part", "_row", "_sum")).drop("_row", "_sum")


def refuse(df: DataFrame, keys: list[str], *reserved: str) -> None:
    """Names that an operator needs for itself can't be key columns."""
    clash = sorted({k for k in keys if k.lower() in reserved})
    if clash:
        raise ValueError(f"reserved column names {clash}; rename these keys")


def as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)
