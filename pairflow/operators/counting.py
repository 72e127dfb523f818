"""countByValue (A1): one row per distinct element with its count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by_value(df: DataFrame, cols: list[str] | None = None, out: str = "n") -> DataFrame:
    """Count each distinct element; the element is all of ``cols`` (default: every column).

    Plan: partial count per task, one exchange on the element, final count,
    so a value that makes up a third of the input is pre-aggregated on
    every map task before it is shuffled.  A null element is its own group.
    """
    cols = list(cols) if cols else list(df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))
