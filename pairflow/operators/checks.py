"""Multiset comparison of two datasets (K1: "contains in any order").

Both inputs are tagged +1 / -1 and summed per distinct row: a partial
aggregate and one exchange, so a row repeated a billion times costs one
counter, not a billion output rows.  The result lists only differences:
``cols..., side, n`` with ``side`` = ``missing`` (in expected, not in
actual) or ``unexpected`` and ``n`` the surplus multiplicity.  It is what
``expected.exceptAll(actual)`` and ``actual.exceptAll(expected)`` hold,
with repeats counted instead of replicated.

``multiset_digest`` sums a dataset up in one row that doesn't depend on order:
the number of rows and two sums of row hashes.  It needs no shuffle of rows, so
``checked`` carries the comparison inside a query's own plan: the job fails
where the datasets differ, before it hands on a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

MISSING = "missing"
UNEXPECTED = "unexpected"


def multiset_diff(expected: DataFrame, actual: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = list(cols) if cols else list(expected.columns)
    tagged = expected.select(*cols, F.lit(1).cast("bigint").alias("_d")).unionByName(
        actual.select(*cols, F.lit(-1).cast("bigint").alias("_d"))
    )
    delta = tagged.groupBy(*cols).agg(F.sum("_d").alias("_d")).where(F.col("_d") != 0)
    side = F.when(F.col("_d") > 0, F.lit(MISSING)).otherwise(F.lit(UNEXPECTED))
    return delta.select(*cols, side.alias("side"), F.abs(F.col("_d")).alias("n"))


class MultisetMismatch(AssertionError):
    pass


def assert_same_multiset(expected: DataFrame, actual: DataFrame, cols: list[str] | None = None, show: int = 20) -> None:
    """Raise if the two datasets differ as multisets; the message shows a few differences."""
    diff = multiset_diff(expected, actual, cols)
    sample = diff.take(show)
    if sample:
        lines = "\n".join(str(r.asDict()) for r in sample)
        raise MultisetMismatch(f"datasets differ (first {len(sample)} differences):\n{lines}")


def _row_parts(df: DataFrame, cols: list[str]) -> list[Column]:
    """What a row's hash is taken of: a null differs from every value and from a
    neighbour's null; arrays, structs and maps go by their JSON text."""
    parts: list[Column] = []
    for c in cols:
        flat = isinstance(df.schema[c].dataType, AtomicType)
        v = F.col(c) if flat else F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        parts += [F.col(c).isNull(), v]
    return parts


def multiset_digest(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row ``(n, digest)``: equal for datasets that are equal as multisets.

    ``digest`` holds two sums of 64-bit row hashes with different seeds.  Sums,
    unlike exclusive or, keep multiplicities; they are exact decimals, so the
    order of rows doesn't matter.  Partial sums per task, one tiny exchange.
    Datasets that differ have equal digests with a probability near 2^-128.
    An empty dataset is ``(0, '0:0')``.
    """
    cols = list(cols) if cols else list(df.columns)
    parts = _row_parts(df, cols)
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")), F.lit(0)).cast("string") for seed in (1, 2)]
    return df.agg(F.count(F.lit(1)).alias("n"), F.concat_ws(":", *sums).alias("digest"))


def checked(actual: DataFrame, expected: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``actual``, whose job fails if it differs from ``expected`` as a multiset.

    Both digests are scalar subqueries of the plan, compared by a row of its own
    that is never returned, so an empty ``actual`` is compared too; nothing is
    collected and no extra action runs."""
    one = lambda df: multiset_digest(df, cols).select(F.to_json(F.struct("n", "digest"))).scalar()
    want, got = one(expected), one(actual)
    message = F.concat(F.lit("datasets differ: expected "), want, F.lit(", got "), got)
    fails = F.when(want == got, F.lit(False)).otherwise(F.raise_error(message).cast("boolean"))
    guard = actual.sparkSession.range(1).where(fails)
    return actual.unionByName(guard.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in actual.schema.fields]))
