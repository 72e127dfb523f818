"""Reading physical plans the way a Spark user does: from ``explain`` output.

Used by tests to pin the plan shape an operator promises (partial
aggregation before the exchange, number of exchanges, no list gathering in
a join) and by ``tools/plans.py`` to print formatted plans.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle exchanges of the physical plan (broadcasts excluded)."""
    return [ln.strip() for ln in plan_text(df).splitlines() if re.search(r"\bExchange (hash|range|round|single)", ln)]


def has_partial_aggregate(df: DataFrame) -> bool:
    return bool(re.search(r"functions=\[partial_", plan_text(df)))


def gathers_lists(df: DataFrame) -> bool:
    return "collect_list" in plan_text(df)


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan_text(df))

