"""Partition lifecycle (U1) and per-step counts (U2).

``map_partitions`` is the DataFrame form of a function object with
set-up, per-bundle and tear-down hooks: it runs in ``mapInPandas``, where
one task sees its partition as a stream of Arrow batches.

    setup()                  -> state, once per task (before the first batch)
    start_bundle(state)      before each batch
    process(state, pdf)      -> pandas DataFrame or None, per batch
    finish_bundle(state)     -> pandas DataFrame or None, after each batch
    teardown(state)          once per task, also when a hook raised

``map_workers`` gives the state a worker process's lifetime: ``setup`` runs
once in a process and serves all its tasks (a loaded model, a connection),
``teardown`` when the process ends.

``observed`` attaches named metrics to a step; they are filled by the next
action on the returned DataFrame, with no extra job.
"""

from __future__ import annotations

import os
import signal
import sys
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, _parse_datatype_string


def map_partitions(
    df: DataFrame,
    process: Callable[[Any, pd.DataFrame], pd.DataFrame | None],
    schema,
    setup: Callable[[], Any] | None = None,
    start_bundle: Callable[[Any], None] | None = None,
    finish_bundle: Callable[[Any], pd.DataFrame | None] | None = None,
    teardown: Callable[[Any], None] | None = None,
) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = setup() if setup else None
        try:
            for pdf in batches:
                if start_bundle:
                    start_bundle(state)
                out = process(state, pdf)
                if out is not None and len(out):
                    yield out
                if finish_bundle:
                    tail = finish_bundle(state)
                    if tail is not None and len(tail):
                        yield tail
        finally:
            if teardown:
                teardown(state)

    return df.mapInPandas(run, schema)


# States of different jobs that a worker process keeps.
MOST_STATES = 4


def _worker_state(token: str, setup: Callable[[], Any], teardown: Callable[[Any], None] | None) -> tuple[Any, bool]:
    """This process's state for ``token``, and whether it was set up just now.

    Spark forks its Python workers and reuses them from task to task.  A worker
    ends by a signal or by ``os._exit``, which skips the interpreter's own exit
    hooks; the states are torn down before either.  A state is also torn down
    when ``MOST_STATES`` newer ones are set up in its process.  A worker that is
    killed outright can't tear down anything.
    """
    states = sys.__dict__.setdefault("_pairflow_worker_states", {})
    if token in states:
        return states[token][0], False
    if not states:

        def close() -> None:
            while states:
                state, end = states.popitem()[1]
                if end:
                    end(state)

        def hung_up(number, frame):
            close()
            signal.signal(number, signal.SIG_DFL)
            signal.raise_signal(number)

        def ended(code, leave=os._exit):
            try:
                close()
            finally:
                leave(code)

        os._exit = ended
        for number in (signal.SIGHUP, signal.SIGTERM):
            signal.signal(number, hung_up)
    while len(states) >= MOST_STATES:
        state, end = states.pop(next(iter(states)))
        if end:
            end(state)
    states[token] = (setup(), teardown)
    return states[token][0], True


def map_workers(
    df: DataFrame,
    process: Callable[[Any, pd.DataFrame], pd.DataFrame | None],
    schema,
    setup: Callable[[], Any],
    teardown: Callable[[Any], None] | None = None,
    name: str | None = None,
) -> tuple[DataFrame, Observation]:
    """``process(state, pdf)`` per batch with a state per worker process.

    Returns the result and an observation of ``setups``, ``tasks`` and
    ``batches``, filled by the next action.  With ``spark.python.worker.reuse``
    (the default) a process serves many tasks, so set-ups are fewer than tasks;
    without it each task has a process and a set-up of its own.  ``process`` must
    not rely on which tasks share a state.
    """
    out = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    counts = ["_setups", "_tasks", "_batches"]
    clash = [c for c in out.names if c.lower() in counts]
    if clash:
        raise ValueError(f"reserved column names {clash}")
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, new = _worker_state(token, setup, teardown)
        seen = 0
        for pdf in batches:
            seen += 1
            made = process(state, pdf)
            if made is not None and len(made):
                yield made.assign(**{c: None for c in counts})
        tally = pd.DataFrame({c: [None] for c in out.names})
        yield tally.assign(_setups=int(new), _tasks=1, _batches=seen)

    full = StructType([*(StructField(f.name, f.dataType, True) for f in out.fields), *(StructField(c, IntegerType()) for c in counts)])
    rows, seen = observed(df.mapInPandas(run, full), name or f"workers-{token}", **{c[1:]: F.sum(c) for c in counts})
    return rows.where(F.col("_tasks").isNull()).select(*out.names), seen


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach aggregate metrics (e.g. ``rows=F.count(F.lit(1))``) to a step."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs
