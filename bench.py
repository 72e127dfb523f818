"""Time the query catalogue at one scale factor; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is built and run to completion into the ``noop`` sink (every
row is produced, nothing is collected to the driver): one warm-up run,
then ``BENCH_RUNS`` timed runs; the median counts.  Building a query
includes any eager step it has (a word-count table that is written once).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairflow.catalog import QUERIES  # noqa: E402
from pairflow.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}
    # Session warm-up (JIT, Python workers) so the first timed query is not penalised.
    for name in ("count_by_value_words", "reduce_opaque", "group_by_key"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        q = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "catalogue_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
