"""Print the physical plan of catalogue queries, or write them all to PLANS.md.

    python tools/plans.py [sf_dir] [name ...]        # formatted plans to stdout
    python tools/plans.py --markdown [sf_dir]        # PLANS.md: every query
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pairflow.catalog import QUERIES  # noqa: E402
from pairflow.plans import exchanges, plan_text  # noqa: E402
from pairflow.session import local_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    markdown = "--markdown" in args
    args = [a for a in args if a != "--markdown"]
    sf = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(QUERIES)
    spark = local_session(8)
    if not markdown:
        for name in names:
            print(f"==== {name}")
            print(plan_text(QUERIES[name](spark, sf), "formatted"))
        return
    out = [
        "# Physical plans",
        "",
        f"Generated by `python tools/plans.py --markdown {sf}` on `local[8]` (before execution, so",
        "AQE's runtime changes such as broadcast conversion, partition coalescing and skew splits",
        "are not shown). `Exchange` lines are shuffles; a `BroadcastExchange` ships a small side.",
        "",
    ]
    for name in names:
        df = QUERIES[name](spark, sf)
        n_ex = len(exchanges(df))
        out += [f"## {name}", "", f"shuffle exchanges: {n_ex}", "", "```", plan_text(df).strip(), "```", ""]
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
