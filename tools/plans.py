"""Summarise the final (adaptive) physical plan of every batch query.

    python tools/plans.py [sf_dir] > PLANS.md

Each query is run once (so AQE has re-planned with runtime sizes) and the
final plan is reduced to what matters at scale: shuffles, broadcasts (sized
at runtime), join strategies, window and Python stages, and what reached the
Parquet scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.plans.queries import QUERIES, registered  # noqa: E402
from mercato.session import build_session  # noqa: E402

KEEP = ("Exchange", "BroadcastExchange", "ReusedExchange", "SortMergeJoin",
        "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
        "Window", "Generate", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
        "FlatMapGroupsInPandas", "MapInPandas", "BatchEvalPython", "ArrowEvalPython")


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0] + \
            text.split("== Initial Plan ==", 1)[1].split("\n\n", 1)[1]
    return text


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    queries = registered()
    print("# Physical plans (final, after AQE) at", os.path.basename(sf))
    print()
    print("Counts of plan nodes per batch query; generated by `tools/plans.py`.")
    print("`Exchange` = shuffle; `BroadcastExchange` = a side AQE measured small;")
    print("`Cartesian`/`NestedLoop` joins and row-at-a-time Python (`BatchEvalPython`) must")
    print("stay absent. Scans list the filters pushed into Parquet and the columns read.")
    print()
    for name in QUERIES:
        df = queries[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        text = final_plan(df)
        tree = text.split("\n\n", 1)[0]
        ops = Counter(re.findall(r"[+:-]- \*?\s*\(?\d*\)?\s*(\w+)", tree))
        ops.update(re.findall(r"^\s*(\w+) \(\d+\)", tree, re.M))
        counts = {k: v for k, v in sorted(ops.items()) if k in KEEP}
        pushed = sorted(set(re.findall(r"PushedFilters: (\[.*?\])", text)))
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<.*?>)\n", text)))
        print(f"## {name}")
        print()
        print("- nodes: " + (", ".join(f"{k} {v}" for k, v in counts.items()) or "none"))
        for p in pushed:
            if p != "[]":
                print(f"- pushed: `{p}`")
        for sch in schemas:
            print(f"- read: `{sch}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
