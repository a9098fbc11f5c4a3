"""Plan inspection: exchange census and formatted plans of registered queries.

    python -m winback.plans.inspect [sf_dir] [query ...]

Prints, per query, the shuffle / broadcast / scan census of the physical plan
as it would run at scale (AQE and static broadcasts switched off, so every
join shows its shuffle), then the number of distinct shuffle keys. Used to
review that filters reach the scans, joins on the same key share a
partitioning, and repeated reads reuse one exchange.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().treeString()


def census(df: DataFrame) -> dict:
    """Counts of plan nodes that matter for scale."""
    t = physical_plan(df)
    keys = Counter(re.sub(r"#\d+L?", "", m)
                   for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", t))
    return {
        "shuffles": t.count("Exchange hashpartitioning") + t.count("Exchange rangepartitioning"),
        "reused_exchanges": t.count("ReusedExchange"),
        "broadcasts": t.count("BroadcastExchange"),
        "file_scans": t.count("FileScan"),
        "checkpoint_scans": t.count("Scan ExistingRDD"),
        "sort_merge_joins": t.count("SortMergeJoin"),
        "broadcast_joins": t.count("BroadcastHashJoin"),
        "nested_loop_or_cartesian": t.count("BroadcastNestedLoopJoin") + t.count("CartesianProduct"),
        "windows": len(re.findall(r"\bWindow \[", t)),
        "window_group_limits": t.count("WindowGroupLimit"),
        "python_udfs": t.count("BatchEvalPython") + t.count("ArrowEvalPython"),
        "pushed_filters": t.count("PushedFilters: [I") + t.count("PushedFilters: [G")
        + t.count("PushedFilters: [L") + t.count("PushedFilters: [N"),
        "shuffle_keys": dict(keys),
    }


def main(argv: list[str]) -> None:
    from winback.plans.queries import REGISTRY
    from winback.session import local_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or ["reactivation", "channel_attribution", "customer_attributes",
                         "top_values", "profile", "split_counts"]
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for n in names:
        c = census(REGISTRY[n](spark, sf_dir))
        keys = c.pop("shuffle_keys")
        print(f"{n}: {c}")
        for k, v in sorted(keys.items(), key=lambda kv: -kv[1]):
            print(f"    {v} x hash({k})")


if __name__ == "__main__":
    main(sys.argv[1:])
