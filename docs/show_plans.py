"""Print condensed physical plans of the main operators (operator names and
keys only) for docs/plans.md: python docs/show_plans.py [sf_dir]."""

import re
import sys

sys.path.insert(0, __file__.rsplit("/docs/", 1)[0])

from strata.catalog import Tables  # noqa: E402
from strata.session import build_session  # noqa: E402

KEEP = re.compile(
    r"(Exchange \w+\([^)]*\)|Exchange SinglePartition|BroadcastExchange|BroadcastHashJoin \[[^\]]*\]|"
    r"SortMergeJoin \[[^\]]*\]|(?:Sort|Hash|ObjectHash)Aggregate\(keys?=\[[^\]]*\], functions=\[[^\]]{0,60}|"
    r"Window \[[^\]]{0,50}|WindowGroupLimit|FileScan parquet \[[^\]]*\]|InMemoryTableScan|Scan ExistingRDD)"
)


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    top = plan.split("InMemoryRelation")[0]  # the cached subplans are shown once elsewhere
    out = []
    for line in top.splitlines():
        m = KEEP.search(line)
        if m:
            indent = len(line) - len(line.lstrip(" :+-"))
            out.append(" " * indent + re.sub(r"#\d+L?", "", m.group(0)))
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    # each plan is printed before the next one is built: building a model
    # persists the clean tables it shares, which would hide their plans
    builds = [
        ("clean_order_items (dedupe, before any cache)", lambda t: t.clean("order_items")),
        ("dim_seller (clean tables cached)", lambda t: t.model["dim_seller"]),
        ("fact_orders (clean tables cached)", lambda t: t.model["fact_orders"]),
        ("fact_order_items (clean tables cached)", lambda t: t.model["fact_order_items"]),
    ]
    for title, build in builds:
        spark.catalog.clearCache()
        df = build(Tables(spark, sf))
        print(f"### {title}\n\n```\n{condensed(df)}\n```\n")


if __name__ == "__main__":
    main()
