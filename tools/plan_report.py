"""Physical-plan facts of the headline queries (markdown table on stdout).

    python tools/plan_report.py [sf_dir]

For each query: exchanges (shuffles), broadcast exchanges, file scans, whether
partition filters / pushed filters reach the scan, whether the as-of window
gets its partial group limit, and the time to run it through the noop sink.
"""

from __future__ import annotations

import re
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bench import HEADLINE  # noqa: E402
from verlog.plans import catalog  # noqa: E402
from verlog.session import local_session  # noqa: E402


def facts(df) -> dict:
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan().toString()
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "scans": plan.count("FileScan"),
        "partition_filters": "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan,
        "pushed_filters": bool(re.search(r"PushedFilters: \[[^\]]", plan)),
        "partial_group_limit": "WindowGroupLimit" in plan and "Partial" in plan,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16, app="verlog-plans")
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | exchanges | broadcasts | scans | partition filters | pushed filters | partial group limit | sec |")
    print("|---|---|---|---|---|---|---|---|")
    for name in HEADLINE[1:]:  # all but writing the history
        df = catalog.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()  # warm-up; final adaptive plan
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        sec = time.perf_counter() - t0
        f = facts(df)
        print(f"| {name} | {f['exchanges']} | {f['broadcasts']} | {f['scans']} | {'yes' if f['partition_filters'] else '-'} "
              f"| {'yes' if f['pushed_filters'] else '-'} | {'yes' if f['partial_group_limit'] else '-'} | {sec:.2f} |")


if __name__ == "__main__":
    main()
