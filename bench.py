"""Benchmark: headline queries on the scripted history at ``$BENCH_SF_DIR``.

Prints one JSON line. Each query is run to completion through the ``noop``
sink (all rows produced, nothing collected); the time is the best of
``$BENCH_REPEAT`` runs after one warm-up. ``write_history`` is the time to
write the six-version history from scratch (every DML statement and commit, and the base at version 4);
it counts in the total, and each statement is also given on its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verlog.plans import catalog  # noqa: E402
from verlog.plans.history import BASE_EVERY, _steps, orders_history  # noqa: E402
from verlog.session import local_session  # noqa: E402
from verlog.sources.testdata import orders_rows, table  # noqa: E402
from verlog.sources.versioned import BASE_INTERVAL, VersionedTable  # noqa: E402

HEADLINE = [
    "write_history", "as_of_version", "as_of_latest", "diff_versions", "diff_except", "change_feed", "change_pairs",
    "report_by_version", "audit_log", "restore_version", "surgical_repair", "recover_from_clone",
    "dml_merge_matched_only", "region_totals", "region_revenue", "assign_ids", "current_grants",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    fn()  # warm-up
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="verlog-bench")
    spark.sparkContext.setLogLevel("ERROR")

    results: dict[str, float] = {}
    # Writing the history: every statement and commit, into a fresh table.
    src = orders_rows(spark, sf_dir)
    for measured in (False, True):  # a warm-up first
        fresh = VersionedTable.create(spark, catalog.scratch(spark, "bench-history"), src.schema, ["order_id"],
                                      {BASE_INTERVAL: str(BASE_EVERY)})
        for name, step in zip(("load", "update", "delete", "merge", "update_incident", "insert"), _steps(src)):
            t0 = time.perf_counter()
            step(fresh)
            if measured:
                results[f"write_{name}"] = round(time.perf_counter() - t0, 3)
    results["write_history"] = round(sum(results.values()), 3)
    orders_history(spark, sf_dir)  # the shared fixture the queries read

    # Baseline: a plain scan + aggregate of the change log and of lineitem.
    log_path = orders_history(spark, sf_dir).changes_path
    results["plain_log_scan"] = round(timed(lambda: run(spark.read.parquet(log_path).groupBy("priority").count()),
                                            repeat), 3)
    results["plain_lineitem_scan"] = round(timed(
        lambda: run(table(spark, sf_dir, "lineitem").groupBy("l_returnflag").count()), repeat), 3)

    for name in HEADLINE[1:]:
        fn = catalog.QUERIES[name]
        results[name] = round(timed(lambda: run(fn(spark, sf_dir)), repeat), 3)

    total = round(sum(v for k, v in results.items() if k in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": results,
                      "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
