"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query is run end to end (its inputs are derived from the Parquet tables inside the timing) and executed with
the no-op sink, so the whole plan runs without collecting to the driver. Before timing, every headline query runs
once on the smallest scale factor (excluded) so that one-time JVM class loading and code generation — identical
for every scale — is not counted as query work. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["publish_full", "snapshot_diff", "asof_scan", "milestones", "parse_tuples", "rows_to_cells",
            "publish_incremental", "rebuild_history", "published_asof", "scan_dump_lines", "tombstone_masked_asof",
            "dump_fingerprint"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    from tidemark.session import get_session
    spark = get_session("bench", cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS",
                                                                                 str(max(8, int(cpus) * 2)))))
    from tidemark import queries as QM
    # JVM warm-up (class loading, codegen caches) outside the timings
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for k in keys:
            QM._MEMO.clear()
            QM.Q[k](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        QM._MEMO.clear()  # every query builds its own inputs inside its timing
        t0 = time.time()
        QM.Q[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t0, 3)
        print(f"# {k}: {times[k]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
