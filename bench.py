"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blocklog import fixtures as fx  # noqa: E402
from blocklog.catalog import QUERIES  # noqa: E402
from blocklog.session import local_session  # noqa: E402

HEADLINE = (
    "decode_nested", "message_id_check", "link_check", "audit_duplicate", "validation_report",
    "absent_ranges", "write_gate", "record_gate", "strict_sequence", "tolerance_reach",
    "compare_by_height", "compare_findings", "resume_seq", "backfill", "write_backup_chunks",
    "size_distribution", "throughput", "sync_counters", "bridge_batch", "restore_batch",
    "backup_batch",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="blocklog-bench")
    logs = (fx.block_log, fx.compare_log, fx.backup_log, fx.full_log)
    started = time.perf_counter()
    counts = {f.__name__: f(spark, sf_dir).count() for f in logs}
    fixtures = time.perf_counter() - started
    # One run of the whole path warms the JVM up.
    QUERIES["sync_counters"](spark, sf_dir).collect()

    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)

    messages = counts["block_log"]
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "fixture_seconds": round(fixtures, 3),
                "rows": counts,
                "messages_per_second": {
                    "bridge": round(messages / seconds["bridge_batch"]),
                    "backup": round(counts["full_log"] / seconds["backup_batch"]),
                    "compare_per_side": round(messages / seconds["compare_findings"]),
                    "restore": round(messages / seconds["restore_batch"]),
                    "validate": round(messages / seconds["validation_report"]),
                },
            }
        )
    )
    sys.stdout.flush()


if __name__ == "__main__":
    main()
