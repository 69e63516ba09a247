"""What the physical plans must not contain."""

import pytest

from blocklog import catalog as C
from blocklog import fixtures as fx
from blocklog.operators import audit, stats

CORE = [
    "decode_nested", "link_check", "audit_duplicate", "validation_report", "absent_ranges", "segments",
    "write_gate", "record_gate", "wrong_runs", "compare_by_height", "compare_findings", "resume_seq",
    "backfill", "write_backup_chunks", "sync_counters", "size_distribution", "throughput",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_single_partition_and_no_python(spark, sf_dir, name):
    plan = plan_of(C.QUERIES[name](spark, sf_dir))
    assert "SinglePartition" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_windows_over_rows_are_bucketed(spark, sf_dir):
    plan = plan_of(audit.seq_gaps(fx.backup_log(spark, sf_dir)))
    assert "hashpartitioning(stream_id" in plan and "__bucket1" in plan


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    plan = plan_of(stats.throughput(fx.backup_log(spark, sf_dir)))
    assert "partial_count" in plan
