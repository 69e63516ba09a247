"""Comparisons behind envelopes, halts and flags of the endless comparison, decode failures and dumps of the size job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklog.functions.decode import CorruptRowsError
from blocklog.plans import checks, transfer
from blocklog.streaming.compare import IncrementalCompare
from tests.test_transfer import CHAIN, block, messages


def _enveloped(df, sender: int):
    """Five items, then the payload: type, sequential id, seconds, milliseconds and an id that depends on the sender."""
    head = F.concat(F.lit("018518"), F.lpad(F.hex(F.lit(sender)), 2, "0"), F.lit("1B"), F.lpad(F.hex("seq"), 16, "0"), F.lit("010250"), F.md5(F.concat("seq", F.lit(sender))))
    return df.withColumn("payload", F.unhex(F.concat(head, F.hex("payload"))))


def _sides(spark, a, b):
    return _enveloped(messages(spark, a), 30), _enveloped(messages(spark, b), 40)


def test_copies_differ_in_their_envelopes_only(spark):
    a, b = _sides(spark, CHAIN, CHAIN)
    assert checks.compare_logs(a, b, "nested", envelope=True).count() == 0
    assert checks.compare_logs(a, b, "simple", envelope=True).count() == 0
    assert checks.compare_logs(a, b, "simple", skip_discrepancy=True).count() == len(CHAIN)
    changed = [*CHAIN[:3], CHAIN[3].replace("}}}", '}},"v":1}'), *CHAIN[4:]]
    a, b = _sides(spark, CHAIN, changed)
    cut = F.when(F.col("seq") == 6, F.substring("payload", 1, 4)).otherwise(F.col("payload"))
    found = checks.compare_logs(a, b.withColumn("payload", cut), "nested", envelope=True, skip_discrepancy=True, skip_corrupted=True, skip_gaps=True)
    got = {(r["side"], r["kind"], r["seq"]) for r in found.collect()}
    assert {("AB", "DISCREPANCY", 4), ("B", "CORRUPTED", 6)} <= got


def _both(spark, a, b):
    return a.withColumn("side", F.lit("A")).unionByName(b.withColumn("side", F.lit("B")))


def test_a_log_ends_with_its_first_finding_that_no_flag_excuses(spark, tmp_path):
    other = [CHAIN[0], block(2, "h2", "h1").replace("}}}", '}},"v":1}'), *CHAIN[2:5], block(6, "h6", "h5").replace("}}}", '}},"v":2}'), *CHAIN[6:]]
    both = _both(spark, *_sides(spark, CHAIN, other))
    halting, excusing = (
        IncrementalCompare(spark, str(tmp_path / name), "nested", T.LongType(), envelope=True, halt=True, skip_flags=flags)
        for name, flags in (("halts", {}), ("goes-on", {"skip_discrepancy": True}))
    )
    for batch, low in enumerate((1, 4, 7)):
        part = both.where(F.col("seq").between(low, low + 2))
        halting(part, batch)
        excusing(part, batch)
    assert [(r.seq, r.fatal) for r in halting.findings().collect()] == [(2, True)]
    assert [(r.stream_id, r.ended) for r in halting.halted().collect()] == [(1, 0)]
    assert sorted((r.seq, r.fatal) for r in excusing.findings().collect()) == [(2, False), (6, False)]
    assert excusing.halted().count() == 0
    before = excusing.findings().count()
    excusing(both.where("seq >= 7"), 2)  # repeated by the stream
    assert excusing.findings().count() == before


def test_size_job_fails_on_what_does_not_unpack_and_keeps_large_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, k, "p" * k, "u" * (100 * k) if k != 4 else None) for k in range(1, 6)], "stream_id bigint, seq bigint, packed string, unpacked string")
    state = checks.SizeState(spark, str(tmp_path / "sizes"))
    error = F.when(F.col("unpacked").isNull(), "cannot unpack")
    sizes = (F.col("packed"), F.col("unpacked"))
    with pytest.raises(CorruptRowsError, match="sequence 4"):
        state.update(rows, *sizes, error=error)
    assert state.version() == -1
    state.update(rows.where("seq < 4"), *sizes, error=error, dump_above=150)
    assert sorted((r.seq, len(r.data)) for r in state.dumps().collect()) == [(2, 200), (3, 300)]
    with pytest.raises(CorruptRowsError):
        state.update(rows, *sizes, error=error, dump_above=150)
    assert state.progress().first().last_processed_seq == 3


def test_backup_reports_what_is_still_absent(spark, tmp_path):
    rows, path = messages(spark, CHAIN), str(tmp_path / "backup")
    left = transfer.backup(rows.where("seq not in (3, 4, 8)"), path, 1, 11)
    assert sorted((r.l, r.r) for r in left.collect()) == [(3, 4), (8, 10)]
    left = transfer.backup(rows, path, 1, 9)
    assert left.count() == 0
