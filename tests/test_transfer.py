import json

import pytest
from pyspark.sql import functions as F

from blocklog.functions.decode import CorruptRowsError
from blocklog.plans import checks, transfer
from blocklog.plans.verified import (
    CopyRules, OutOfOrder, TipMoved, ToleranceExceeded, VerifiedOutput, bridge_rules, copy_batch,
    restore_rules,
)
from blocklog.sources import backup as B
from blocklog.sources import sinks
from blocklog.sources.chunk_index import ChunkIndex

BAD = "{"


def block(height, hash_, prev):
    return json.dumps({"block": {"header": {"hash": hash_, "prev_hash": prev, "height": height}}})


CHAIN = [block(h, f"h{h}", f"h{h - 1}") for h in range(1, 9)]


def messages(spark, payloads, first=1):
    return spark.createDataFrame(
        [(1, first + i, {"Nats-Msg-Id": ["0"], "Extra": ["e"]}, p) for i, p in enumerate(payloads)],
        "stream_id bigint, seq bigint, headers map<string,array<string>>, payload string")


def written(output):
    return [(r.out_seq, r.height) for r in output.rows().orderBy("out_seq").collect()]


def test_bridge_copies_resumes_and_sets_headers(spark, tmp_path):
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=5, stream_prefix="s")
    transfer.bridge(messages(spark, [CHAIN[0], BAD, CHAIN[1], CHAIN[0], CHAIN[4], CHAIN[2]]), output, rules)
    assert written(output) == [(1, 1), (2, 2), (3, 3)]
    counters = output.metrics().first()
    assert (counters.reads, counters.writes, counters.corrupted_skips, counters.low_height_skips, counters.hash_mismatch_skips) == (6, 3, 1, 1, 1)
    state = transfer.bridge(messages(spark, CHAIN), output, rules)
    assert written(output) == [(i, i) for i in range(1, 9)]
    tip = state.first()
    assert (tip.out_seq, tip.height, tip.hash, tip.stopped) == (8, 8, "h8", False)
    headers = output.rows().where("out_seq = 4").first().headers
    assert headers == {"Nats-Msg-Id": ["4"], "Nats-Expected-Last-Msg-Id": ["3"],
                       "Nats-Expected-Last-Sequence": ["3"], "Nats-Expected-Stream": ["s1"]}


def test_original_headers_on_request_and_disabled_checks(spark, tmp_path):
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=5, keep_headers=True, disable_check_seq=2, disable_check_height=3)
    transfer.bridge(messages(spark, CHAIN[:4]), output, rules)
    rows = {r.out_seq: r.headers for r in output.rows().collect()}
    assert all(h["Extra"] == ["e"] and h["Nats-Msg-Id"] == [str(n)] for n, h in rows.items())
    assert [n for n, h in sorted(rows.items()) if "Nats-Expected-Last-Sequence" in h] == [4]


def test_repeated_batch_changes_nothing_and_foreign_batch_is_refused(spark, tmp_path):
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=3)
    copy_batch(messages(spark, CHAIN[:3]), output, 0, rules)
    copy_batch(messages(spark, CHAIN[3:6], 4), output, 1, rules)
    before = written(output)
    copy_batch(messages(spark, CHAIN[3:6], 4), output, 1, rules)
    assert written(output) == before == [(i, i) for i in range(1, 7)]
    with pytest.raises(TipMoved):
        copy_batch(messages(spark, CHAIN[:3]), output, 0, rules)
    with pytest.raises(OutOfOrder):
        copy_batch(messages(spark, CHAIN[:3]), output, 2, rules)
    copy_batch(messages(spark, CHAIN[5:8], 6), output, 2, CopyRules(tolerance=3, on_disorder="skip"))
    assert written(output) == [(i, i) for i in range(1, 9)]


@pytest.mark.parametrize("cut", [None, 4])
def test_tolerance_run_goes_on_across_batches(spark, tmp_path, cut):
    payloads = [CHAIN[0], CHAIN[1], BAD, CHAIN[6], BAD, CHAIN[2]]
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=3, on_tolerance="stop")
    copy_batch(messages(spark, payloads[:cut]), output, 0, rules)
    if cut:
        copy_batch(messages(spark, payloads[cut:], cut + 1), output, 1, rules)
    assert written(output) == [(1, 1), (2, 2)]
    assert output.state().first().stopped
    with pytest.raises(ToleranceExceeded):
        # The corrupt row before the first higher one is not read again.
        transfer.bridge(messages(spark, payloads), output, bridge_rules(tolerance=2))
    transfer.bridge(messages(spark, payloads), output, bridge_rules(tolerance=3))
    assert written(output)[-1] == (3, 3)


def test_unverified_copy_and_own_sink(spark, tmp_path):
    rows = messages(spark, ["x", "y", "z"]).withColumn(
        "headers", F.create_map(F.lit("Nats-Msg-Id"), F.array((F.lit(10) - F.abs(F.col("seq") - 2)).cast("string"))))
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    transfer.bridge(rows, output, bridge_rules(mode="unverified"), sink=sinks.plain_sink(str(tmp_path / "own")))
    got = spark.read.parquet(str(tmp_path / "own")).orderBy("out_seq").collect()
    assert [(r.out_seq, r.height, r.payload) for r in got] == [(1, 9, "x"), (2, 10, "y")]


def test_rules_are_checked():
    for bad in ({"start": 5, "end": 5}, {"end": 1}, {"rule": "x"}, {"on_corrupt": "x"}, {"mode": "simple"}):
        with pytest.raises(ValueError):
            bridge_rules(**bad)


def test_restore_goes_on_from_the_tip(spark, tmp_path):
    rows = messages(spark, CHAIN).withColumn("chunk_id", F.expr("(seq - 1) div 3 * 3 + 1"))
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    transfer.restore(rows, output, restore_rules(start=1, end=6, tolerance=1))
    assert written(output) == [(i, i) for i in range(1, 6)]
    transfer.restore(rows, output, restore_rules(start=1, end=99, tolerance=1))
    assert written(output) == [(i, i) for i in range(1, 9)]
    with pytest.raises(CorruptRowsError):
        transfer.restore(messages(spark, [BAD], 50).withColumn("chunk_id", F.col("seq")), output, restore_rules(start=1, end=99))


def test_backup_fills_holes_and_stops_at_broken_rows(spark, tmp_path):
    path = str(tmp_path / "backup")
    rows = messages(spark, CHAIN)
    transfer.backup(rows.where("seq in (1, 2, 5)").where("seq < 3"), path, 1, 9, mode="nested")
    transfer.backup(rows, path, 1, 6, mode="nested")
    stored = B.read_backup(spark, path, schema=rows.schema)
    assert sorted(r.seq for r in stored.collect()) == [1, 2, 3, 4, 5]
    broken = messages(spark, CHAIN[:6] + [block(7, "h7", "zz"), CHAIN[7]])
    with pytest.raises(transfer.BrokenLink):
        transfer.backup(broken, path, 1, 9, mode="nested")
    assert sorted(r.seq for r in B.read_backup(spark, path, schema=rows.schema).collect()) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(CorruptRowsError):
        transfer.backup(messages(spark, CHAIN[:6] + [BAD]), path, 1, 9, mode="nested")
    with pytest.raises(transfer.BrokenLink, match="PREV_MISSING"):
        transfer.backup(rows.where("seq = 8"), path, 1, 9, mode="nested")
    with pytest.raises(ValueError):
        transfer.backup(rows, path, 1, 0)


def test_validation_and_comparison_jobs(spark):
    good = messages(spark, CHAIN).withColumn(
        "headers", F.create_map(F.lit("Nats-Msg-Id"), F.array(F.col("seq").cast("string"))))
    report, first = checks.validate_backup(good)
    assert report.count() == 0 and first.count() == 0
    report, first = checks.validate_backup(good.where("seq <> 4"))
    assert sorted((r.kind, r.n, r.first_seq) for r in report.collect()) == [("HASH", 1, 5), ("SEQ_GAP", 1, 5)]
    assert first.first().kind == "SEQ_GAP"
    other = good.withColumn("payload", F.when(F.col("seq") == 3, F.concat("payload", F.lit(" "))).otherwise(F.col("payload")))
    found = checks.compare_logs(good, other, "nested").collect()
    assert [(r.kind, r.prev_seq, r.seq) for r in found] == [("DISCREPANCY", 3, 3)]
    assert [(r.kind, r.seq) for r in checks.compare_logs(good, other, "simple").collect()] == [("DISCREPANCY", 3)]


def test_existing_output_is_adopted_unless_its_tip_is_corrupt(spark, tmp_path):
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    output.adopt(messages(spark, CHAIN[:3]), "nested")
    transfer.bridge(messages(spark, CHAIN), output, bridge_rules(tolerance=3))
    assert written(output) == [(i, i) for i in range(4, 9)]
    with pytest.raises(Exception, match="corrupt tip"):
        VerifiedOutput(spark, str(tmp_path / "other")).adopt(messages(spark, [CHAIN[0], BAD]), "nested")


@pytest.mark.parametrize("cut", range(1, 9))
def test_a_restarted_copy_loses_no_row_behind_a_replay(spark, tmp_path, cut):
    heights = [1, 2, 3, 4, 5, 3, 6, 7]
    rows = messages(spark, [block(h, f"h{h}", f"h{h - 1}") for h in heights])
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=9)
    transfer.bridge(rows.where(F.col("seq") <= cut), output, rules)
    transfer.bridge(rows, output, rules)
    assert written(output) == [(i, i) for i in range(1, 8)]


def test_a_restarted_restore_finds_rows_in_a_chunk_that_begins_with_a_replay(spark, tmp_path):
    rows = messages(spark, [block(h, f"h{h}", f"h{h - 1}") for h in [1, 2, 3, 4, 5, 3, 6, 7]])
    rows = rows.withColumn("chunk_id", F.expr("case when seq <= 5 then 1L else 6L end"))
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    for end in (4, 99):
        transfer.restore(rows, output, restore_rules(start=1, end=end, tolerance=9))
    assert written(output) == [(i, i) for i in range(1, 8)]


def test_a_batch_that_was_cut_off_does_not_count(spark, tmp_path):
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=3)
    transfer.bridge(messages(spark, CHAIN[:3]), output, rules)
    output.commits.attempt(1).write("rows", output.rows().drop("batch_id"))
    assert output.batches() == [0] and written(output) == [(1, 1), (2, 2), (3, 3)]
    transfer.bridge(messages(spark, CHAIN), output, rules)
    assert written(output) == [(i, i) for i in range(1, 9)]


def test_a_backup_is_read_from_within_a_chunk(spark, tmp_path):
    path, rows = str(tmp_path / "backup"), messages(spark, CHAIN)
    B.write_backup(rows.where("seq <> 5"), path, max_entries=4, split_at_holes=False)
    B.write_backup(rows.where("seq = 5"), path)
    got = B.read_backup(spark, path, schema=rows.schema, from_chunk=6)
    assert {r.seq for r in got.collect()} >= {6, 7, 8} and got.where("seq < 5").count() == 0
    assert {r.seq for r in B.read_backup(spark, path, schema=rows.schema, from_chunk=3).collect()} == set(range(1, 9))


@pytest.mark.parametrize("base", [0, 2**63 - 3])
def test_a_restarted_copy_takes_no_row_from_before_its_tip(spark, tmp_path, base):
    # Blocks 3 and 4 came before the replay of 2 that became the tip; in one go nothing links to it any more.
    rows = messages(spark, [block(base + h, f"h{h}", f"h{h - 1}") for h in [1, 3, 4, 2, 5, 6]])
    output = VerifiedOutput(spark, str(tmp_path / "out"))
    rules = bridge_rules(tolerance=9)
    transfer.bridge(rows.where(F.col("seq") <= 4), output, rules)
    transfer.bridge(rows, output, rules)
    assert written(output) == [(1, base + 1), (2, base + 2)]


def test_a_restarted_restore_takes_no_row_from_before_its_tip(spark, tmp_path):
    rows = messages(spark, [block(h, f"h{h}", f"h{h - 1}") for h in [1, 3, 4, 2, 5, 6]])
    B.write_backup(rows, path := str(tmp_path / "backup"), max_entries=6)
    stored = B.read_backup(spark, path, schema=rows.schema)
    for name, source in ("plain", stored), ("indexed", ChunkIndex(spark, path, rows.schema, "nested")):
        output = VerifiedOutput(spark, str(tmp_path / name))
        for end in (5, 99):
            transfer.restore(source, output, restore_rules(start=1, end=end, tolerance=9))
        assert written(output) == [(1, 1), (2, 2)]


def test_a_chunk_is_one_file(spark, tmp_path):
    rows = spark.range(1, 2001).select(
        F.lit("a b+c/d").alias("stream_id"), F.col("id").alias("seq"), F.repeat(F.lit("x"), F.lit(9)).alias("payload"))
    B.write_backup(rows, path := str(tmp_path / "backup"), max_entries=500, width=64)
    files = spark.read.schema(rows.schema).parquet(path).select("stream_id", F.input_file_name().alias("file"))
    assert files.distinct().count() == 4
    index = ChunkIndex(spark, path, rows.schema)
    assert sorted(map(tuple, index.missing().collect())) == [("a b+c/d", 1 + 500 * i) for i in range(4)]
    assert index.refresh() == 4 and index.missing().count() == 0


def test_restore_opens_small_chunks_once(spark, tmp_path, monkeypatch):
    path, rows, seen, copy = str(tmp_path / "backup"), messages(spark, CHAIN), [], transfer.copy_batch
    B.write_backup(rows, path, max_entries=2)

    def watched(read, *args, **options):
        seen.extend(read.inputFiles())  # what the passes over the rows open
        return copy(read, *args, **options)

    monkeypatch.setattr(transfer, "copy_batch", watched)
    plain = B.read_backup(spark, path, schema=rows.schema)
    for name, source in ("plain", plain), ("indexed", ChunkIndex(spark, path, rows.schema, "nested")):
        output = VerifiedOutput(spark, str(tmp_path / name))
        for end in (5, 99):
            transfer.restore(source, output, restore_rules(start=1, end=end, tolerance=9))
        assert written(output) == [(i, i) for i in range(1, 9)]
    assert seen and not [f for f in seen if "chunk_id=" in f]


def test_backup_is_listed_by_few_tasks(spark, tmp_path):
    name, path, rows = "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tmp_path / "backup"), messages(spark, CHAIN * 10)
    rows.withColumn("stream_id", F.col("seq")).withColumn("chunk_id", F.col("seq")).coalesce(1).write.partitionBy("stream_id", "chunk_id").parquet(path)
    index, before = ChunkIndex(spark, path, rows.schema), spark.conf.get(name, None)
    context = spark.sparkContext
    for k, read in enumerate((lambda: B.read_backup(spark, path, schema=rows.schema), index.rows, index.folders)):
        context.setJobGroup(f"listing-{k}", "")
        read()
        tracker = context.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"listing-{k}") for s in tracker.getJobInfo(j).stageIds]
        assert stages and max(s.numTasks for s in stages) <= 4 * context.defaultParallelism < 80  # a task for each log
    context.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(name, None) == before
