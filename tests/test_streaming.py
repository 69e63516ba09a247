import pytest
from pyspark.sql import functions as F

from blocklog import catalog as C
from blocklog import fixtures as fx
from blocklog.functions import decode as D
from blocklog.operators import compare
from blocklog.operators.gate import write_gate
from blocklog.plans.verified import OutOfOrder, VerifiedOutput, bridge_rules
from blocklog.sources import log
from blocklog.streaming import jobs
from blocklog.streaming.compare import IncrementalCompare


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def small(df):
    return df.where(F.col("stream_id") < 4)


def test_bridge_stream_equals_gate_for_any_number_of_files(spark, sf_dir, tmp_path):
    messages = small(C._messages(spark, sf_dir))
    want = rows_of(write_gate(D.decode_nested(messages)).where("label = 'ACCEPTED'"), "stream_id", "out_seq", "height", "hash")
    for files in (3,):
        path = fx.message_files(spark, messages, f"files{files}", files)
        output = VerifiedOutput(spark, str(tmp_path / f"out{files}"))
        rules = bridge_rules(tolerance=10**6)
        stream = jobs.observed(log.read_log_stream(spark, path, messages.schema, max_files_per_trigger=1))
        checkpoint = str(tmp_path / f"offsets{files}")
        jobs.bridge_stream(stream, output, rules, checkpoint).awaitTermination()
        assert rows_of(output.rows(), "stream_id", "out_seq", "height", "hash") == want
        assert len(output.batches()) == files
        # Started again from the same offsets there is nothing to do; from a new checkpoint all rows
        # are behind the last one read.
        jobs.bridge_stream(stream, output, rules, checkpoint).awaitTermination()
        assert len(output.batches()) == files
    again = bridge_rules(tolerance=10**6, on_disorder="skip")
    jobs.bridge_stream(stream, output, again, str(tmp_path / "other")).awaitTermination()
    assert rows_of(output.rows(), "stream_id", "out_seq", "height", "hash") == want


@pytest.mark.parametrize("files", [4])
def test_compare_incremental_equals_batch(spark, sf_dir, tmp_path, files):
    a = small(C._messages(spark, sf_dir)).select("stream_id", "seq", "payload")
    b = small(fx.compare_log(spark, sf_dir)).select("stream_id", "seq", "payload")
    both = a.withColumn("side", F.lit("A")).unionByName(b.withColumn("side", F.lit("B")))
    job = IncrementalCompare(spark, str(tmp_path / "cmp"), "nested", both.schema["stream_id"].dataType)
    stream = log.read_log_stream(
        spark, fx.message_files(spark, both, "both", files), both.schema, max_files_per_trigger=1)
    jobs.start(stream, job, str(tmp_path / "offsets")).awaitTermination()
    sides = [compare.prepare_side(D.decode_nested(x)) for x in (a, b)]
    want = rows_of(compare.compare_by_height(*sides), "stream_id", "seq_a", "seq_b")
    found = job.findings()
    assert rows_of(found.where("kind = 'DISCREPANCY'"), "stream_id", "prev_seq", "seq") == want
    kinds = [
        rows_of(x.withColumn("step", F.lit(1)).transform(lambda d: compare._side_findings(d, n, "nested")),
                "stream_id", "side", "kind", "prev_seq", "seq")
        for n, x in zip("AB", sides)
    ]
    got = [t for t in found.where("kind <> 'DISCREPANCY'").select("stream_id", "side", "kind", "prev_seq", "seq").collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, kinds[0] + kinds[1]))


def test_listener_sees_the_counters(spark, sf_dir, tmp_path):
    messages = fx.backup_log(spark, sf_dir).select("stream_id", "seq")
    path = fx.message_files(spark, messages, "watched", 2)
    listener = jobs.watch(spark)
    stream = jobs.observed(log.read_log_stream(spark, path, messages.schema, max_files_per_trigger=1))
    jobs.start(stream, lambda df, n: df.write.format("noop").mode("overwrite").save(), str(tmp_path / "o")).awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    seen = [p for p in listener.progress if p["name"] == "reader"]
    assert sum(p["reads"] for p in seen) == messages.count()
    assert max(p["reader_seq"] for p in seen if p["reader_seq"]) == messages.agg(F.max("seq")).first()[0]


def test_compare_incremental_guards_the_order(spark, tmp_path):
    def batch(*seqs):
        rows = [(1, q, f'{{"block":{{"header":{{"hash":"h{q}","prev_hash":"h{q - 1}","height":{q}}}}}}}', side) for q in seqs for side in "AB"]
        return spark.createDataFrame(rows, "stream_id bigint, seq bigint, payload string, side string")

    job = IncrementalCompare(spark, str(tmp_path / "fail"), "nested", batch(1).schema["stream_id"].dataType)
    job(batch(3, 4), 0)
    with pytest.raises(OutOfOrder):
        job(batch(1, 2), 1)
    job = IncrementalCompare(spark, str(tmp_path / "skip"), "nested", batch(1).schema["stream_id"].dataType, on_disorder="skip")
    for n, seqs in enumerate([(3, 4), (1, 2, 5)]):
        job(batch(*seqs), n)
    assert job.findings().count() == 0


def test_metrics_hold_the_latest_batches_and_count_a_repeated_one_once():
    metrics = jobs.SyncMetrics(kept=2)
    for batch in (0, 1, 1, 2):
        seen = dict.fromkeys(jobs.SyncMetrics.COUNTERS, batch + 1) | {"reader_seq": 10 - batch, "last_written_input_seq": None, "last_written_height": batch or None}
        metrics(batch, seen)
    metrics(3, {})  # a batch without rows
    assert metrics.totals == dict.fromkeys(jobs.SyncMetrics.COUNTERS, 6)
    assert metrics.positions == {"reader_seq": 10, "last_written_input_seq": None, "last_written_height": 2}
    assert [b["batch"] for b in metrics.batches] == [2, 3]
