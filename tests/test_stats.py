import pytest
from pyspark.sql import functions as F

from blocklog.operators import stats
from blocklog.plans.checks import SequenceGap, SizeState


def test_histograms(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 2.5, 99.0)], "v double")
    rows = stats.hist_linear(df, F.col("v"), 0, 4, 2).orderBy("bound_no").collect()
    assert [(r.bound, r.n) for r in rows] == [(0.0, 1), (2.0, 3), (None, 5)]
    assert stats.exponential_bounds(1, 8, 4) == [1, 2, 4, 8]
    rows = stats.hist_exponential(df, F.col("v"), 1, 4, 3).orderBy("bound_no").collect()
    assert [r.n for r in rows] == [2, 3, 4, 5]


def test_size_state_resumes(spark, tmp_path):
    rows = spark.range(1, 11).select(
        F.lit(1).cast("bigint").alias("stream_id"), F.col("id").alias("seq"),
        F.lit("p").alias("a"), F.repeat(F.lit("x"), (F.col("id") * 300).cast("int")).alias("b"))
    state = SizeState(spark, str(tmp_path / "state"))
    args = (F.col("a"), F.col("b"))
    state.update(rows, *args, end=5, resolution_kb=1)
    state.update(rows, *args, end=5, resolution_kb=1)
    got = state.update(rows, *args, resolution_kb=1)
    want = stats.size_distribution(rows, *args, 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert state.progress().first().last_processed_seq == 10
    later = rows.withColumn("seq", F.col("seq") + 11)
    with pytest.raises(SequenceGap):
        state.update(later, *args)
    assert state.progress().first().last_processed_seq == 10
    state.update(later, *args, ignore_gaps=True)
    assert state.progress().first().last_processed_seq == 21


def test_status_lines(spark):
    rows = [(1, 3, 7, "ACCEPTED", 21, 20, 6, 0), (1, 4, None, "CORRUPT", None, 21, 7, 1), (1, 5, 2, "LOW_HEIGHT", None, 21, 7, 0),
            (2, 9, 4, "HASH_MISMATCH", None, 5, 1, 1)]
    df = spark.createDataFrame(rows, "stream_id int, seq bigint, height bigint, label string, out_seq bigint, tip_out_seq bigint, tip_height bigint, run bigint")
    gauges = stats.sync_gauges(df, start=2, tolerance=9)
    one = gauges.where("stream_id = 1").first()
    assert (one.reader_seq, one.reader_height, one.writer_tip_height, one.last_written_height, one.consecutive_wrong) == (5, 2, 7, 7, 0)
    assert (one.input_start_seq, one.tolerance_window) == (2, 9)
    lines = {(r.stream_id, r.line): tuple(r)[2:] for r in stats.sync_status(gauges).collect()}
    assert lines[(1, "WRITER")] == (3, 21, 7, 7) and lines[(1, "LAST")] == (5, 21, None, 7)
    assert lines[(2, "WRITER")] == (0, 0, 0, 0) and lines[(2, "LAST")] == (9, 0, None, 1)
    counters = stats.sync_counters(df).where("stream_id = 1").first()
    assert tuple(counters)[1:] == (3, 1, 0, 1, 1, 0)
    bounds = spark.createDataFrame([(1, 1, 50)], "stream_id int, first_seq bigint, last_seq bigint")
    assert stats.sync_gauges(df, input_bounds=bounds).where("stream_id = 1").first().input_last_seq == 50
