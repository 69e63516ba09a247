import random

from pyspark.sql import functions as F

from blocklog.operators import audit
from tests import folds


def log(spark, seqs, stream=1):
    return spark.createDataFrame([(stream, s) for s in seqs], "stream_id bigint, seq bigint")


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_seq_gaps(spark):
    df = log(spark, [3, 4, 6, 7, 10, 15])
    assert pairs(audit.seq_gaps(df, width=4), "prev_seq", "seq") == [(4, 6), (7, 10), (10, 15)]
    assert pairs(audit.seq_gaps(df, end=9), "prev_seq", "seq") == [(4, 6), (7, 10)]
    assert pairs(audit.seq_gaps(df, end=9, check_end=False), "prev_seq", "seq") == [(4, 6)]
    assert pairs(audit.seq_gaps(df, start=1, resumed_after=4), "prev_seq", "seq") == [(4, 6), (7, 10), (10, 15)]
    assert pairs(audit.seq_gaps(df, start=5, resumed_after=4), "prev_seq", "seq") == [(7, 10), (10, 15)]


def test_absent_ranges_equal_fold(spark):
    rng = random.Random(3)
    logs = {s: sorted(rng.sample(range(1, 40), rng.randint(0, 25))) for s in range(80)}
    df = spark.createDataFrame([(s, q) for s, l in logs.items() for q in l], "stream_id bigint, seq bigint")
    names = spark.range(80).select(F.col("id").alias("stream_id"))
    for start, end in ((1, 41), (5, 20), (39, 41)):
        got = pairs(audit.absent_ranges(df, start, end, streams=names, width=6), "stream_id", "l", "r")
        assert got == sorted((s, l, r) for s, q in logs.items() for l, r in folds.absent(q, start, end))


def test_segments(spark):
    assert pairs(audit.segments(log(spark, [1, 2, 3, 7, 9, 10]), width=2), "l", "r", "n") == [(1, 3, 3), (7, 7, 1), (9, 10, 2)]


def test_seam_check(spark):
    s = "stream_id bigint, seq bigint, hash string, prev_hash string, error string"
    stored = spark.createDataFrame([(1, 1, "a", "", None), (1, 4, "d", "c", None), (1, 8, None, None, "bad"), (1, 12, "l", "k", None)], s)
    fetched = spark.createDataFrame(
        [(1, 2, "b", "a", None), (1, 3, "x", "b", None), (1, 5, "e", "q", None), (1, 9, "i", "h", None), (1, 14, "n", "m", None)], s)
    ranges = spark.createDataFrame([(1, 2, 3), (1, 5, 7), (1, 9, 11), (1, 14, 14)], "stream_id bigint, l bigint, r bigint")
    assert pairs(audit.seam_check(ranges, fetched, stored, 1), "seq", "kind") == [
        (5, "HASH"), (9, "PREV_CORRUPT"), (14, "PREV_MISSING")]
    assert (4, "HASH_RIGHT") in pairs(audit.seam_check(ranges, fetched, stored, 1, check_right=True), "seq", "kind")


def test_validation_order_and_first_failure(spark):
    rows = [(1, 1, 1, "a", "", None, ["1"]), (1, 2, 2, "b", "a", None, ["2"]), (1, 4, 2, "c", "z", None, ["9"]),
            (1, 5, None, None, None, "bad_json", ["5"]), (1, 6, 6, "e", "c", None, [])]
    df = spark.createDataFrame(rows, "stream_id bigint, seq bigint, height bigint, hash string, prev_hash string, error string, ids array<string>")
    df = df.withColumn("headers", F.create_map(F.lit("Nats-Msg-Id"), F.col("ids")))
    found = audit.validation_findings(df, width=2)
    assert pairs(found, "seq", "kind") == [(4, "HASH"), (4, "HEIGHT"), (4, "MSG_ID"), (4, "SEQ_GAP"), (5, "CORRUPT"), (6, "MSG_ID")]
    assert pairs(audit.first_failure(found), "seq", "kind") == [(4, "SEQ_GAP")]
    found = audit.validation_findings(df, ignore_seq_gaps=True, ignore_msg_id=True)
    assert pairs(audit.first_failure(found), "seq", "kind") == [(4, "HASH")]
