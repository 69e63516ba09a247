from pyspark.sql import functions as F

from blocklog.operators import resume
from blocklog.sources import backup, log, sinks


def seqs(df):
    return sorted(r.seq for r in df.collect())


def numbers(spark, n=20):
    return spark.range(1, n + 1).select(F.lit(1).cast("bigint").alias("stream_id"), F.col("id").alias("seq"))


def test_seq_range(spark):
    df = numbers(spark, 5)
    for (start, end), want in {(0, 0): [1, 2, 3, 4, 5], (2, 4): [2, 3], (4, 4): [], (5, 2): [], (0, 1): [], (3, 0): [3, 4, 5]}.items():
        assert seqs(df.where(log.seq_range(start, end))) == want


def test_range_and_columns_reach_the_scan(spark, tmp_path):
    numbers(spark).withColumn("payload", F.lit("x")).write.parquet(str(tmp_path / "log"))
    rows = log.read_log(spark, str(tmp_path / "log"), 3, 9)
    plan = rows.select("seq")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq,3)" in plan and "LessThan(seq,9)" in plan
    assert "payload" not in plan.split("ReadSchema")[1]
    assert seqs(rows) == [3, 4, 5, 6, 7, 8]


def test_ordered_scan(spark):
    parts = log.ordered_scan(numbers(spark, 50).orderBy(F.rand(1)), 4).rdd.glom().collect()
    flat = [r.seq for p in parts for r in p]
    assert flat == sorted(flat) and len(parts) == 4


def test_lookups(spark):
    df = numbers(spark, 9).where("seq % 3 != 0").withColumn("v", F.col("seq") * 2)
    assert seqs(log.get_at(df, 4)) == [4] and seqs(log.get_at(df, 6)) == []
    assert tuple(log.first_at_or_after(df, 6).first()) == (1, 7, 14)
    assert tuple(log.log_bounds(df).first()) == (1, 1, 8, 6)


def test_backup_roundtrip_and_chunk_limits(spark, tmp_path):
    path = str(tmp_path / "backup")
    rows = numbers(spark, 100).where("seq not in (40, 41)").withColumn("payload", F.lit("0123456789"))
    backup.write_backup(rows, path, max_entries=30, max_bytes=200, width=16)
    stored = backup.read_backup(spark, path, schema=rows.schema)
    assert seqs(stored) == seqs(rows)
    chunks = sorted(backup.chunk_ranges(stored).collect(), key=lambda r: r.l)
    assert all(r.chunk_id == r.l and r.n == r.r - r.l + 1 and r.n <= 20 for r in chunks)
    plan = backup.read_backup(spark, path, 50, 60, schema=rows.schema, from_chunk=42)._jdf.queryExecution().executedPlan().toString()
    assert "chunk_id" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert seqs(backup.read_backup(spark, path, 50, 60, schema=rows.schema)) == list(range(50, 60))
    over = backup.overlapping(backup.chunk_ranges(stored), 39, 42)
    assert sorted(r.l for r in over.collect()) == [31]
    loose = backup.assign_chunks(rows, max_entries=1000, split_at_holes=False, width=16)
    assert [r[0] for r in loose.select("chunk_id").distinct().collect()] == [1]


def test_resume_points(spark):
    decoded = spark.createDataFrame(
        [(1, 5, 10, None), (1, 6, None, "bad"), (1, 7, 12, None), (1, 9, 11, None), (1, 10, 15, None)],
        "stream_id bigint, seq bigint, height bigint, error string")

    def tip(height, stream=1):
        return spark.createDataFrame([(stream, height)], "stream_id bigint, height bigint")

    def at(tips, start=0, end=0):
        return {r.stream_id: r.resume_seq for r in resume.resume_seq(decoded, tips, start, end).collect()}

    none = tip(1).where("false")
    assert at(none) == {1: 5} and at(none, 6) == {1: 6} and at(none, 99) == {1: 10} and at(none, 2) == {1: 5}
    assert at(tip(11)) == {1: 7} and at(tip(12)) == {1: 10} and at(tip(12), 0, 9) == {1: 7} and at(tip(3)) == {1: 5} and at(tip(99)) == {1: 10}
    assert at(tip(4, 2)) == {1: 5, 2: 1}
    chunks = spark.createDataFrame([(1, 5, 6, 10), (1, 7, 8, 12), (1, 10, 12, 15)], "stream_id bigint, l bigint, r bigint, top bigint")

    def chunk(tips, start, end):
        r = resume.resume_chunk(chunks, tips, start, end).first()
        return r and r.chunk_start

    assert chunk(none, 1, 99) == 5 and chunk(tip(11), 1, 99) == 7 and chunk(tip(12), 1, 99) == 10 and chunk(tip(99), 1, 10) == 7
    assert chunk(tip(1), 7, 99) == 7 and chunk(tip(1), 13, 99) is None


def test_backfill_and_sinks(spark, tmp_path):
    source, stored = numbers(spark, 10), numbers(spark, 10).where("seq in (2, 3, 7)")
    assert seqs(resume.backfill(source, stored, 2, 9)) == [4, 5, 6, 8]
    sinks.append_plain(source, str(tmp_path / "plain"))
    sinks.append_plain(source, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 20
    big = source.withColumn("text", F.repeat(F.lit("x"), (F.col("seq") * 1024).cast("int")))
    assert seqs(sinks.oversize(big, F.col("text"), 9 / 1024)) == [10]
    sinks.dump_oversize(big, F.col("text"), str(tmp_path / "dump"), 8 / 1024)
    assert seqs(spark.read.text(str(tmp_path / "dump"))) == [9, 10]
    sinks.dump_oversize(big, F.col("text"), str(tmp_path / "dump"), 9 / 1024)
    assert seqs(spark.read.text(str(tmp_path / "dump"))) == [9, 10]
    sinks.write_findings(source, str(tmp_path / "found"))
    assert "found_at" in spark.read.parquet(str(tmp_path / "found")).columns
