import random

import pytest
from pyspark.sql import functions as F

from blocklog.operators import gate as G
from blocklog.session import Staging
from tests import folds

SCHEMA = "stream_id bigint, seq bigint, height bigint, hash string, prev_hash string, error string"


def random_log(rng, n, hashes, heights):
    rows, seq, last = [], 0, None
    for _ in range(n):
        seq += rng.randint(1, 4)
        height = rng.randint(0, heights)
        prev = rng.choice(hashes)
        if last is not None and rng.random() < 0.5:
            prev, height = last[1], last[0] + rng.randint(0, 2)
        hash_ = rng.choice(hashes)
        error = "bad" if rng.random() < 0.08 else None
        rows.append((seq, height, hash_, prev, error))
        last = (height, hash_)
    return rows


def many_logs(seed, streams=250):
    rng = random.Random(seed)
    logs, tips = {}, {}
    for s in range(streams):
        hashes = [f"h{i}" for i in range(rng.choice([1, 2, 4, 9]))]
        logs[s] = random_log(rng, rng.randint(1, 30), hashes, rng.choice([3, 8, 200]))
        if rng.random() < 0.5:
            tips[s] = (rng.randint(1, 9), rng.randint(0, 4), rng.choice(hashes))
    return logs, tips


@pytest.mark.parametrize("seed,width,limit", [(1, 7, 10**6), (2, 2, 2)])
def test_write_gate_equals_fold(spark, seed, width, limit):
    logs, tips = many_logs(seed)
    rows = spark.createDataFrame(
        [(s, *r) for s, log in logs.items() for r in log], SCHEMA
    )
    tip_df = spark.createDataFrame(
        [(s, *t) for s, t in tips.items()], "stream_id bigint, out_seq bigint, height bigint, hash string"
    )
    got = {s: [] for s in logs}
    for r in G.write_gate(rows, tip_df, width=width, walk_limit=limit).orderBy("stream_id", "seq").collect():
        tip = None if r.tip_height is None else (r.tip_out_seq, r.tip_height, r.tip_hash)
        got[r.stream_id].append((r.seq, r.label, r.out_seq, tip))
    for s, log in logs.items():
        assert got[s] == folds.gate(log, tips.get(s)), s


def test_record_gate_equals_fold(spark):
    logs, tips = many_logs(9, 120)
    logs = {s: [(q, h, "", "", e) for q, h, _, _, e in log] for s, log in logs.items()}
    tips = {s: (o, h, "") for s, (o, h, _) in tips.items()}
    rows = spark.createDataFrame([(s, *r) for s, log in logs.items() for r in log], SCHEMA)
    tip_df = spark.createDataFrame(
        [(s, *t) for s, t in tips.items()], "stream_id bigint, out_seq bigint, height bigint, hash string"
    )
    got = {s: [] for s in logs}
    for r in G.record_gate(rows, tip_df, width=6).orderBy("stream_id", "seq").collect():
        tip = None if r.tip_height is None else (r.tip_out_seq, r.tip_height, r.tip_hash)
        got[r.stream_id].append((r.seq, r.label, r.out_seq, tip))
    for s, log in logs.items():
        assert got[s] == folds.gate(log, tips.get(s)), s


def test_heights_beyond_signed_64_bits(spark):
    big = 2**63
    rows = spark.sql(
        f"""select 1L stream_id, q seq, cast(h as decimal(20,0)) height, x hash, p prev_hash,
        cast(null as string) error from values (1L, '{big - 2}', 'a', ''), (2L, '{big - 1}', 'x', 'q'),
        (3L, '{big + 5}', 'b', 'a'), (4L, '3', 'a', ''), (5L, '{2**64 - 1}', 'c', 'b') t(q, h, x, p)"""
    )
    labels = [r.label for r in G.write_gate(rows, width=3).orderBy("seq").collect()]
    assert labels == ["ACCEPTED", "HASH_MISMATCH", "ACCEPTED", "LOW_HEIGHT", "ACCEPTED"]


def test_one_key_shared_by_a_third_of_the_rows(spark):
    """Copies of two blocks, interleaved: every copy is its own island and shares one key."""
    rows = spark.range(3000).select(
        F.lit(1).cast("bigint").alias("stream_id"),
        (F.col("id") + 1).alias("seq"),
        F.when(F.col("id") % 3 == 2, F.col("id")).otherwise(5 + F.col("id") % 3).alias("height"),
        F.when(F.col("id") % 3 == 2, F.concat(F.lit("z"), F.col("id"))).otherwise(
            F.concat(F.lit("h"), F.col("id") % 3)).alias("hash"),
        F.when(F.col("id") % 3 == 0, "g").when(F.col("id") % 3 == 1, "h0").otherwise("h1").alias("prev_hash"),
        F.lit(None).cast("string").alias("error"),
    )
    log = [(r.seq, r.height, r.hash, r.prev_hash, r.error) for r in rows.orderBy("seq").collect()]
    want = [x[:2] for x in folds.gate(log)]
    for limit in (10**6, 10):
        out = G.write_gate(rows, width=64, walk_limit=limit).orderBy("seq").collect()
        assert [(r.seq, r.label) for r in out] == want


@pytest.mark.parametrize("strict", [True, False])
def test_strict_sequence_equals_fold(spark, strict):
    rng = random.Random(5)
    logs = {s: [rng.randint(1, 7) if rng.random() < 0.5 else i + 1 for i in range(rng.randint(1, 25))]
            for s in range(150)}
    rows = spark.createDataFrame(
        [(s, i, q) for s, log in logs.items() for i, q in enumerate(log)], "stream_id bigint, arr bigint, seq bigint"
    )
    got = {s: [] for s in logs}
    for r in G.strict_sequence(rows, arrival="arr", start=1, strict=strict, width=6, walk_limit=4).orderBy("stream_id", "arr").collect():
        got[r.stream_id].append(r.kept)
    for s, log in logs.items():
        assert got[s] == folds.strict_sequence(log, 1, strict), (s, log)


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_tolerance_rules(spark, limit):
    rng = random.Random(limit)
    logs = {s: [rng.random() < 0.6 for _ in range(rng.randint(1, 15))] for s in range(60)}
    rows = spark.createDataFrame(
        [(s, i + 1, i + 1, w) for s, log in logs.items() for i, w in enumerate(log)],
        "stream_id bigint, seq bigint, pos bigint, w boolean",
    )
    runs = G.wrong_runs(rows, F.col("w"), width=4)
    got = {s: [] for s in logs}
    for r in runs.orderBy("stream_id", "seq").collect():
        got[r.stream_id].append(r.run)
    assert got == {s: folds.wrong_runs(log) for s, log in logs.items()}
    for rule in ("reach", "exceed"):
        cuts = {r.stream_id: r.cut for r in G.tolerance_cutoff(runs, limit, rule).collect()}
        for s, log in logs.items():
            over = [i + 1 for i, n in enumerate(folds.wrong_runs(log)) if (n >= limit if rule == "reach" else n > limit)]
            assert cuts.get(s) == (over[0] if over else None)


def test_successor(spark):
    logs, _ = many_logs(11, 60)
    rows = spark.createDataFrame([(s, *r) for s, log in logs.items() for r in log], SCHEMA)
    got = {(r.stream_id, r.seq): r.next_seq for r in G.successor(rows, rows, width=5).collect()}
    for s, log in logs.items():
        for i, (q, h, x, _, _) in enumerate(log):
            later = [r[0] for r in log[i + 1:] if r[3] == x and r[1] > h]
            assert got[(s, q)] == (later[0] if later else None)
