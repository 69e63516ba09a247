import itertools
import random

import pytest
from pyspark.sql import functions as F

from blocklog.operators import audit, compare
from tests import folds

SCHEMA = "stream_id bigint, seq bigint, height bigint, hash string, prev_hash string, key string, error string"
KIND = {"UNEQUAL_DUPLICATE": "UNEQUALDUPLICATE"}


def side(rng, n):
    rows, seq, h = [], 0, rng.randint(0, 3)
    for _ in range(n):
        seq += rng.randint(1, 3)
        h = max(0, h + rng.choice([1, 1, 1, 1, 0, 2, 3, -1, -2]))
        rows.append((seq, h, rng.choice("xy"), rng.choice("xy"), rng.choice("pq")))
    return rows


@pytest.mark.parametrize("mode,width", [("nested", 3), ("flat", 1000)])
def test_compare_findings_equal_fold(spark, mode, width):
    rng = random.Random(width)
    names = ["DUPLICATE", "UNEQUALDUPLICATE", "GAP", "DOWNJUMP", "DISCREPANCY"]
    logs = {s: (side(rng, rng.randint(0, 12)), side(rng, rng.randint(0, 12))) for s in range(400)}
    df = [
        spark.createDataFrame([(s, *r, None) for s, ab in logs.items() for r in ab[i]], SCHEMA)
        for i in (0, 1)
    ]
    for flags in ({n: True for n in names}, {n: n != "DISCREPANCY" for n in names}, {n: n in ("DUPLICATE", "GAP") for n in names}):
        found = compare.compare_findings(
            df[0], df[1], mode, key=F.col("key"), width=width,
            skip_duplicates=flags["DUPLICATE"], skip_unequal_duplicates=flags["UNEQUALDUPLICATE"],
            skip_gaps=flags["GAP"], skip_downjumps=flags["DOWNJUMP"], skip_corrupted=True,
            skip_discrepancy=flags["DISCREPANCY"],
        )
        got = {s: [] for s in logs}
        for r in compare.until_first_fatal(found).orderBy("stream_id", "step", "phase", "seq").collect():
            got[r.stream_id].append((r.side, KIND.get(r.kind, r.kind), r.prev_seq, r.seq))
        for s, (a, b) in logs.items():
            want, _ = folds.compare(a, b, mode, flags)
            assert got[s] == want, (s, a, b)


def test_corrupt_rows_are_found_in_order(spark):
    a = [(1, 1, 1, "a", "", "p", None), (1, 2, None, None, None, "z", "bad"), (1, 3, 2, "b", "a", "p", None),
         (1, 4, None, None, None, "z", "bad")]
    b = [(1, 1, 1, "a", "", "p", None), (1, 2, 2, "b", "a", "q", None)]
    found = compare.compare_findings(
        spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), "nested", key=F.col("key"),
        skip_corrupted=True,
    )
    got = [(r.side, r.kind, r.seq) for r in compare.until_first_fatal(found).orderBy("step", "phase", "seq").collect()]
    assert got == [("A", "CORRUPTED", 2), ("AB", "DISCREPANCY", 2)]


def test_unequal_duplicate_needs_both_flags(spark):
    df = spark.createDataFrame([("UNEQUAL_DUPLICATE",), ("DUPLICATE",)], "kind string")
    for dup, unequal in itertools.product([True, False], repeat=2):
        got = {r.kind: r.fatal for r in audit.mark_fatal(df, skip_duplicates=dup, skip_unequal_duplicates=unequal).collect()}
        assert got == {"UNEQUAL_DUPLICATE": not (dup and unequal), "DUPLICATE": not dup}


def test_relative_seq(spark):
    s = "stream_id bigint, seq bigint, payload string"
    a = spark.createDataFrame([(1, 5, "x"), (1, 6, "y"), (1, 8, "z")], s)
    b = spark.createDataFrame([(1, 11, "x"), (1, 12, "n"), (1, 13, "m"), (1, 14, "z")], s)
    got = compare.compare_by_relative_seq(a, b, 5, 11).collect()
    assert [tuple(r) for r in got] == [(1, 1, 6, 12)]
