import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from blocklog.operators.prefix import (
    Lag, LastValid, Lead, NextValid, RunMax, RunSum, with_prefix,
)


@pytest.mark.parametrize("width,tiers", [(1, 1), (2, 2), (7, 1), (3, 3), (10**6, 1), (None, 1)])
def test_equals_plain_window(spark, width, tiers):
    rng = random.Random(width or 0)
    rows, seq = [], {}
    for _ in range(600):
        s = rng.choice([1, 1, 1, 2, 3])
        seq[s] = seq.get(s, 0) + rng.choice([1, 1, 2, 40])
        rows.append((s, seq[s], rng.choice([None, rng.randint(-5, 50)])))
    df = spark.createDataFrame(rows, "k bigint, seq bigint, v bigint")
    v = F.col("v")
    got = with_prefix(
        df,
        [Lag(v, "lag"), Lead(v, "lead"), RunMax(v, "mx"), RunMax(v, "mxi", inclusive=True),
         RunSum(v, "sm"), RunSum(v, "sme", inclusive=False), LastValid(v, "lv"),
         LastValid(v, "lve", inclusive=False), NextValid(v, "nv"), NextValid(v, "nvi", inclusive=True)],
        keys=["k"], order="seq", width=width, tiers=tiers,
    )
    w = Window.partitionBy("k").orderBy("seq")
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    after, on = w.rowsBetween(1, Window.unboundedFollowing), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.select(
        "k", "seq", "v", F.lag(v).over(w), F.lead(v).over(w), F.max(v).over(before), F.max(v).over(upto),
        F.coalesce(F.sum(v).over(upto), F.lit(0)), F.coalesce(F.sum(v).over(before), F.lit(0)),
        F.last(v, True).over(upto), F.last(v, True).over(before),
        F.first(v, True).over(after), F.first(v, True).over(on),
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
