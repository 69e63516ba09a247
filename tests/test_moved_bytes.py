"""What jobs move and hold: narrow tables, and files of messages whose size does not grow with the log."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from blocklog import fixtures as fx
from blocklog.functions import decode as D
from blocklog.operators import compare, gate
from blocklog.operators.prefix import RunSum, with_prefix_in_groups
from blocklog.plans.verified import bridge_rules, label_messages, state_schema
from blocklog.session import Staging

ROWS = "stream_id bigint, seq bigint, height bigint, hash string, prev_hash string, key string, error string"


def chain(spark, n=60):
    return spark.createDataFrame([(1, i, i, f"h{i}", f"h{i - 1}", f"k{i}", None) for i in range(1, n)], ROWS)


def staged(staging, name):
    """Columns and files of the tables that were staged under a name."""
    found = []
    for path in staging._paths.get(name, []):
        local = path.removeprefix("file:")
        found += [(set(pq.read_schema(os.path.join(local, f)).names), f) for f in os.listdir(local) if f.endswith(".parquet")]
    return found


def test_staged_tables_are_written_with_zstd(spark):
    staging = Staging(spark)
    staging.table(chain(spark), "rows")
    assert all(f.endswith(".zstd.parquet") for _, f in staged(staging, "rows"))


def test_files_of_messages_are_bounded_and_batches_stay(spark):
    log = Staging(spark).table(spark.range(20_000).select(F.lit(1).alias("stream_id"), (F.col("id") + 1).alias("seq"), F.md5(F.col("id").cast("string")).alias("payload")), "log")
    whole = fx.message_files(spark, log, "whole")
    parts = fx.message_files(spark, log, "parts", file_bytes=fx.input_bytes(spark, log) // 12)
    files = [f for f in os.listdir(parts.removeprefix("file:")) if f.endswith(".parquet")]
    assert fx.files_of_batch(spark, whole) == 1
    assert len(files) >= 12 and -(-len(files) // fx.files_of_batch(spark, parts)) == 3
    sizes = [r["count"] for r in spark.read.parquet(parts).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 20_000 / 6 and sum(sizes) == 20_000


def test_labels_move_no_hashes(spark):
    staging = Staging(spark)
    rows = D.stage_decoded(chain(spark).select("stream_id", "seq", F.lit("{}").alias("payload")), "nested", staging)
    labelled = gate.write_gate(rows, staging=staging).select("stream_id", "seq", "label", "out_seq")
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "key#" not in plan and "ref#" not in plan


def test_findings_keep_no_hashes(spark):
    staging = Staging(spark)
    compare.compare_findings(chain(spark), chain(spark, 50), "nested", key=F.col("key"), staging=staging).collect()
    sides = staged(staging, "side-a") + staged(staging, "side-b")
    assert sides and all(not {"hash", "prev_hash", "prev"} & names for names, _ in sides)
    assert not staged(staging, "steps-a") and not staged(staging, "steps-b")


def test_runs_are_told_by_log(spark):
    block = F.concat(F.lit('{"block":{"header":{"hash":"'), "hash", F.lit('","prev_hash":"'), "prev_hash", F.lit('","height":'), "height", F.lit("}}}"))
    messages = chain(spark).select("stream_id", "seq", F.when(F.col("seq").isin(8, 9), "x").otherwise(block).alias("payload"))
    staging = Staging(spark)
    prior = spark.createDataFrame([], state_schema(messages.schema["stream_id"].dataType))
    labelled, ends = label_messages(messages, prior, bridge_rules(tolerance=2), staging)
    assert [tuple(r) for r in ends.collect()] == [(1, 9, 2)]
    assert labelled.agg(F.max("seq")).first()[0] == 9
    assert not staged(staging, "runs") and all("tip_hash" not in names for names, _ in staged(staging, "labelled"))
    assert labelled.where("label <> 'ACCEPTED' and hash is not null").isEmpty()


def test_hashes_are_packed_without_a_loss(spark):
    texts = ["", "00", "0aF", "0af1", "0AF1", "xyz", "é", "\x01", "abc", "61", "a", "d41d8cd98f00b204e9800998ecf8427e"]
    packed = spark.createDataFrame([(t,) for t in texts], "t string").select("t", gate._packed(F.col("t")).alias("p"))
    rows = packed.select("t", "p", gate._text(F.col("p")).alias("back")).collect()
    assert [r.back for r in rows] == texts
    assert len({bytes(r.p) for r in rows}) == len(texts)
    assert len(rows[-1].p) == 17


def test_links_are_told_apart_by_numbers_and_steps_are_written_once(spark):
    staging = Staging(spark)
    gate.write_gate(chain(spark), staging=staging).collect()
    events = staged(staging, "events")
    assert events and all("link" not in names for names, _ in events)
    assert staged(staging, "reached")


def test_runs_are_not_dealt_out_again(spark):
    def shuffles(rows):
        runs = gate.wrong_runs(rows, F.col("label") == "HASH_MISMATCH").select("stream_id", "seq", "run")
        return runs, runs._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY")

    (told, some), (dealt, none) = shuffles(gate.write_gate(chain(spark))), shuffles(gate.write_gate(chain(spark), dealt=True))
    assert some > none and told.columns == dealt.columns
    assert sorted(told.collect()) == sorted(dealt.collect())


def test_keys_are_counted_by_shares(spark, tmp_path):
    """A frequent key is still found where shares of keys are counted first."""
    staging = Staging(spark)
    rows = staging.table(spark.range(60).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("k"), (F.col("id") + 1).alias("p")), "rows")
    got = with_prefix_in_groups(rows, [RunSum(F.lit(1).cast("bigint"), "n")], keys=["k"], order="p", staging=staging, width=8)
    assert {(r.k, r.p): r.n for r in got.collect()} == {**{(0, p): p for p in range(1, 41)}, **{(p - 1, p): 1 for p in range(41, 61)}}
    assert staged(staging, "hot")
