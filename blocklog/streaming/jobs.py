"""Continuous copy, backup and restore, and the streaming forms of deduplication and statistics.

The batch step of each job is the one of the batch plans. Its position is the state in its output;
the checkpoint of the query only keeps the source offsets.
"""

from __future__ import annotations

import hashlib
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from blocklog.functions.decode import first_header
from blocklog.model import HEADERS, MSG_ID_HEADER, SEQ, STREAM, TS
from blocklog.operators import stats
from blocklog.plans.transfer import backup
from blocklog.plans.verified import CopyRules, VerifiedOutput, copy_batch
from blocklog.session import child_names, make_folder
from blocklog.sources.sinks import Sink
from blocklog.sources.stored_ranges import StoredRanges


#: Batches whose counters are held.
KEPT = 1000


def start(
    rows: DataFrame,
    sink: Sink,
    checkpoint: str,
    *,
    once: bool = True,
    interval: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run a sink on each micro-batch: all that is there now, or on and on at an interval."""
    writer = (
        rows.writeStream.foreachBatch(sink)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(
        processingTime=interval or "0 seconds"
    )
    return writer.start()


def _first_batch(output: VerifiedOutput, checkpoint: str) -> int:
    """Output batch that the query's batch 0 stands for; fixed when a checkpoint is first used."""
    folder = f"{output.path}/queries"
    tag = hashlib.md5(checkpoint.encode()).hexdigest()
    for name in child_names(output.spark, folder):
        if name.startswith(f"{tag}="):
            return int(name.split("=")[1])
    first = output.next_batch()
    make_folder(output.spark, f"{folder}/{tag}={first}")
    return first


def bridge_stream(
    messages: DataFrame,
    output: VerifiedOutput,
    rules: CopyRules,
    checkpoint: str,
    *,
    sink: Sink | None = None,
    metrics: SyncMetrics | None = None,
    **run,
) -> StreamingQuery:
    """Continuous verified copy. With :func:`restore_rules` it restores from a stream of backup files.

    ``metrics`` is kept current by each batch of this run.
    """
    first = _first_batch(output, checkpoint)

    def step(rows: DataFrame, batch: int) -> None:
        copy_batch(rows, output, first + batch, rules, sink=sink, metrics=metrics)

    return start(messages, step, checkpoint, **run)


def backup_stream(
    records: DataFrame, path: str, start_seq: int, end_seq: int, checkpoint: str,
    *, mode: str = "simple", limits: dict | None = None, **run,
) -> StreamingQuery:
    """Continuous backup. A repeated batch finds its rows stored and adds nothing.

    The intervals of what is stored are kept from batch to batch, so a batch costs what its own rows cost.
    """
    stored = StoredRanges(records.sparkSession, path, records.schema, mode)

    def step(rows: DataFrame, batch: int) -> None:
        backup(rows, path, start_seq, end_seq, mode=mode, stored=stored, **(limits or {}))

    return start(records, step, checkpoint, **run)


def dedup_window(messages: DataFrame, window: str, ts: str = TS) -> DataFrame:
    """Drop messages whose id was seen within the window, as a server with such a window does."""
    msg_id = first_header(F.col(HEADERS), MSG_ID_HEADER)
    return (
        messages.withColumn(ts, F.col(ts).cast("timestamp"))
        .withColumn("msg_id", msg_id)
        .withWatermark(ts, window)
        .dropDuplicatesWithinWatermark([STREAM, "msg_id"])
    )


def size_stream(
    rows: DataFrame, packed: Column, unpacked: Column, resolution_kb: int = 64
) -> DataFrame:
    """Size distribution kept current; write it in update or complete mode."""
    return stats.size_distribution(rows, packed, unpacked, resolution_kb)


def throughput_stream(
    rows: DataFrame, seconds: int = 3, late: str = "1 minute", ts: str = TS
) -> DataFrame:
    """Messages per event-time interval; an interval is complete once the watermark has passed it."""
    return stats.throughput(
        rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late), seconds, ts
    )


def observed(messages: DataFrame, name: str = "reader") -> DataFrame:
    """The same rows with read counters that a listener gets with each micro-batch."""
    return messages.observe(
        name,
        F.count(F.lit(1)).alias("reads"),
        F.max(SEQ).alias("reader_seq"),
        F.min(SEQ).alias("first_seq"),
    )


class SyncMetrics:
    """Counters and positions of a running copy: totals since it began, and the latest batches.

    Counters add up over the batches (reads, writes and skips by reason), positions keep their greatest value. A batch that is
    run again counts once. Only `kept` batches are held, so memory does not grow with the life of the copy.
    """

    COUNTERS = ("reads", "writes", "low_seq_skips", "corrupted_skips", "low_height_skips", "hash_mismatch_skips")
    POSITIONS = ("reader_seq", "last_written_input_seq", "last_written_height")

    def __init__(self, kept: int = KEPT):
        self.totals = dict.fromkeys(self.COUNTERS, 0)
        self.positions: dict = dict.fromkeys(self.POSITIONS)
        self.batches: deque[dict] = deque(maxlen=kept)

    def __call__(self, batch: int, seen: dict) -> None:
        if self.batches and batch <= self.batches[-1]["batch"]:
            return
        self.batches.append({"batch": batch, **seen})
        for name in self.COUNTERS:
            self.totals[name] += seen.get(name) or 0
        for name in self.POSITIONS:
            known = [v for v in (seen.get(name), self.positions[name]) if v is not None]
            self.positions[name] = max(known, default=None)


class SyncListener(StreamingQueryListener):
    """Keeps the observed counters of the latest micro-batches, newest last."""

    def __init__(self, kept: int = KEPT):
        self.progress: deque[dict] = deque(maxlen=kept)

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        for name, row in event.progress.observedMetrics.items():
            self.progress.append({"batch": event.progress.batchId, "name": name, **row.asDict()})

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def watch(spark: SparkSession) -> SyncListener:
    listener = SyncListener()
    spark.streams.addListener(listener)
    return listener
