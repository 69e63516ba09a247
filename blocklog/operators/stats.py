"""Counters, gauges, histograms and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.functions.scalar import size_bucket
from blocklog.model import (
    ACCEPTED, CORRUPT, HASH_MISMATCH, HEIGHT, LOW_HEIGHT, LOW_SEQ, SEQ, STREAM, TS,
)

# --- sizes --------------------------------------------------------------------------------------


def size_distribution(
    rows: DataFrame, packed: Column, unpacked: Column, resolution_kb: int = 64
) -> DataFrame:
    """Rows per size bucket of both sizes: measure, bucket, n."""
    sizes = F.array(
        F.struct(
            F.lit("packed").alias("measure"),
            size_bucket(F.octet_length(packed), resolution_kb).alias("bucket"),
        ),
        F.struct(
            F.lit("unpacked").alias("measure"),
            size_bucket(F.octet_length(unpacked), resolution_kb).alias("bucket"),
        ),
    )
    return rows.select(F.inline(sizes)).groupBy("measure", "bucket").agg(F.count("*").alias("n"))


def merge_distribution(state: DataFrame, new: DataFrame) -> DataFrame:
    return (
        state.select("measure", "bucket", "n")
        .unionByName(new.select("measure", "bucket", "n"))
        .groupBy("measure", "bucket")
        .agg(F.sum("n").alias("n"))
    )


# --- histograms ---------------------------------------------------------------------------------


def linear_bounds(low: float, high: float, count: int) -> list[float]:
    width = (high - low) / count
    return [low + i * width for i in range(count)]


def exponential_bounds(low: float, high: float, count: int) -> list[float]:
    if low <= 0 or count < 1:
        raise ValueError("exponential bounds need low > 0 and count >= 1")
    factor = (high / low) ** (1 / (count - 1)) if count > 1 else 1.0
    return [low * factor**i for i in range(count)]


def histogram(rows: DataFrame, value: Column, bounds: list[float]) -> DataFrame:
    """Cumulative counts by upper bound: bound_no, bound, n. The last row has no bound and counts all.

    One aggregate with a counter per bound, so nothing is sorted.
    """
    counters = [F.count_if(value <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(bounds)]
    total = F.count(value).alias(f"c{len(bounds)}")
    entries = [
        F.struct(
            F.lit(i).cast("bigint").alias("bound_no"),
            F.lit(b).cast("double").alias("bound"),
            F.col(f"c{i}").alias("n"),
        )
        for i, b in enumerate([*bounds, None])
    ]
    return rows.agg(*counters, total).select(F.inline(F.array(*entries)))


def hist_linear(rows: DataFrame, value: Column, low: float, high: float, count: int) -> DataFrame:
    return histogram(rows, value, linear_bounds(low, high, count))


def hist_exponential(
    rows: DataFrame, value: Column, low: float, high: float, count: int
) -> DataFrame:
    return histogram(rows, value, exponential_bounds(low, high, count))


# --- sync metrics -------------------------------------------------------------------------------


def counter_columns() -> list[Column]:
    def labelled(*labels: str) -> Column:
        return F.count_if(F.col("label").isin(*labels))

    return [
        F.count("label").alias("reads"),
        labelled(ACCEPTED).alias("writes"),
        labelled(LOW_SEQ).alias("low_seq_skips"),
        labelled(CORRUPT).alias("corrupted_skips"),
        labelled(LOW_HEIGHT).alias("low_height_skips"),
        labelled(HASH_MISMATCH).alias("hash_mismatch_skips"),
    ]


def position_columns() -> list[Column]:
    """How far reader and writer are over all logs."""
    at_accepted = F.col("label") == ACCEPTED
    return [
        F.max(SEQ).alias("reader_seq"),
        F.max(F.when(at_accepted, F.col(SEQ))).alias("last_written_input_seq"),
        F.max(F.when(at_accepted, F.col(HEIGHT))).alias("last_written_height"),
    ]


def sync_counters(labelled: DataFrame) -> DataFrame:
    """Reads, writes and skips by reason, per log."""
    return labelled.groupBy(STREAM).agg(*counter_columns())


def gauge_columns() -> list[Column]:
    accepted = F.col("label") == ACCEPTED
    judged = F.col("label").isin(ACCEPTED, LOW_HEIGHT, HASH_MISMATCH)
    tip_after = F.when(accepted, F.col(HEIGHT)).otherwise(F.col("tip_height"))
    at_accepted = F.when(accepted, F.col(SEQ))
    return [
        F.max(SEQ).alias("reader_seq"),
        F.max_by(HEIGHT, F.when(judged, F.col(SEQ))).alias("reader_height"),
        F.max_by(tip_after, F.when(tip_after.isNotNull(), F.col(SEQ))).alias("writer_tip_height"),
        F.max_by(HEIGHT, at_accepted).alias("last_written_height"),
        F.max(at_accepted).alias("last_written_input_seq"),
        F.max("out_seq").alias("last_written_output_seq"),
        F.min(SEQ).alias("input_first_seq"),
        F.max(SEQ).alias("input_last_seq"),
        F.min("out_seq").alias("output_first_seq"),
        F.max("out_seq").alias("output_last_seq"),
    ]


def sync_gauges(
    labelled: DataFrame,
    *,
    start: int = 0,
    end: int = 0,
    tolerance: int = 0,
    input_bounds: DataFrame | None = None,
    output_bounds: DataFrame | None = None,
) -> DataFrame:
    """Positions of reader and writer, per log.

    ``labelled`` comes from a gate; with the column ``run`` of :func:`wrong_runs` the current run of
    wrong rows is shown too. First and last sequences of the whole input and output replace those of
    the labelled rows when given (STREAM, first_seq, last_seq).
    """
    columns = gauge_columns()
    if "run" in labelled.columns:
        columns.append(F.max_by("run", SEQ).alias("consecutive_wrong"))
    gauges = labelled.groupBy(STREAM).agg(*columns)
    for name, bounds in (("input", input_bounds), ("output", output_bounds)):
        if bounds is not None:
            gauges = gauges.join(
                bounds.select(
                    STREAM, F.col("first_seq").alias("__first"), F.col("last_seq").alias("__last")
                ),
                STREAM,
                "left",
            )
            gauges = gauges.withColumn(
                f"{name}_first_seq", F.coalesce("__first", f"{name}_first_seq")
            ).withColumn(f"{name}_last_seq", F.coalesce("__last", f"{name}_last_seq")).drop(
                "__first", "__last"
            )
    configured = {"input_start_seq": start, "input_end_seq": end, "tolerance_window": tolerance}
    return gauges.select(
        "*", *[F.lit(v).cast("bigint").alias(name) for name, v in configured.items()]
    )


def sync_status(gauges: DataFrame) -> DataFrame:
    """Four rows per log: LAST, READER, WRITER and FIRST position of both sides; unset is 0."""

    def most(*names: str) -> Column:
        values = [F.coalesce(name, F.lit(0)) for name in names]
        return values[0] if len(values) == 1 else F.greatest(*values)

    none = F.lit(None).cast("bigint")
    lines = {
        "LAST": (
            most("input_last_seq", "reader_seq"),
            most("output_last_seq", "last_written_output_seq"),
            none,
            most("writer_tip_height"),
        ),
        "READER": (most("reader_seq"), none, most("reader_height"), none),
        "WRITER": (
            most("last_written_input_seq"),
            most("last_written_output_seq"),
            most("last_written_height"),
            most("last_written_height"),
        ),
        "FIRST": (most("input_first_seq"), most("output_first_seq"), none, none),
    }
    columns = ("input_seq", "output_seq", "input_height", "output_height")
    rows = [
        F.struct(
            F.lit(line).alias("line"),
            *[v.cast("bigint").alias(c) for c, v in zip(columns, values)],
        )
        for line, values in lines.items()
    ]
    return gauges.select(STREAM, F.inline(F.array(*rows)))


def progress(rows: DataFrame) -> DataFrame:
    """Current sequence and height of each log."""
    return rows.groupBy(STREAM).agg(
        F.max(SEQ).alias(SEQ), F.max_by(HEIGHT, SEQ).alias(HEIGHT)
    )


def throughput(rows: DataFrame, seconds: int = 3, ts: str = TS) -> DataFrame:
    """Messages per event-time interval and per second."""
    return (
        rows.groupBy(STREAM, F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(F.count("*").alias("n"))
        .select(
            STREAM,
            F.col("w.start").alias("window_start"),
            "n",
            (F.col("n") / seconds).alias("per_second"),
        )
    )
