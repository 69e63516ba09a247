"""Reading message logs and looking up positions in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from blocklog.model import HEIGHT, SEQ, STREAM


def seq_range(start: int = 0, end: int = 0) -> Column:
    """``start <= seq < end``. A start below 1 is 1, an end of 0 is open, an empty range has no rows."""
    start = max(start, 1)
    if not end:
        return F.col(SEQ) >= start
    if start >= end:
        return F.lit(False)
    return (F.col(SEQ) >= start) & (F.col(SEQ) < end)


def read_log(
    spark: SparkSession,
    path: str,
    start: int = 0,
    end: int = 0,
    *,
    fmt: str = "parquet",
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Messages of ``[start, end)``; the range reaches the file scan as a filter."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).where(seq_range(start, end))


def read_log_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: int = 0,
    end: int = 0,
    *,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """The same log as a stream. ``max_files_per_trigger`` limits the rate of each micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).where(seq_range(start, end))


def ordered_scan(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in log order: ranges of (stream, seq) that are each sorted.

    The ranges are balanced by a sample of the rows, so a long log spreads over many tasks.
    """
    by = (STREAM, SEQ)
    ranged = (
        log.repartitionByRange(partitions, *by) if partitions else log.repartitionByRange(*by)
    )
    return ranged.sortWithinPartitions(*by)


def get_at(log: DataFrame, seq: int) -> DataFrame:
    return log.where(F.col(SEQ) == seq)


def log_bounds(log: DataFrame) -> DataFrame:
    """First and last sequence and number of rows of each log."""
    return log.groupBy(STREAM).agg(
        F.min(SEQ).alias("first_seq"), F.max(SEQ).alias("last_seq"), F.count("*").alias("n")
    )


def first_at_or_after(log: DataFrame, pos: int) -> DataFrame:
    """The first stored row of each log at or after a position, all its columns."""
    rest = [F.col(c) for c in log.columns if c not in (STREAM, SEQ)]
    return (
        log.where(F.col(SEQ) >= pos)
        .groupBy(STREAM)
        .agg(F.min(SEQ).alias(SEQ), F.min_by(F.struct(*rest), SEQ).alias("x"))
        .select(STREAM, SEQ, "x.*")
    )


def log_tip(decoded: DataFrame) -> DataFrame:
    """The last row of each log as a tip: STREAM, out_seq, height, hash, error."""
    return decoded.groupBy(STREAM).agg(
        F.max(SEQ).alias("out_seq"),
        F.max_by(HEIGHT, SEQ).alias(HEIGHT),
        F.max_by("hash", SEQ).alias("hash"),
        F.max_by("error", SEQ).alias("error"),
    )


def checked_tip(tip: DataFrame) -> DataFrame:
    """The tip, failing the job where the last row of a log does not decode."""
    message = F.concat_ws(" ", F.lit("corrupt tip:"), F.col(STREAM).cast("string"), F.col("error"))
    fine = F.when(F.col("error").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return tip.where(fine).drop("error")
