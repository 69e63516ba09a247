"""Validation, comparison and size statistics as jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklog.functions.decode import CorruptRowsError, stage_decoded
from blocklog.functions.envelope import unwrapped
from blocklog.model import HEIGHT, HEIGHT_TYPE, SEQ, STREAM
from blocklog.operators import audit, compare, stats
from blocklog.session import Staging
from blocklog.sources.commits import CommitLog
from blocklog.sources.log import seq_range


def validate_backup(
    backup: DataFrame,
    mode: str = "nested",
    *,
    start: int = 1,
    end: int = 0,
    ignore_seq_gaps: bool = False,
    ignore_msg_id: bool = False,
    staging: Staging | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The report by kind and the first failure of each log; both empty for a sound backup."""
    staging = staging or Staging(backup.sparkSession)
    findings = audit.validation_findings(
        stage_decoded(backup.where(F.col(SEQ) >= start), mode, staging, with_headers=True, unsigned=True),
        end=end,
        ignore_seq_gaps=ignore_seq_gaps,
        ignore_msg_id=ignore_msg_id,
    )
    findings = staging.table(findings, "findings")
    return audit.validation_report(findings), audit.first_failure(findings)


def compare_logs(
    a: DataFrame,
    b: DataFrame,
    mode: str,
    *,
    start_a: int = 1,
    start_b: int = 1,
    envelope: bool = False,
    **skip_flags: bool,
) -> DataFrame:
    """The findings of a comparison up to the first that no flag excuses.

    With ``envelope`` the payloads have one, which is checked and then left out of the comparison.
    """
    if envelope:
        a, b = unwrapped(a), unwrapped(b)
    a, b = a.where(F.col(SEQ) >= start_a), b.where(F.col(SEQ) >= start_b)
    if mode == "simple":
        if envelope:
            a, b = (side.withColumnRenamed("envelope_error", "error") for side in (a, b))
        pairs = compare.compare_by_relative_seq(a, b, start_a, start_b)
        found = pairs.select(
            STREAM,
            F.lit(compare.BOTH).alias("side"),
            F.lit(audit.DISCREPANCY).alias("kind"),
            F.col("seq_a").alias("prev_seq"),
            F.lit(None).cast(HEIGHT_TYPE).alias("prev_height"),
            F.col("seq_b").alias(SEQ),
            F.lit(None).cast(HEIGHT_TYPE).alias(HEIGHT),
            F.col("relative_seq").alias("step"),
            F.lit(2).alias("phase"),
        )
        return compare.until_first_fatal(audit.mark_fatal(found, **skip_flags))
    staging = Staging(a.sparkSession)
    sides = [stage_decoded(side, mode, staging, with_key=True, unsigned=True) for side in (a, b)]
    return compare.until_first_fatal(
        compare.compare_findings(*sides, mode, key=F.col("key"), staging=staging, **skip_flags)
    )


class SequenceGap(RuntimeError):
    """A log whose rows do not follow each other."""


class SizeState:
    """Size distributions kept in a folder, one version per run, with the last sequence counted."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.commits = CommitLog(spark, path)

    def version(self) -> int:
        return max(self.commits.batches(), default=-1)

    def distribution(self) -> DataFrame:
        return self._read("distribution", "measure string, bucket bigint, n bigint")

    def progress(self, stream_type: str = "bigint") -> DataFrame:
        return self._read("progress", f"{STREAM} {stream_type}, last_processed_seq bigint")

    def dumps(self) -> DataFrame:
        """The rows that were too large, of all runs: STREAM, seq, data."""
        return self.commits.tables("dumps").drop("batch_id")

    def _read(self, part: str, schema: str) -> DataFrame:
        version = self.version()
        if version < 0:
            return self.spark.createDataFrame([], schema)
        return self.commits.table(part, version, schema)

    def update(
        self,
        log: DataFrame,
        packed: Column,
        unpacked: Column,
        *,
        start: int = 1,
        end: int = 0,
        resolution_kb: int = 64,
        ignore_gaps: bool = False,
        error: Column | None = None,
        dump_above: int | None = None,
    ) -> DataFrame:
        """Add the rows after the last counted sequence of each log; returns the new distribution.

        Fails, with nothing counted, where a sequence is left out or repeated, unless ``ignore_gaps``, and where ``error``,
        which says why a row could not be unpacked, is not null. Unpacked rows of over ``dump_above`` bytes are kept in
        :meth:`dumps`, in one table.
        """
        attempt = self.commits.attempt(self.version() + 1)  # of two runs at a time one fails
        kind = log.schema[STREAM].dataType.simpleString()
        mark = self.progress(kind)
        fresh = (
            log.where(seq_range(start, end))
            .join(mark, STREAM, "left")
            .where(F.col(SEQ) > F.coalesce("last_processed_seq", F.lit(0)))
        )
        if not ignore_gaps:
            ends = fresh.groupBy(STREAM).agg(
                F.min(SEQ).alias("l"), F.max(SEQ).alias("r"), F.count("*").alias("n"),
                F.max("last_processed_seq").alias("last"),
            )
            inside = F.col("n") != F.col("r") - F.col("l") + 1
            gap = ends.where(inside | (F.col("last").isNotNull() & (F.col("l") != F.col("last") + 1))).first()
            if gap is not None:
                raise SequenceGap(f"log {gap[STREAM]}: {gap['n']} rows from {gap['l']} to {gap['r']} after {gap['last']}")
        if error is not None:
            bad = fresh.where(error.isNotNull()).select(STREAM, SEQ, error.alias("error")).orderBy(STREAM, SEQ).first()
            if bad is not None:
                raise CorruptRowsError(f"log {bad[STREAM]}, sequence {bad[SEQ]}: {bad['error']}")
        new = stats.size_distribution(fresh, packed, unpacked, resolution_kb)
        seen = fresh.groupBy(STREAM).agg(F.max(SEQ).alias("last_processed_seq"))
        progress = mark.unionByName(seen).groupBy(STREAM).agg(
            F.max("last_processed_seq").alias("last_processed_seq")
        )
        merged = stats.merge_distribution(self.distribution(), new)
        attempt.write("distribution", merged)
        attempt.write("progress", progress)
        if dump_above is not None:
            attempt.write("dumps", fresh.where(F.octet_length(unpacked) > dump_above).select(STREAM, SEQ, unpacked.alias("data")))
        attempt.commit()
        return self.distribution()
