"""Checks of one log: sequence gaps, links, heights, duplicates, absent ranges, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.functions.decode import message_id_error
from blocklog.model import ERROR, HASH, HEADERS, HEIGHT, PAYLOAD, PREV_HASH, SEQ, STREAM
from blocklog.operators.prefix import (
    DEFAULT_WIDTH,
    Lag,
    LastValid,
    Lead,
    RunSum,
    with_prefix,
)

DOWNJUMP, GAP = "DOWNJUMP", "GAP"
DUPLICATE, UNEQUAL_DUPLICATE = "DUPLICATE", "UNEQUAL_DUPLICATE"
CORRUPTED, DISCREPANCY = "CORRUPTED", "DISCREPANCY"

# Order in which the checks of one row are made.
VALIDATION_KINDS = ("SEQ_GAP", "CORRUPT", "MSG_ID", "HASH", "HEIGHT")


def _no_error(df: DataFrame) -> Column:
    return F.col(ERROR).isNull() if ERROR in df.columns else F.lit(True)


def with_previous(
    rows: DataFrame, key: Column | None = None, *, width: int | None = DEFAULT_WIDTH
) -> DataFrame:
    """Decoded rows with ``prev``: seq, height, hash and payload key of the decoded row before."""
    fields = [F.col(SEQ).alias("seq"), F.col(HEIGHT).alias("height"), F.col(HASH).alias("hash")]
    if key is not None:
        rows = rows.withColumn("key", key)
        fields.append(F.col("key"))
    rows = rows.where(_no_error(rows))
    kept = [c for c in rows.columns if c not in (PAYLOAD, HEADERS)]
    return with_prefix(
        rows.select(*kept), [Lag(F.struct(*fields), "prev")], keys=[STREAM], order=SEQ, width=width
    )


def _findings(rows: DataFrame, kind: Column) -> DataFrame:
    return rows.where(kind.isNotNull()).select(
        STREAM,
        kind.alias("kind"),
        F.col("prev.seq").alias("prev_seq"),
        F.col("prev.height").alias("prev_height"),
        SEQ,
        HEIGHT,
    )


def link_check(rows: DataFrame, **options) -> DataFrame:
    """Rows whose ``prev_hash`` is not the hash of the row before."""
    bad = F.col(PREV_HASH) != F.col("prev.hash")
    return _findings(with_previous(rows, **options), F.when(bad, "HASH"))


def height_check(rows: DataFrame, **options) -> DataFrame:
    """Rows that are not higher than the row before."""
    bad = F.col(HEIGHT) <= F.col("prev.height")
    return _findings(with_previous(rows, **options), F.when(bad, "HEIGHT"))


def sequence_kind(mode: str) -> Column:
    """The anomaly of a row against ``prev``, or null. A row has at most one.

    In mode ``nested`` a jump in height is a gap only where the link is broken too. A broken link at
    the next height is not reported here; :func:`link_check` does.
    """
    height, before = F.col(HEIGHT), F.col("prev.height")
    jump = height > before + 1
    if mode == "nested":
        jump = jump & (F.col(PREV_HASH) != F.col("prev.hash"))
    elif mode != "flat":
        raise ValueError("mode should be 'nested' or 'flat'")
    return (
        F.when(height < before, DOWNJUMP)
        .when((height == before) & (F.col("key") == F.col("prev.key")), DUPLICATE)
        .when(height == before, UNEQUAL_DUPLICATE)
        .when(jump, GAP)
    )


def sequence_findings(rows: DataFrame, mode: str, key: Column, **options) -> DataFrame:
    """Downjumps, duplicates, unequal duplicates and gaps of a log."""
    return _findings(with_previous(rows, key, **options), sequence_kind(mode))


def mark_fatal(
    findings: DataFrame,
    *,
    skip_duplicates: bool = False,
    skip_unequal_duplicates: bool = False,
    skip_gaps: bool = False,
    skip_downjumps: bool = False,
    skip_corrupted: bool = False,
    skip_discrepancy: bool = False,
) -> DataFrame:
    """Add ``fatal``: whether the finding ends a comparison. Findings are kept either way."""
    excused = {
        DUPLICATE: skip_duplicates,
        UNEQUAL_DUPLICATE: skip_unequal_duplicates and skip_duplicates,
        GAP: skip_gaps,
        DOWNJUMP: skip_downjumps,
        CORRUPTED: skip_corrupted,
        DISCREPANCY: skip_discrepancy,
    }
    skipped = [kind for kind, skip in excused.items() if skip]
    fatal = ~F.col("kind").isin(skipped) if skipped else F.lit(True)
    return findings.withColumn("fatal", fatal)


# --- sequences ----------------------------------------------------------------------------------


def seq_gaps(
    log: DataFrame,
    *,
    start: int = 0,
    end: int = 0,
    resumed_after: int | None = None,
    check_end: bool = True,
    width: int | None = DEFAULT_WIDTH,
) -> DataFrame:
    """Rows whose sequence is not the one before plus 1: STREAM, prev_seq, seq.

    The first row is exempt. A resumed reader knows its last sequence, ``resumed_after``, and checks
    the first row too. The check comes before the end test: the first row at or after ``end`` still
    counts unless ``check_end`` is off.
    """
    rows = log.select(STREAM, SEQ).where(F.col(SEQ) >= start)
    if resumed_after is not None:
        rows = rows.where(F.col(SEQ) > resumed_after)
    if end and not check_end:
        rows = rows.where(F.col(SEQ) < end)
    rows = with_prefix(rows, [Lag(F.col(SEQ), "prev_seq")], keys=[STREAM], order=SEQ, width=width)
    if resumed_after is not None and resumed_after >= start:
        rows = rows.withColumn("prev_seq", F.coalesce("prev_seq", F.lit(resumed_after)))
    if end:
        rows = rows.where(F.col("prev_seq") < end)
    return rows.where(F.col(SEQ) != F.col("prev_seq") + 1).select(STREAM, "prev_seq", SEQ)


def absent_ranges(
    log: DataFrame,
    start: int,
    end: int,
    *,
    streams: DataFrame | None = None,
    width: int | None = DEFAULT_WIDTH,
) -> DataFrame:
    """Maximal runs of sequences in ``[start, end-1]`` that the log lacks: STREAM, l, r.

    ``streams`` names logs that must be complete even if nothing of them is stored.
    """
    if start < 1 or end <= start:
        raise ValueError("need 1 <= start < end")
    stored = log.select(STREAM, SEQ)
    names = stored.select(STREAM).distinct()
    if streams is not None:
        names = names.unionByName(streams.select(STREAM)).distinct()
    inside = stored.where((F.col(SEQ) >= start) & (F.col(SEQ) < end))
    edge = names.select(STREAM, F.lit(start - 1).cast(stored.schema[SEQ].dataType).alias(SEQ))
    following = with_prefix(
        inside.unionByName(edge), [Lead(F.col(SEQ), "next")], keys=[STREAM], order=SEQ, width=width
    ).withColumn("next", F.coalesce("next", F.lit(end)))
    return following.where(F.col("next") > F.col(SEQ) + 1).select(
        STREAM, (F.col(SEQ) + 1).alias("l"), (F.col("next") - 1).alias("r")
    )


def leftmost_absent_range(ranges: DataFrame) -> DataFrame:
    return ranges.groupBy(STREAM).agg(F.min(F.struct("l", "r")).alias("x")).select(STREAM, "x.*")


def segments(log: DataFrame, *, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """Contiguous runs of sequences: STREAM, l, r, n."""
    numbered = with_prefix(
        log.select(STREAM, SEQ),
        [RunSum(F.lit(1).cast("bigint"), "n")],
        keys=[STREAM],
        order=SEQ,
        width=width,
    )
    return (
        numbered.groupBy(STREAM, (F.col(SEQ) - F.col("n")).alias("run"))
        .agg(F.min(SEQ).alias("l"), F.max(SEQ).alias("r"), F.count("*").alias("n"))
        .drop("run")
    )


def seam_check(
    ranges: DataFrame,
    fetched: DataFrame,
    stored: DataFrame,
    start: int,
    *,
    check_right: bool = False,
) -> DataFrame:
    """Fetched segments that do not link to the stored rows beside them.

    ``ranges`` are the absent ranges that were filled, ``fetched`` and ``stored`` decoded rows. A
    segment that starts after ``start`` needs a stored row at ``l - 1`` that decodes and whose hash is
    the ``prev_hash`` of the row at ``l``. The right side is checked only on request.
    """
    ok = _no_error(stored)
    left_rows = stored.select(
        STREAM, (F.col(SEQ) + 1).alias("at"), F.col(HASH).alias("left_hash"),
        ok.alias("left_ok"), F.lit(True).alias("left_found"),
    )
    heads = fetched.select(STREAM, F.col(SEQ).alias("at"), PREV_HASH)
    left = (
        ranges.where(F.col("l") > start)
        .select(STREAM, F.col("l").alias("at"))
        .join(heads, [STREAM, "at"])
        .join(left_rows, [STREAM, "at"], "left")
    )
    problem = (
        F.when(F.col("left_found").isNull(), "PREV_MISSING")
        .when(~F.col("left_ok"), "PREV_CORRUPT")
        .when(F.col("left_hash") != F.col(PREV_HASH), "HASH")
    )
    out = left.select(STREAM, F.col("at").alias(SEQ), problem.alias("kind"))
    if check_right:
        tails = fetched.select(STREAM, (F.col(SEQ) + 1).alias("at"), F.col(HASH).alias("tail_hash"))
        right = (
            ranges.select(STREAM, (F.col("r") + 1).alias("at"))
            .join(tails, [STREAM, "at"])
            .join(
                stored.where(ok).select(STREAM, F.col(SEQ).alias("at"), PREV_HASH), [STREAM, "at"]
            )
        )
        bad = F.when(F.col("tail_hash") != F.col(PREV_HASH), "HASH_RIGHT")
        out = out.unionByName(right.select(STREAM, F.col("at").alias(SEQ), bad.alias("kind")))
    return out.where(F.col("kind").isNotNull())


# --- validation ---------------------------------------------------------------------------------


def validation_findings(
    decoded: DataFrame,
    *,
    end: int = 0,
    ignore_seq_gaps: bool = False,
    ignore_msg_id: bool = False,
    width: int | None = DEFAULT_WIDTH,
) -> DataFrame:
    """Every problem of a stored log: STREAM, seq, kind, reason, from one prefix pass.

    Links and heights are checked against the decoded row before. ``end`` excludes rows from there
    on, except that the first of them can still show a sequence gap.
    """
    ok = _no_error(decoded)
    reason = F.col(ERROR) if ERROR in decoded.columns else F.lit(None).cast("string")
    msg_id = F.when(ok, message_id_error(F.col(HEADERS), F.col(HEIGHT)))
    if ignore_msg_id:
        msg_id = F.lit(None).cast("string")
    rows = decoded.select(
        STREAM, SEQ, HEIGHT, HASH, PREV_HASH, reason.alias("reason"), msg_id.alias("msg_id_reason")
    )
    valid = F.col("reason").isNull()
    rows = with_prefix(
        rows,
        [
            Lag(F.col(SEQ), "before"),
            LastValid(F.when(valid, F.struct(HEIGHT, HASH)), "prev", inclusive=False),
        ],
        keys=[STREAM],
        order=SEQ,
        width=width,
    )
    inside = (F.col(SEQ) < end) if end else F.lit(True)
    gap = F.col(SEQ) != F.col("before") + 1
    if end:
        gap = gap & (F.col("before") < end)
    if ignore_seq_gaps:
        gap = F.lit(False)
    checks = F.array(
        F.when(gap, F.struct(F.lit("SEQ_GAP").alias("kind"), F.lit("seq_gap").alias("reason"))),
        F.when(
            inside & F.col("reason").isNotNull(),
            F.struct(F.lit("CORRUPT").alias("kind"), F.col("reason")),
        ),
        F.when(
            inside & F.col("msg_id_reason").isNotNull(),
            F.struct(F.lit("MSG_ID").alias("kind"), F.col("msg_id_reason").alias("reason")),
        ),
        F.when(
            inside & valid & (F.col(PREV_HASH) != F.col("prev.hash")),
            F.struct(F.lit("HASH").alias("kind"), F.lit("hash_mismatch").alias("reason")),
        ),
        F.when(
            inside & valid & (F.col(HEIGHT) <= F.col("prev.height")),
            F.struct(F.lit("HEIGHT").alias("kind"), F.lit("height_not_above").alias("reason")),
        ),
    )
    return rows.select(STREAM, SEQ, F.inline(F.array_compact(checks)))


def validation_report(findings: DataFrame) -> DataFrame:
    return findings.groupBy(STREAM, "kind").agg(
        F.count("*").alias("n"), F.min(SEQ).alias("first_seq")
    )


def first_failure(findings: DataFrame) -> DataFrame:
    """The earliest finding of each log; within a row in the order of the checks."""
    rank = F.array_position(F.array(*[F.lit(k) for k in VALIDATION_KINDS]), F.col("kind"))
    return (
        findings.groupBy(STREAM)
        .agg(F.min(F.struct(SEQ, rank.alias("rank"), "kind", "reason")).alias("x"))
        .select(STREAM, F.col("x.seq").alias(SEQ), "x.kind", "x.reason")
    )
