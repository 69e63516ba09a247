"""Comparison of two logs.

The reference order of work is a merge: both sides are read in sequence, the side that is behind in
height is advanced, and equal heights are compared. Row k of side A meets row j of side B exactly when
their heights are equal, a_k is the largest height of A so far, and b_j is higher than all of B before
it. That is an equi-join of two filtered sides, in which B has at most one row per height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.functions.decode import payload_key
from blocklog.model import ERROR, HASH, HEIGHT, PAYLOAD, PREV_HASH, SEQ, STREAM
from blocklog.operators.audit import CORRUPTED, DISCREPANCY, mark_fatal, sequence_kind
from blocklog.operators.prefix import (
    DEFAULT_WIDTH,
    LastValid,
    NextValid,
    RunMax,
    RunSum,
    with_prefix,
)
from blocklog.session import Staging

A, B, BOTH = "A", "B", "AB"

FINDING_COLUMNS = (
    STREAM, "side", "kind", "prev_seq", "prev_height", SEQ, HEIGHT, "step", "phase",
)


def prepare_side(
    decoded: DataFrame,
    key: Column | None = None,
    *,
    order: str = SEQ,
    width: int | None = DEFAULT_WIDTH,
) -> DataFrame:
    """Narrow rows of one side with what the comparison needs of the rows before.

    ``prev`` is the decoded row before, ``top`` the largest height before, ``nth`` the number the row
    has (or would have) among the decoded rows.
    """
    key = payload_key(F.col(PAYLOAD)) if key is None else key
    error = F.col(ERROR) if ERROR in decoded.columns else F.lit(None).cast("string")
    ok = F.col(ERROR).isNull()
    rows = decoded.select(
        STREAM, SEQ, HEIGHT, HASH, PREV_HASH, key.alias("key"), error.alias(ERROR),
        *[c for c in (order,) if c != SEQ],
    )
    here = F.struct(
        F.col(SEQ).alias("seq"), F.col(HEIGHT).alias("height"), F.col(HASH).alias("hash"), "key"
    )
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return with_prefix(
        rows,
        [
            LastValid(F.when(ok, here), "prev", inclusive=False),
            RunMax(F.when(ok, F.col(HEIGHT)), "top"),
            RunSum(F.when(ok, one).otherwise(zero), "before", inclusive=False),
        ],
        keys=[STREAM],
        order=order,
        width=width,
    ).withColumn("nth", F.col("before") + 1).drop("before")


def meets_as_a() -> Column:
    """Rows of side A that can meet a row of B: none before is higher."""
    return F.col(ERROR).isNull() & (F.col("top").isNull() | (F.col(HEIGHT) >= F.col("top")))


def meets_as_b() -> Column:
    """Rows of side B that can meet rows of A: all before are lower."""
    return F.col(ERROR).isNull() & (F.col("top").isNull() | (F.col(HEIGHT) > F.col("top")))


def _meeting(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of rows that the merge compares, with both payload keys."""
    left, right = a.where(meets_as_a()), b.where(meets_as_b())
    extra = [c for c in ("top", "nth") if c in a.columns]
    return left.select(
        STREAM, HEIGHT, F.col(SEQ).alias("seq_a"), F.col("key").alias("key_a"),
        *[F.col(c).alias(f"{c}_a") for c in extra],
    ).join(
        right.select(
            STREAM, HEIGHT, F.col(SEQ).alias("seq_b"), F.col("key").alias("key_b"),
            *[F.col(c).alias(f"{c}_b") for c in extra],
        ),
        [STREAM, HEIGHT],
    )


def compare_by_height(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of equal height and different payload: STREAM, height, seq_a, seq_b.

    ``a`` and ``b`` come from :func:`prepare_side`.
    """
    return (
        _meeting(a, b)
        .where(F.col("key_a") != F.col("key_b"))
        .select(STREAM, HEIGHT, "seq_a", "seq_b")
    )


def compare_by_relative_seq(
    a: DataFrame, b: DataFrame, start_a: int, start_b: int, key: Column | None = None
) -> DataFrame:
    """Rows at the same distance from the start of their log with different payload."""
    key = payload_key(F.col(PAYLOAD)) if key is None else key

    def side(df: DataFrame, start: int, tag: str) -> DataFrame:
        rows = df.where(F.col(ERROR).isNull()) if ERROR in df.columns else df
        return rows.where(F.col(SEQ) >= start).select(
            STREAM, (F.col(SEQ) - start).alias("relative_seq"),
            F.col(SEQ).alias(f"seq_{tag}"), key.alias(f"key_{tag}"),
        )

    return (
        side(a, start_a, "a")
        .join(side(b, start_b, "b"), [STREAM, "relative_seq"])
        .where(F.col("key_a") != F.col("key_b"))
        .select(STREAM, "relative_seq", "seq_a", "seq_b")
    )


def _narrowed(side: DataFrame, mode: str, meets: Column) -> DataFrame:
    """What the findings need of a side: the anomaly of each row in place of the hashes, keys only of rows that can meet."""
    kind = F.when(F.col(ERROR).isNotNull(), CORRUPTED).otherwise(sequence_kind(mode))
    return side.select(
        STREAM, SEQ, HEIGHT, "top", "nth", ERROR,
        F.when(meets, F.col("key")).alias("key"),
        kind.alias("kind"),
        F.col("prev.seq").alias("prev_seq"),
        F.col("prev.height").alias("prev_height"),
    )


def _reached(waits: DataFrame, other: DataFrame, at_least: bool, width: int | None) -> DataFrame:
    """For the heights ``top`` of ``waits`` the number of the row with which the other side gets there: ``reached``.

    A waits for a height at least as high as all of A before, B for one above all of B before.
    """
    waits = waits.where(F.col("top").isNotNull()).select(STREAM, F.col("top").alias("x")).distinct()
    records = other.where(meets_as_b()).select(STREAM, F.col(HEIGHT).alias("x"), "nth")
    # At equal height a record answers the wait of A but not that of B.
    rank = F.when(F.col("nth").isNull(), 0 if at_least else 1).otherwise(1 if at_least else 0)
    return with_prefix(
        waits.withColumn("nth", F.lit(None).cast("bigint")).unionByName(records).withColumn("rank", rank),
        [NextValid(F.col("nth"), "reached")],
        keys=[STREAM],
        order="x",
        tie=("rank",),
        width=width,
    ).where(F.col("nth").isNull()).select(STREAM, F.col("x").alias("top"), "reached")


def _with_step(found: DataFrame, reached: DataFrame, first_step: int, tag: str = "") -> DataFrame:
    """Add ``step``: the number of the fetch that reads the row, null if it is never read.

    The first rows are read at steps 1 and 2. A later row waits until the other side has reached a height.
    """
    top, nth = f"top{tag}", f"nth{tag}"
    step = F.when(F.col(nth) == 1, F.lit(first_step).cast("bigint")).otherwise(F.col(nth) + F.col("reached"))
    return found.join(reached.withColumnRenamed("top", top), [STREAM, top], "left").select(
        *[c for c in found.columns if c not in (top, nth)], step.alias(f"step{tag}")
    )


def _side_findings(side: DataFrame, name: str, mode: str | None = None) -> DataFrame:
    """The findings of one side, which is narrowed first if `mode` is given."""
    if mode is not None:
        side = _narrowed(side, mode, F.lit(False))
    return side.where(F.col("kind").isNotNull()).select(
        STREAM,
        F.lit(name).alias("side"),
        "kind",
        "prev_seq",
        "prev_height",
        SEQ,
        HEIGHT,
        F.when(F.col(ERROR).isNotNull(), 0).otherwise(1).alias("phase"),
        "top",
        "nth",
    )


def compare_findings(
    decoded_a: DataFrame,
    decoded_b: DataFrame,
    mode: str,
    *,
    key: Column | None = None,
    staging: Staging | None = None,
    width: int | None = DEFAULT_WIDTH,
    **skip_flags: bool,
) -> DataFrame:
    """All findings of both sides and of the comparison, in the order the merge makes them.

    Findings sort by ``step``, ``phase`` (corrupt rows, sequence anomalies, discrepancy) and ``seq``.
    Rows that the merge never reaches, because the other log ends before, give none. For a
    discrepancy ``prev_seq`` is the row of A and ``seq`` the row of B.
    """
    staging = staging or Staging(decoded_a.sparkSession)
    a, b = (
        staging.table(_narrowed(prepare_side(side, key, width=width), mode, meets), f"side-{name}")
        for side, meets, name in ((decoded_a, meets_as_a(), "a"), (decoded_b, meets_as_b(), "b"))
    )
    pairs = _meeting(a, b).where(F.col("key_a") != F.col("key_b"))
    pairs = staging.table(pairs.drop("key_a", "key_b"), "unequal")
    own_a, own_b = _side_findings(a, A), _side_findings(b, B)

    # Only rows with a finding need their step.
    def waits(own: DataFrame, tag: str) -> DataFrame:
        return own.select(STREAM, "top").unionByName(pairs.select(STREAM, F.col(f"top_{tag}").alias("top")))

    to_a = staging.table(_reached(waits(own_a, "a"), b, True, width), "reached-by-b")
    to_b = staging.table(_reached(waits(own_b, "b"), a, False, width), "reached-by-a")
    unequal = _with_step(_with_step(pairs, to_a, 1, "_a"), to_b, 2, "_b").select(
        STREAM,
        F.lit(BOTH).alias("side"),
        F.lit(DISCREPANCY).alias("kind"),
        F.col("seq_a").alias("prev_seq"),
        F.col(HEIGHT).alias("prev_height"),
        F.col("seq_b").alias(SEQ),
        HEIGHT,
        (F.when(F.col("step_a").isNotNull() & F.col("step_b").isNotNull(),
                F.greatest("step_a", "step_b"))).alias("step"),
        F.lit(2).alias("phase"),
    )
    findings = (
        _with_step(own_a, to_a, 1)
        .unionByName(_with_step(own_b, to_b, 2))
        .unionByName(unequal)
        .where(F.col("step").isNotNull())
        .select(*FINDING_COLUMNS)
    )
    return mark_fatal(findings, **skip_flags)


def until_first_fatal(findings: DataFrame) -> DataFrame:
    """The findings a comparison prints before it ends: up to the first fatal one of each log."""
    at = F.struct("step", "phase", SEQ)
    halts = findings.where("fatal").groupBy(STREAM).agg(F.min(at).alias("halt"))
    return findings.join(halts, STREAM, "left").where(
        F.col("halt").isNull() | (at <= F.col("halt"))
    ).drop("halt")
