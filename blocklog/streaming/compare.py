"""Comparison of two logs that both keep growing.

Per log the state has, for each side, the last decoded row and the greatest height, and the rows that
may still meet a row of the other side: rows of A above all of B so far, and rows of B not below all of
A so far. Everything else has met its partner or can never meet one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklog.functions.decode import decode_unsigned, payload_key, with_envelope_error
from blocklog.functions.envelope import unwrapped
from blocklog.model import ERROR, HASH, HEIGHT, HEIGHT_TYPE, PAYLOAD, PREV_HASH, SEQ, STREAM
from blocklog.operators import audit, compare
from blocklog.operators.prefix import DEFAULT_WIDTH
from blocklog.plans.verified import OutOfOrder
from blocklog.session import Staging
from blocklog.sources.commits import AlreadyCommitted, CommitLog, signature

SIDE = "side"


@dataclass
class IncrementalCompare:
    """Findings and state of an endless comparison, one folder per batch."""

    spark: SparkSession
    path: str
    mode: str
    stream_type: T.DataType
    width: int = DEFAULT_WIDTH
    on_disorder: str = "fail"
    #: The payloads have an envelope, which is checked and then left out of the comparison.
    envelope: bool = False
    #: A log ends with the batch of its first finding that no flag excuses; its later messages are not read.
    halt: bool = False
    skip_flags: dict[str, bool] = field(default_factory=dict)

    def __post_init__(self):
        if self.on_disorder not in ("fail", "skip"):
            raise ValueError("on_disorder should be fail or skip")
        self.commits = CommitLog(self.spark, self.path)

    def _schema(self, part: str) -> T.StructType:
        names = {
            "marks": f"{SIDE} string, {SEQ} bigint, {HEIGHT} {HEIGHT_TYPE}, {HASH} string, key string, top {HEIGHT_TYPE}",
            "open": f"{SIDE} string, {SEQ} bigint, {HEIGHT} {HEIGHT_TYPE}, key string",
        }
        rest = T.StructType.fromDDL(names[part])
        return T.StructType([T.StructField(STREAM, self.stream_type), *rest.fields])

    def _read(self, part: str, before: int) -> DataFrame:
        schema = self._schema(part)
        newest = self.commits.newest(before)
        return self.spark.createDataFrame([], schema) if newest is None else self.commits.table(part, newest, schema)

    def findings(self) -> DataFrame:
        """Findings of the committed batches; ``fatal`` where no flag excuses one."""
        return self.commits.tables("findings")

    def halted(self, before: int | None = None) -> DataFrame:
        """Logs that have ended and the batch in which they did: STREAM, ended."""
        kind = self.stream_type.simpleString()
        schema = f"{STREAM} {kind}, ended bigint"
        newest = self.commits.newest(before)
        return self.spark.createDataFrame([], schema) if newest is None else self.commits.table("halted", newest, schema)

    def __call__(self, rows: DataFrame, batch: int) -> None:
        """Process a batch of messages of both sides (column ``side``: A or B).

        A batch that goes back behind the last decoded row of a side fails, or with ``on_disorder`` of
        ``skip`` goes on without the rows before it.
        """
        read = signature(rows, STREAM, SIDE, SEQ)
        if batch in self.commits.batches():
            if self.commits.note(batch) != {"read": read}:
                raise AlreadyCommitted(f"batch {batch} is one of other messages")
            return  # repeated by the stream
        staging = Staging(self.spark)
        marks = staging.table(self._read("marks", batch), "marks")
        open_rows = staging.table(self._read("open", batch), "open")
        halted = staging.table(self.halted(batch), "halted")
        if self.halt:
            rows = rows.join(halted, STREAM, "left_anti")
        rows = self._in_order(rows, marks)
        if self.envelope:
            rows = unwrapped(rows)
        decoded = decode_unsigned(rows, self.mode).withColumn("key", payload_key(F.col(PAYLOAD)))
        if self.envelope:
            decoded = with_envelope_error(decoded)
        sides = {
            name: staging.table(self._side(decoded, marks, name), f"side-{name}")
            for name in (compare.A, compare.B)
        }

        candidates = {
            name: sides[name].where(eligible).select(STREAM, SEQ, HEIGHT, "key").unionByName(
                open_rows.where(F.col(SIDE) == name).drop(SIDE)
            )
            for name, eligible in (
                (compare.A, compare.meets_as_a()), (compare.B, compare.meets_as_b())
            )
        }
        new_marks = staging.table(self._marks(sides, marks), "new-marks")

        unequal = (
            candidates[compare.A].select(
                STREAM, HEIGHT, F.col(SEQ).alias("prev_seq"), F.col("key").alias("other")
            )
            .join(candidates[compare.B], [STREAM, HEIGHT])
            .where(F.col("key") != F.col("other"))
            .select(
                STREAM, F.lit(compare.BOTH).alias(SIDE), F.lit(audit.DISCREPANCY).alias("kind"),
                "prev_seq", F.col(HEIGHT).alias("prev_height"), SEQ, HEIGHT,
            )
        )
        found = unequal
        for name, side in sides.items():
            kind = F.when(F.col(ERROR).isNotNull(), audit.CORRUPTED).otherwise(
                audit.sequence_kind(self.mode)
            )
            found = found.unionByName(
                side.select(
                    STREAM, F.lit(name).alias(SIDE), kind.alias("kind"),
                    F.col("prev.seq").alias("prev_seq"), F.col("prev.height").alias("prev_height"),
                    SEQ, HEIGHT,
                ).where(F.col("kind").isNotNull())
            )

        still = None
        for name, other in ((compare.A, compare.B), (compare.B, compare.A)):
            top = new_marks.where(F.col(SIDE) == other).select(STREAM, F.col("top").alias("reached"))
            ahead = F.col(HEIGHT) > F.col("reached") if name == compare.A else (
                F.col(HEIGHT) >= F.col("reached")
            )
            part = (
                candidates[name].join(top, STREAM, "left")
                .where(F.col("reached").isNull() | ahead)
                .select(STREAM, F.lit(name).alias(SIDE), SEQ, HEIGHT, "key")
            )
            still = part if still is None else still.unionByName(part)

        found = staging.table(audit.mark_fatal(found, **self.skip_flags), "found")
        ended = found.where("fatal").select(STREAM).distinct().withColumn("ended", F.lit(batch).cast("bigint"))
        if not self.halt:
            ended = ended.limit(0)
        attempt = self.commits.attempt(batch)
        for part, table in (("findings", found), ("open", still), ("marks", new_marks), ("halted", halted.unionByName(ended))):
            attempt.write(part, table)
        attempt.commit({"read": read})
        staging.drop()

    def _in_order(self, rows: DataFrame, marks: DataFrame) -> DataFrame:
        last = marks.select(STREAM, SIDE, F.col(SEQ).alias("last_seq"))
        if self.on_disorder == "skip":
            joined = rows.join(last, [STREAM, SIDE], "left")
            fine = F.col("last_seq").isNull() | (F.col(SEQ) > F.col("last_seq"))
            return joined.where(fine).select(*rows.columns)
        first = rows.groupBy(STREAM, SIDE).agg(F.min(SEQ).alias("first"))
        behind = first.join(last, [STREAM, SIDE]).where(F.col("first") <= F.col("last_seq")).first()
        if behind is not None:
            raise OutOfOrder(f"log {behind[STREAM]}, side {behind[SIDE]}: sequence {behind['first']} after {behind['last_seq']}")
        return rows

    def _side(self, decoded: DataFrame, marks: DataFrame, name: str) -> DataFrame:
        """New rows of one side with what they need of the rows before, old ones included.

        Two virtual rows stand for the past: one as high as the greatest height, then the last row.
        """
        columns = [STREAM, SEQ, "p", HEIGHT, HASH, PREV_HASH, "key", ERROR]
        rows = decoded.where(F.col(SIDE) == name).withColumn("p", F.col(SEQ)).select(*columns)
        past = marks.where(F.col(SIDE) == name).withColumns(
            {PREV_HASH: F.lit(""), ERROR: F.lit(None).cast("string")}
        )
        highest = past.withColumn(HEIGHT, F.col("top")).withColumn("p", F.lit(-2).cast("bigint"))
        last = past.withColumn("p", F.lit(-1).cast("bigint"))
        both = rows.unionByName(highest.select(*columns)).unionByName(last.select(*columns))
        prepared = compare.prepare_side(both, F.col("key"), order="p", width=self.width)
        return prepared.where(F.col("p") >= 0).drop("p")

    def _marks(self, sides: dict[str, DataFrame], marks: DataFrame) -> DataFrame:
        out = marks.withColumn("age", F.lit(0))
        for name, side in sides.items():
            ok = side.where(F.col(ERROR).isNull())
            out = out.unionByName(
                ok.groupBy(STREAM).agg(
                    F.max_by(F.struct(SEQ, HEIGHT, HASH, "key"), SEQ).alias("x"),
                    F.max(HEIGHT).alias("top"),
                ).select(
                    STREAM, F.lit(name).alias(SIDE), "x.*", "top", F.lit(1).alias("age")
                )
            )
        return out.groupBy(STREAM, SIDE).agg(
            F.max_by(F.struct(SEQ, HEIGHT, HASH, "key"), "age").alias("x"), F.max("top").alias("top")
        ).select(STREAM, SIDE, "x.*", "top")
