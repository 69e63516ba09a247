"""The binary envelope in front of a payload.

After the version byte comes an array of five items (type, sequential id, seconds, milliseconds, 16-byte
id), each with a one-byte head that holds a small number or the length of the number behind it. All of
it is read with column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.functions.decode import envelope_error
from blocklog.model import PAYLOAD

UNSIGNED, BYTES, ARRAY = 0, 2, 4

# Items of the envelope and the largest value each may hold.
FIELDS = {"type": 2**16 - 1, "sequential_id": 2**64 - 1, "ts_s": 2**32 - 1, "ts_ms": 2**16 - 1}
ID_LENGTH = 16


def _unsigned(data: Column, at: Column, length: Column) -> Column:
    """Big-endian bytes as a number."""
    return F.conv(F.hex(F.substring(data, at, length)), 16, 10).try_cast("decimal(20,0)")


def _read_head(df: DataFrame, data: str, at: str, major: int, value: str) -> DataFrame:
    """Read the head at position ``at``: adds ``value`` (null if it is of another kind or cut off) and
    moves ``at`` behind it."""
    byte = F.conv(F.hex(F.substring(F.col(data), F.col(at), F.lit(1))), 16, 10)
    first = df.withColumn("__byte", byte.try_cast("int"))
    info = F.col("__byte") % 32
    size = (
        F.when(info < 24, 0).when(info == 24, 1).when(info == 25, 2).when(info == 26, 4)
        .when(info == 27, 8)
    )
    sized = first.withColumn("__size", size)
    whole = F.octet_length(data) >= F.col(at) + F.col("__size")
    number = F.when(F.col("__size") == 0, info.cast("decimal(20,0)")).otherwise(
        _unsigned(F.col(data), F.col(at) + 1, F.col("__size"))
    )
    fits = whole & (F.floor(F.col("__byte") / 32) == major)
    return (
        sized.withColumn(value, F.when(fits, number))
        .withColumn(at, F.col(at) + 1 + F.col("__size"))
        .drop("__byte", "__size")
    )


def unwrapped(df: DataFrame, payload: str = PAYLOAD) -> DataFrame:
    """Messages with what stands behind their envelope as payload, and ``envelope_error``.

    Two copies of a chain differ in every envelope (it holds a time and an id), so logs are compared without.
    """
    rows = df.drop("envelope_error")
    kept = [c for c in rows.columns if c != payload]
    out = with_envelope(rows, payload)
    # Through a generator, as in the decoders: otherwise each use of the payload would read the envelope again.
    fields = F.struct(F.col("body").alias(payload), "envelope_error")
    return out.select(*kept, F.inline(F.array(fields)))


def with_envelope(df: DataFrame, payload: str = PAYLOAD) -> DataFrame:
    """Add ``envelope`` (struct), ``body`` (the bytes behind it) and ``envelope_error``."""
    data, at = "__data", "__at"
    out = df.withColumn(data, F.col(payload).cast("binary")).withColumn(at, F.lit(2))
    out = _read_head(out, data, at, ARRAY, "__items")
    for name in FIELDS:
        out = _read_head(out, data, at, UNSIGNED, f"__{name}")
    out = _read_head(out, data, at, BYTES, "__id")
    sound = (F.col("__items") == len(FIELDS) + 1) & (F.col("__id") == ID_LENGTH) & (
        F.octet_length(data) >= F.col(at) + ID_LENGTH - 1
    )
    for name, largest in FIELDS.items():
        sound = sound & (F.col(f"__{name}") <= F.lit(str(largest)).cast("decimal(20,0)"))
    error = F.coalesce(
        envelope_error(F.col(data)),
        F.when(~F.coalesce(sound, F.lit(False)), "bad_envelope"),
    )
    out = out.withColumn("envelope_error", error)
    ok = F.col("envelope_error").isNull()
    fields = F.struct(
        F.col("__type").cast("int").alias("type"),
        F.col("__sequential_id").alias("sequential_id"),
        F.col("__ts_s").cast("bigint").alias("ts_s"),
        F.col("__ts_ms").cast("int").alias("ts_ms"),
        F.substring(F.col(data), F.col(at), F.lit(ID_LENGTH)).alias("unique_id"),
    )
    rest = F.substring(F.col(data), F.col(at) + ID_LENGTH, F.octet_length(data))
    return out.select(
        *df.columns,
        F.when(ok, fields).alias("envelope"),
        F.when(ok, rest).alias("body"),
        "envelope_error",
    )
