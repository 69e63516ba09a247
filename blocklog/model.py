"""Column names, schemas and fixed values shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

STREAM, SEQ, TS, HEADERS, PAYLOAD = "stream_id", "seq", "ts", "headers", "payload"
HEIGHT, HASH, PREV_HASH, ERROR = "height", "hash", "prev_hash", "error"

HEADERS_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(STREAM, T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField(SEQ, T.LongType()),
        T.StructField(TS, T.TimestampType()),
        T.StructField(HEADERS, HEADERS_TYPE),
        T.StructField(PAYLOAD, T.BinaryType()),
    ]
)

BACKUP_SCHEMA = T.StructType(
    [
        T.StructField(STREAM, T.StringType()),
        T.StructField(SEQ, T.LongType()),
        T.StructField("unix_nano", T.LongType()),
        T.StructField(HEADERS, HEADERS_TYPE),
        T.StructField(PAYLOAD, T.BinaryType()),
    ]
)

# Fixed values of the message format.
MSG_ID_HEADER = "Nats-Msg-Id"
EXPECTED_LAST_MSG_ID_HEADER = "Nats-Expected-Last-Msg-Id"
EXPECTED_LAST_SEQ_HEADER = "Nats-Expected-Last-Sequence"
EXPECTED_STREAM_HEADER = "Nats-Expected-Stream"
UINT64_MAX = 18446744073709551615
#: Heights are unsigned 64-bit values; jobs carry them in this type.
HEIGHT_TYPE = "decimal(20,0)"
ENVELOPE_VERSION = "01"
NESTED_PATHS = {
    HASH: "block.header.hash",
    PREV_HASH: "block.header.prev_hash",
    HEIGHT: "block.header.height",
}
FLAT_PATHS = {HASH: "hash", PREV_HASH: "parent_hash", HEIGHT: "height"}

# Outcomes of the write gate.
ACCEPTED, LOW_HEIGHT, HASH_MISMATCH = "ACCEPTED", "LOW_HEIGHT", "HASH_MISMATCH"
CORRUPT, LOW_SEQ = "CORRUPT", "LOW_SEQ"
