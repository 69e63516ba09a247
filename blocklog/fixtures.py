"""Block logs derived from the events, documents and pages tables, for queries, tests and benchmark.

Each log is written once per input version into the shared folder and then read as a table, which is
how the operators meet their input in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklog.model import HEADERS, MSG_ID_HEADER
from blocklog.operators.prefix import RunSum, with_prefix
from blocklog.session import Staging, child_names, file_version, write_parquet

_cache: dict[tuple, DataFrame] = {}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(df: DataFrame, name: str = "ts") -> Column:
    """A column as an instant; a timestamp without zone is taken as UTC in any session zone."""
    column = F.col(name)
    if df.schema[name].dataType.typeName() == "timestamp_ntz":
        column = F.convert_timezone(F.lit("UTC"), F.current_timezone(), column)
    return column.cast("timestamp")


def _stored(spark: SparkSession, sf_dir: str, source: str, name: str, build) -> DataFrame:
    key = (
        spark.sparkContext.applicationId,
        name,
        sf_dir,
        file_version(spark, f"{sf_dir}/{source}.parquet"),
    )
    if key not in _cache:
        _cache[key] = Staging(spark).table(build(spark, sf_dir), name)
    return _cache[key]


def block_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "block_log", build_block_log)


def compare_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "compare_log", build_compare_log)


def backup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "backup_log", build_backup_log)


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "full_log", build_full_log)


def valid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty log without the truncated payloads."""
    return _stored(
        spark, sf_dir, "events", "valid_log",
        lambda s, d: block_log(s, d).where(F.col("fault") != "corrupt"),
    )


def with_headers(df: DataFrame) -> DataFrame:
    """The message id as a header map."""
    return df.withColumn(
        HEADERS,
        F.create_map(F.lit(MSG_ID_HEADER), F.array(F.col("msg_id"))),
    )


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their position ``n`` within the user, counted in event order."""
    events = raw(spark, sf_dir, "events")
    events = events.select(
        F.col("user_id").alias("stream_id"), "event_id", instant(events).alias("ts")
    )
    return with_prefix(
        events, [RunSum(F.lit(1).cast("bigint"), "n")], keys=["stream_id"], order="event_id"
    )


def _text(value) -> Column:
    return value.cast("string")


def _chain_hash(height: Column) -> Column:
    return F.md5(F.concat(_text(F.col("stream_id")), F.lit(":"), _text(height)))


def _tagged_hash(tag: str, value: Column) -> Column:
    return F.md5(F.concat(F.lit(tag), _text(value)))


def _payload(hash_: Column, prev: Column, height: Column, tag: Column) -> Column:
    return F.concat(
        F.lit('{"block":{"header":{"hash":"'), hash_, F.lit('","prev_hash":"'), prev,
        F.lit('","height":'), _text(height), F.lit('}},"v":"'), tag, F.lit('"}'),
    )


def build_block_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain per user with lost, repeated, forked and truncated blocks."""
    e, n = F.col("event_id"), F.col("n")

    def row(sub: int, fault: str, when: Column, height: Column, hash_=None, prev=None) -> Column:
        fields = F.struct(
            F.lit(sub).alias("sub"),
            F.lit(fault).alias("fault"),
            height.alias("height"),
            (_chain_hash(height) if hash_ is None else hash_).alias("hash"),
            (_chain_hash(height - 1) if prev is None else prev).alias("prev_hash"),
        )
        return F.when(when, fields)

    fork = _tagged_hash("fork", e)
    rows = F.array_compact(
        F.array(
            row(0, "base", e % 997 != 31, n),
            row(1, "dup", e % 11 == 5, n),
            row(2, "replay", (e % 13 == 7) & (n > 4), n - 3),
            row(3, "fork", e % 17 == 3, n + 1, fork, _tagged_hash("x", e)),
            row(4, "linked_fork", e % 401 == 9, n + 1, fork, _chain_hash(n)),
            row(5, "unequal_dup", e % 19 == 2, n),
            row(6, "corrupt", e % 23 == 4, n + 1),
        )
    )
    x = _numbered(spark, sf_dir).select("stream_id", "event_id", "ts", F.inline(rows))
    shown = F.when(F.col("fault").isin("dup", "replay"), "base").otherwise(F.col("fault"))
    return x.select(
        "stream_id",
        (e * 8 + F.col("sub") + 1).alias("seq"),
        "ts",
        "height",
        "hash",
        "prev_hash",
        "fault",
        _text(F.when(e % 37 == 1, F.col("height") + 1).otherwise(F.col("height"))).alias("msg_id"),
        F.when(
            F.col("fault") == "corrupt",
            F.concat(F.lit('{"block":{"header":{"hash":"'), F.col("hash")),
        )
        .otherwise(_payload(F.col("hash"), F.col("prev_hash"), F.col("height"), shown))
        .alias("payload"),
    )


def build_compare_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean chain per user with missing blocks and changed payloads."""
    e, n = F.col("event_id"), F.col("n")
    x = _numbered(spark, sf_dir).where(e % 31 != 8).select(
        "stream_id",
        (e * 8 + 1).alias("seq"),
        n.alias("height"),
        _chain_hash(n).alias("hash"),
        _chain_hash(n - 1).alias("prev_hash"),
        F.when(e % 29 == 6, "changed").otherwise("base").alias("v"),
    )
    return x.select(
        "stream_id", "seq", "height", "hash", "prev_hash",
        _payload(F.col("hash"), F.col("prev_hash"), F.col("height"), F.col("v")).alias("payload"),
    )


def build_full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long log without holes."""
    e = F.col("event_id")
    events = raw(spark, sf_dir, "events")
    return events.select(
        F.lit(0).cast("bigint").alias("stream_id"),
        (e + 1).alias("seq"),
        instant(events).alias("ts"),
        F.floor(e / 1000).alias("chunk_id"),
        (e + 1).alias("height"),
        _tagged_hash("b", e).alias("hash"),
        _tagged_hash("b", e - 1).alias("prev_hash"),
        _text(e + 1).alias("msg_id"),
        F.col("props").alias("payload"),
    )


def build_backup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long log with holes, as a backup stored in chunks."""
    return build_full_log(spark, sf_dir).where((F.col("seq") - 1) % 97 >= 3)


#: Bytes of input that one task sorts into a file of messages.
FILE_BYTES = 16 << 20


def input_bytes(spark: SparkSession, df: DataFrame) -> int:
    """Size of the files that a table is read from."""
    return sum(file_version(spark, path)[1] for path in df.inputFiles())


def message_files(
    spark: SparkSession, log: DataFrame, name: str, files: int = 3, *, file_bytes: int = FILE_BYTES
) -> str:
    """The log as files by sequence range, a source for the streaming file reader.

    That reader takes files in order of their modification time, so the times are set in the order of
    the ranges. A file is written by one task, so a log of more than ``files`` times ``file_bytes`` is cut into a
    multiple of ``files``.
    """
    path = f"{Staging(spark).root}/{name}"
    files *= max(1, -(-input_bytes(spark, log) // (files * file_bytes)))
    write_parquet(log.repartitionByRange(files, "seq").sortWithinPartitions("seq"), path)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet")]
    first = jvm.java.lang.System.currentTimeMillis() - 1000 * (len(found) + 1)
    for i, file in enumerate(sorted(found, key=lambda p: p.getName())):
        fs.setTimes(file, first + 1000 * i, -1)
    return path


def files_of_batch(spark: SparkSession, path: str, batches: int = 3) -> int:
    """How many files of a folder of messages a micro-batch takes, so that there are so many batches at most."""
    return max(1, -(-sum(n.endswith(".parquet") for n in child_names(spark, path)) // batches))
