"""The registered queries: one per operator, over logs derived from the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklog import fixtures as fx
from blocklog.functions import decode as D
from blocklog.functions.envelope import with_envelope
from blocklog.functions.scalar import relative_seq
from blocklog.model import (
    CORRUPT, ERROR, EXPECTED_LAST_MSG_ID_HEADER, EXPECTED_LAST_SEQ_HEADER, EXPECTED_STREAM_HEADER,
    HASH, HASH_MISMATCH, HEADERS, HEIGHT, MSG_ID_HEADER, PAYLOAD, PREV_HASH, SEQ, STREAM,
)
from blocklog.operators import audit, compare, gate, resume, stats
from blocklog.plans import checks, transfer
from blocklog.plans.verified import CopyRules, VerifiedOutput, bridge_rules, restore_rules
from blocklog.session import Staging
from blocklog.functions.envelope import unwrapped
from blocklog.sources import backup, log, sinks
from blocklog.sources.chunk_index import ChunkIndex
from blocklog.streaming import jobs
from blocklog.streaming.compare import IncrementalCompare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty log as messages: headers and payload, nothing decoded."""
    return fx.with_headers(fx.block_log(spark, sf_dir)).select(STREAM, SEQ, "ts", HEADERS, PAYLOAD)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.decode_nested(_messages(spark, sf_dir))


def _narrow(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The decoded fields as a table, for operators that read them more than once."""
    return D.stage_decoded(_messages(spark, sf_dir), "nested", Staging(spark), **options)


def _narrow_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.compare_log(spark, sf_dir).select(STREAM, SEQ, PAYLOAD)
    return D.stage_decoded(rows, "nested", Staging(spark), with_key=True)


def _gated(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return gate.write_gate(_decoded(spark, sf_dir), **options)


def _bridge_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.wrong_runs(_gated(spark, sf_dir, dealt=True), F.col("label").isin(CORRUPT, HASH_MISMATCH))


def _end(spark: SparkSession, sf_dir: str) -> int:
    """End of the long log: one past its last sequence."""
    return fx.full_log(spark, sf_dir).agg(F.max(SEQ)).first()[0] + 1


# --- sources ------------------------------------------------------------------------------------


@query
def read_log_range(spark, sf_dir):
    rows = fx.backup_log(spark, sf_dir).where(log.seq_range(101, _end(spark, sf_dir)))
    return rows.select(STREAM, SEQ, HEIGHT, HASH, "msg_id")


@query
def ordered_scan(spark, sf_dir):
    return log.ordered_scan(fx.block_log(spark, sf_dir).select(STREAM, SEQ))


@query
def get_at(spark, sf_dir):
    return log.get_at(fx.backup_log(spark, sf_dir), 504).select(STREAM, SEQ, HEIGHT, HASH)


@query
def log_bounds(spark, sf_dir):
    return log.log_bounds(fx.block_log(spark, sf_dir))


@query
def chunk_ranges(spark, sf_dir):
    return backup.chunk_ranges(fx.backup_log(spark, sf_dir).drop(HEIGHT))


@query
def first_at_or_after(spark, sf_dir):
    rows = fx.block_log(spark, sf_dir).select(STREAM, SEQ, HEIGHT, HASH)
    return log.first_at_or_after(rows, 4000)


# --- decoding -----------------------------------------------------------------------------------


@query
def decode_unverified(spark, sf_dir):
    return D.decode_unverified(_messages(spark, sf_dir)).select(STREAM, SEQ, HEIGHT, ERROR)


@query
def decode_nested(spark, sf_dir):
    return _decoded(spark, sf_dir).select(STREAM, SEQ, HEIGHT, HASH, PREV_HASH, ERROR)


@query
def decode_flat(spark, sf_dir):
    rows = fx.block_log(spark, sf_dir)
    whole = F.concat(
        F.lit('{"hash":"'), HASH, F.lit('","parent_hash":"'), PREV_HASH, F.lit('","height":'),
        F.col(HEIGHT).cast("string"), F.lit("}"),
    )
    flat = F.when(F.try_parse_json(PAYLOAD).isNotNull(), whole).otherwise(
        F.concat(F.lit('{"hash":"'), HASH)
    )
    decoded = D.decode_flat(rows.select(STREAM, SEQ, flat.alias(PAYLOAD)))
    return decoded.select(STREAM, SEQ, HEIGHT, HASH, PREV_HASH, ERROR)


@query
def decode_simple(spark, sf_dir):
    rows = D.decode(_messages(spark, sf_dir), "simple")
    return rows.select(STREAM, SEQ, HEIGHT, HASH, PREV_HASH, ERROR)


@query
def quarantine(spark, sf_dir):
    return D.corrupt_rows(_decoded(spark, sf_dir)).select(STREAM, SEQ, ERROR)


@query
def message_id_check(spark, sf_dir):
    rows = D.decoded_rows(_decoded(spark, sf_dir))
    problem = D.message_id_error(F.col(HEADERS), F.col(HEIGHT))
    return rows.select(STREAM, SEQ, problem.alias(ERROR)).where(F.col(ERROR).isNotNull())


@query
def envelope_check(spark, sf_dir):
    data = (
        F.when(F.col(SEQ) % 5 == 0, F.col(PAYLOAD))
        .when(F.col(SEQ) % 7 == 0, "")
        .otherwise(F.concat(F.char(F.lit(1)), PAYLOAD))
    )
    return fx.block_log(spark, sf_dir).select(
        STREAM, SEQ, D.envelope_error(data.cast("binary")).alias(ERROR)
    )


@query
def envelope_fields(spark, sf_dir):
    def big_endian(value, digits: int):
        return F.lpad(F.hex(value), digits, "0")

    head = F.concat(
        F.lit("0185"), big_endian(F.col(SEQ) % 24, 2),
        F.lit("1b"), big_endian(F.col(SEQ), 16),
        F.lit("1a"), big_endian(F.unix_seconds("ts"), 8),
        F.lit("19"), big_endian(F.col(SEQ) % 1000, 4),
        F.lit("50"), F.md5(PAYLOAD),
    )
    rows = fx.block_log(spark, sf_dir).select(
        STREAM, SEQ, F.concat(F.unhex(head), F.col(PAYLOAD).cast("binary")).alias(PAYLOAD)
    )
    found = with_envelope(rows)
    return found.select(
        STREAM, SEQ, "envelope.type", F.col("envelope.sequential_id").cast("bigint").alias("sequential_id"),
        "envelope.ts_s", "envelope.ts_ms", F.lower(F.hex("envelope.unique_id")).alias("unique_id"),
        F.col("body").cast("string").alias("body"), "envelope_error",
    )


@query
def headers_roundtrip(spark, sf_dir):
    stored = _messages(spark, sf_dir).withColumn("entries", D.headers_out(F.col(HEADERS)))
    headers = D.headers_in(F.col("entries"))
    return stored.select(
        STREAM, SEQ, D.first_header(headers, MSG_ID_HEADER).alias("first_value"),
        F.size(headers).alias("n"),
    )


@query
def relative_seq_(spark, sf_dir):
    rows = fx.backup_log(spark, sf_dir)
    return rows.select(STREAM, SEQ, relative_seq(F.col(SEQ), 98).alias("relative_seq"))


QUERIES["relative_seq"] = QUERIES.pop("relative_seq_")


@query
def payload_sizes(spark, sf_dir):
    return fx.raw(spark, sf_dir, "pages").select(
        "page_id", F.octet_length("url").alias("packed"), F.octet_length("html").alias("unpacked")
    )


# --- audits -------------------------------------------------------------------------------------


@query
def seq_gaps(spark, sf_dir):
    return audit.seq_gaps(fx.backup_log(spark, sf_dir))


@query
def absent_ranges(spark, sf_dir):
    return audit.absent_ranges(fx.backup_log(spark, sf_dir), 1, _end(spark, sf_dir))


@query
def leftmost_absent(spark, sf_dir):
    return audit.leftmost_absent_range(absent_ranges(spark, sf_dir))


@query
def segments(spark, sf_dir):
    return audit.segments(fx.backup_log(spark, sf_dir))


@query
def link_check(spark, sf_dir):
    return audit.link_check(_narrow(spark, sf_dir))


@query
def height_check(spark, sf_dir):
    return audit.height_check(_narrow(spark, sf_dir))


def _anomalies(spark: SparkSession, sf_dir: str, mode: str, *kinds: str) -> DataFrame:
    found = audit.sequence_findings(_narrow(spark, sf_dir, with_key=True), mode, F.col("key"))
    return found.where(F.col("kind").isin(*kinds))


@query
def audit_downjump(spark, sf_dir):
    return _anomalies(spark, sf_dir, "nested", audit.DOWNJUMP)


@query
def audit_duplicate(spark, sf_dir):
    return _anomalies(spark, sf_dir, "nested", audit.DUPLICATE, audit.UNEQUAL_DUPLICATE)


@query
def audit_height_gap(spark, sf_dir):
    return _anomalies(spark, sf_dir, "nested", audit.GAP)


@query
def audit_height_gap_flat(spark, sf_dir):
    return _anomalies(spark, sf_dir, "flat", audit.GAP)


@query
def validation_report(spark, sf_dir):
    return audit.validation_report(audit.validation_findings(_narrow(spark, sf_dir, with_headers=True)))


@query
def first_failure(spark, sf_dir):
    return audit.first_failure(audit.validation_findings(_narrow(spark, sf_dir, with_headers=True)))


# --- gate ---------------------------------------------------------------------------------------


@query
def write_gate(spark, sf_dir):
    return _gated(spark, sf_dir).select(STREAM, SEQ, HEIGHT, "label", "out_seq")


@query
def gate_with_tip(spark, sf_dir):
    decoded = _narrow(spark, sf_dir)
    tips = decoded.where(F.col(ERROR).isNull()).select(STREAM).distinct().select(
        STREAM,
        F.lit(100).cast("bigint").alias("out_seq"),
        F.lit(10).cast("bigint").alias(HEIGHT),
        F.md5(F.concat(F.col(STREAM).cast("string"), F.lit(":10"))).alias(HASH),
    )
    return gate.write_gate(decoded, tips).where("label = 'ACCEPTED'").select(STREAM, SEQ, "out_seq")


@query
def record_gate(spark, sf_dir):
    rows = gate.record_gate(D.decode_unverified(_messages(spark, sf_dir)))
    return rows.where("label = 'ACCEPTED'").select(STREAM, SEQ, HEIGHT)


@query
def strict_sequence(spark, sf_dir):
    arrivals = fx.block_log(spark, sf_dir).select(
        STREAM, F.col(SEQ).alias("arrival"), F.col(HEIGHT).alias(SEQ)
    )
    kept = gate.strict_sequence(arrivals, arrival="arrival", start=1)
    return kept.where("kept").select(STREAM, "arrival", SEQ)


@query
def successor(spark, sf_dir):
    rows = D.decoded_rows(_narrow(spark, sf_dir))
    return gate.successor(rows, rows)


@query
def wrong_runs(spark, sf_dir):
    return _bridge_runs(spark, sf_dir).where("run > 0").select(STREAM, SEQ, "run")


@query
def tolerance_reach(spark, sf_dir):
    return gate.tolerance_cutoff(_bridge_runs(spark, sf_dir), 3, "reach")


@query
def tolerance_exceed(spark, sf_dir):
    runs = gate.wrong_runs(_gated(spark, sf_dir, dealt=True), F.col("label") == HASH_MISMATCH)
    return gate.tolerance_cutoff(runs, 1, "exceed")


@query
def tip_asof_row(spark, sf_dir):
    return _gated(spark, sf_dir).select(STREAM, SEQ, "tip_out_seq", "tip_height", "tip_hash")


@query
def assign_output_seq(spark, sf_dir):
    return _gated(spark, sf_dir).where("out_seq is not null").select(STREAM, SEQ, "out_seq")


@query
def output_headers(spark, sf_dir):
    name = F.concat(F.lit("chain-"), F.col(STREAM).cast("string"))
    rows = _gated(spark, sf_dir).where("label = 'ACCEPTED'").withColumn(
        HEADERS, gate.output_headers(name)
    )
    return rows.select(
        STREAM,
        SEQ,
        *[
            D.first_header(F.col(HEADERS), header).alias(column)
            for header, column in (
                (MSG_ID_HEADER, "msg_id"),
                (EXPECTED_LAST_MSG_ID_HEADER, "last_msg_id"),
                (EXPECTED_LAST_SEQ_HEADER, "last_seq"),
                (EXPECTED_STREAM_HEADER, "stream_name"),
            )
        ],
    )


# --- comparison ---------------------------------------------------------------------------------


@query
def compare_by_height(spark, sf_dir):
    return compare.compare_by_height(
        compare.prepare_side(_narrow(spark, sf_dir, with_key=True), F.col("key")),
        compare.prepare_side(_narrow_other(spark, sf_dir), F.col("key")),
    )


@query
def compare_findings(spark, sf_dir):
    found = compare.compare_findings(
        _narrow(spark, sf_dir, with_key=True), _narrow_other(spark, sf_dir), "nested",
        key=F.col("key"),
    )
    return found.drop("phase", "fatal")


@query
def compare_until_fatal(spark, sf_dir):
    found = compare.compare_findings(
        _narrow(spark, sf_dir, with_key=True), _narrow_other(spark, sf_dir), "nested",
        key=F.col("key"), skip_duplicates=True, skip_gaps=True, skip_corrupted=True,
    )
    return compare.until_first_fatal(found).select(STREAM, "side", "kind", SEQ)


@query
def compare_by_relative_seq(spark, sf_dir):
    rows = fx.backup_log(spark, sf_dir)
    return compare.compare_by_relative_seq(rows, rows, 1, 98)


# --- transfer -----------------------------------------------------------------------------------


@query
def resume_seq(spark, sf_dir):
    tips = fx.compare_log(spark, sf_dir).groupBy(STREAM).agg(
        F.expr("max(height) div 2").alias(HEIGHT)
    )
    return resume.resume_seq(_decoded(spark, sf_dir), tips, start=500)


@query
def resume_chunk(spark, sf_dir):
    rows = fx.backup_log(spark, sf_dir)
    tips = rows.groupBy(STREAM).agg(F.expr("max(height) div 2 + 7").alias(HEIGHT))
    end = rows.agg(F.max(SEQ)).first()[0]
    return resume.resume_chunk(backup.chunk_ranges(rows), tips, 150, end)


@query
def backfill(spark, sf_dir):
    rows = resume.backfill(
        fx.full_log(spark, sf_dir), fx.backup_log(spark, sf_dir), 1, _end(spark, sf_dir)
    )
    return rows.select(STREAM, SEQ, HASH)


@query
def seam_check(spark, sf_dir):
    stored = fx.backup_log(spark, sf_dir)
    broken = F.when(F.col(SEQ) % 4 == 1, F.md5(F.lit("x"))).otherwise(F.col(PREV_HASH))
    fetched = fx.full_log(spark, sf_dir).withColumn(PREV_HASH, broken)
    return audit.seam_check(absent_ranges(spark, sf_dir), fetched, stored, 1)


@query
def write_backup_chunks(spark, sf_dir):
    rows = fx.backup_log(spark, sf_dir).drop("chunk_id")
    chunked = backup.assign_chunks(rows, max_entries=700, max_bytes=5000)
    return chunked.groupBy(STREAM, "chunk_id").agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(PAYLOAD).cast("bigint")).alias("bytes"),
        F.min(SEQ).alias("l"),
        F.max(SEQ).alias("r"),
    )


# --- statistics ---------------------------------------------------------------------------------


@query
def sync_counters(spark, sf_dir):
    return stats.sync_counters(_gated(spark, sf_dir))


@query
def sync_gauges(spark, sf_dir):
    return stats.sync_gauges(_bridge_runs(spark, sf_dir), tolerance=3)


@query
def sync_status(spark, sf_dir):
    return stats.sync_status(sync_gauges(spark, sf_dir))


@query
def progress(spark, sf_dir):
    return stats.progress(D.decoded_rows(_decoded(spark, sf_dir)))


def _document_sizes(spark: SparkSession, sf_dir: str, kb: int) -> DataFrame:
    rows = fx.raw(spark, sf_dir, "documents")
    return stats.size_distribution(rows, F.col("source"), F.col("text"), kb)


@query
def size_distribution(spark, sf_dir):
    return _document_sizes(spark, sf_dir, 64)


@query
def size_distribution_1kb(spark, sf_dir):
    return _document_sizes(spark, sf_dir, 1)


@query
def merge_distribution(spark, sf_dir):
    pages = fx.raw(spark, sf_dir, "pages")
    return stats.merge_distribution(
        _document_sizes(spark, sf_dir, 1),
        stats.size_distribution(pages, F.col("url"), F.col("html"), 1),
    )


@query
def oversize(spark, sf_dir):
    rows = sinks.oversize(fx.raw(spark, sf_dir, "documents"), F.col("text"), 0.01)
    return rows.select("doc_id", F.octet_length("text").alias("size"))


@query
def hist_linear(spark, sf_dir):
    rows = fx.raw(spark, sf_dir, "documents")
    return stats.hist_linear(rows, F.col("n_chars"), 0, 20000, 10).select("bound_no", "n")


@query
def hist_exponential(spark, sf_dir):
    rows = fx.raw(spark, sf_dir, "documents")
    return stats.hist_exponential(rows, F.col("n_chars"), 1, 65536, 9).select("bound_no", "n")


@query
def throughput(spark, sf_dir):
    rows = stats.throughput(fx.backup_log(spark, sf_dir))
    return rows.select(STREAM, F.unix_seconds("window_start").alias("window_start"), "n")


# --- whole jobs ---------------------------------------------------------------------------------


#: Moves the tenth block of a log to height 2^63.
UNSIGNED_SHIFT = "9223372036854775798"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{Staging(spark).root}/{name}"


def _output(spark: SparkSession, messages: DataFrame) -> VerifiedOutput:
    return VerifiedOutput(spark, _folder(spark, "output"), messages.schema[STREAM].dataType)


def _bridge_rules() -> CopyRules:
    return bridge_rules(mode="nested", tolerance=2, on_tolerance="stop")


def _written(output: VerifiedOutput) -> DataFrame:
    """Heights of these logs are small; jobs carry them as unsigned."""
    return output.rows().select(STREAM, "out_seq", F.col(HEIGHT).cast("bigint").alias(HEIGHT), HASH)


def _copied(output: VerifiedOutput) -> DataFrame:
    return output.rows().select(
        STREAM, "out_seq", F.col(HEIGHT).cast("bigint").alias(HEIGHT), HASH,
        D.first_header(F.col(HEADERS), MSG_ID_HEADER).alias("msg_id"),
    )


def _stream(spark: SparkSession, log_: DataFrame, name: str) -> DataFrame:
    path = fx.message_files(spark, log_, name)
    return log.read_log_stream(spark, path, log_.schema, max_files_per_trigger=fx.files_of_batch(spark, path))


@query
def bridge_batch(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    output = _output(spark, messages)
    transfer.bridge(messages, output, _bridge_rules())
    return _copied(output)


@query
def bridge_unsigned(spark, sf_dir):
    """A copy of logs whose heights cross 2^63, cut in the middle and started again."""
    shifted = (F.col(HEIGHT).cast("decimal(20,0)") + F.lit(UNSIGNED_SHIFT).cast("decimal(20,0)")).cast("decimal(20,0)")
    block = F.concat(
        F.lit('{"block":{"header":{"hash":"'), HASH, F.lit('","prev_hash":"'), PREV_HASH, F.lit('","height":'),
        shifted.cast("string"), F.lit("}}}"),
    )
    rows = fx.with_headers(fx.block_log(spark, sf_dir))
    messages = rows.withColumn(PAYLOAD, F.when(F.col("fault") == "corrupt", F.lit("{")).otherwise(block))
    messages = Staging(spark).table(messages.select(STREAM, SEQ, HEADERS, PAYLOAD), "messages")
    output = _output(spark, messages)
    rules = bridge_rules(mode="nested", tolerance=10**9)
    middle = messages.agg(F.expr(f"(min({SEQ}) + max({SEQ})) div 2")).first()[0]
    transfer.bridge(messages.where(F.col(SEQ) < middle), output, rules)
    transfer.bridge(messages, output, rules)
    return output.rows().select(STREAM, "out_seq", F.col(HEIGHT).cast("string").alias("height_text"), HASH)


@query
def bridge_restart(spark, sf_dir):
    """A copy that is cut in the middle of each log and started again must end like one in one go."""
    messages = _messages(spark, sf_dir)
    output = _output(spark, messages)
    rules = bridge_rules(mode="nested", tolerance=10**9)
    middle = messages.agg(F.expr(f"(min({SEQ}) + max({SEQ})) div 2")).first()[0]
    transfer.bridge(messages.where(F.col(SEQ) < middle), output, rules)
    transfer.bridge(messages, output, rules)
    return _written(output)


@query
def bridge_stream(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    output = _output(spark, messages)
    rows = _stream(spark, messages, "messages")
    jobs.bridge_stream(rows, output, _bridge_rules(), _folder(spark, "offsets")).awaitTermination()
    return _copied(output)


@query
def sync_metrics_stream(spark, sf_dir):
    """Totals of the live counters of a copy in several batches."""
    messages = _messages(spark, sf_dir)
    metrics, rules = jobs.SyncMetrics(), bridge_rules(mode="nested", tolerance=10**9)
    jobs.bridge_stream(
        _stream(spark, messages, "messages"), _output(spark, messages), rules, _folder(spark, "offsets"), metrics=metrics
    ).awaitTermination()
    names = jobs.SyncMetrics.COUNTERS
    return spark.createDataFrame([tuple(metrics.totals[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.with_headers(fx.full_log(spark, sf_dir))
    return backup.to_backup_records(rows)


def _stored(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    rows = backup.read_backup(spark, path, schema=_records(spark, sf_dir).schema)
    return rows.select(STREAM, SEQ, PAYLOAD, "unix_nano", D.first_header(F.col(HEADERS), MSG_ID_HEADER).alias("msg_id"))


@query
def backup_batch(spark, sf_dir):
    records, path = _records(spark, sf_dir), _folder(spark, "backup")
    end = _end(spark, sf_dir)
    # First with holes, then the job fills them.
    limits = {"max_entries": 5000, "split_at_holes": False}
    holed = backup.to_backup_records(fx.with_headers(fx.backup_log(spark, sf_dir)))
    transfer.backup(holed, path, 1, end, **limits)
    transfer.backup(records, path, 1, end, **limits)
    return _stored(spark, sf_dir, path)


@query
def backup_stream(spark, sf_dir):
    records, path = _records(spark, sf_dir), _folder(spark, "backup")
    jobs.backup_stream(
        _stream(spark, records, "records"), path, 1, _end(spark, sf_dir),
        _folder(spark, "offsets"), limits={"max_entries": 5000, "split_at_holes": False},
    ).awaitTermination()
    return _stored(spark, sf_dir, path)


def _valid_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the faulty log that decode, as a backup of all logs."""
    return fx.with_headers(fx.valid_log(spark, sf_dir)).select(STREAM, SEQ, HEADERS, PAYLOAD)


@query
def restore_batch(spark, sf_dir):
    valid = _valid_backup(spark, sf_dir).withColumn("chunk_id", F.expr(f"{SEQ} div 262144 * 262144"))
    output = _output(spark, valid)
    rules = restore_rules(
        mode="nested", start=1, end=2**62, tolerance=1, on_tolerance="stop"
    )
    transfer.restore(valid, output, rules)
    return _written(output)


@query
def restore_restart(spark, sf_dir):
    """A restore of a written backup, first of its first half and then of all of it."""
    valid, path = _valid_backup(spark, sf_dir), _folder(spark, "backup")
    backup.write_backup(valid, path, max_entries=200, split_at_holes=False)
    stored = backup.read_backup(spark, path, schema=valid.schema)
    output = _output(spark, valid)
    middle = valid.agg(F.expr(f"(min({SEQ}) + max({SEQ})) div 2")).first()[0]
    for end in (middle, 2**62):
        transfer.restore(stored, output, restore_rules(mode="nested", start=1, end=end, tolerance=10**9))
    return _written(output)


@query
def restore_indexed(spark, sf_dir):
    """`restore_restart` by the index of the chunks, which is written in two runs with the backup."""
    valid, path = _valid_backup(spark, sf_dir), _folder(spark, "backup")
    middle = valid.agg(F.expr(f"(min({SEQ}) + max({SEQ})) div 2")).first()[0]
    index, output = ChunkIndex(spark, path, valid.schema, "nested"), _output(spark, valid)
    for part, end in ((F.col(SEQ) < middle, middle), (F.col(SEQ) >= middle, 2**62)):
        backup.write_backup(valid.where(part), path, max_entries=200, split_at_holes=False)
        transfer.restore(index, output, restore_rules(mode="nested", start=1, end=end, tolerance=10**9))
    return _written(output)


@query
def restore_stream(spark, sf_dir):
    valid = _valid_backup(spark, sf_dir)
    output = _output(spark, valid)
    rules = restore_rules(mode="nested", tolerance=1, on_tolerance="stop")
    rows = _stream(spark, valid, "chunks")
    jobs.bridge_stream(rows, output, rules, _folder(spark, "offsets")).awaitTermination()
    return _written(output)


@query
def compare_incremental(spark, sf_dir):
    a = _messages(spark, sf_dir).select(STREAM, SEQ, PAYLOAD, F.lit("A").alias("side"))
    b = fx.compare_log(spark, sf_dir).select(STREAM, SEQ, PAYLOAD, F.lit("B").alias("side"))
    both = a.unionByName(b)
    job = IncrementalCompare(
        spark, _folder(spark, "compare"), "nested", both.schema[STREAM].dataType
    )
    jobs.start(_stream(spark, both, "both"), job, _folder(spark, "offsets")).awaitTermination()
    found = job.findings().drop("batch_id", "fatal")
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("prev_height", HEIGHT)})


def _wrapped(rows: DataFrame, type_: int) -> DataFrame:
    """The payload behind an envelope of five items that says when and by whom it was sent."""
    number = F.lpad(F.hex(F.col(SEQ)), 16, "0")
    head = F.concat(F.lit("01851A"), F.lpad(F.hex(F.lit(type_)), 8, "0"), F.lit("1B"), number, F.lit("1A00000001"), F.lit("00"), F.lit("50"), F.md5(F.concat(F.col(SEQ), F.lit(f"-{type_}"))))
    return rows.withColumn(PAYLOAD, F.unhex(F.concat(head, F.hex(F.col(PAYLOAD)))))


@query
def compare_enveloped(spark, sf_dir):
    """Payloads that are equal behind different envelopes give no finding: `compare_by_height` over wrapped logs."""
    a = _wrapped(_messages(spark, sf_dir), 7)
    b = _wrapped(fx.compare_log(spark, sf_dir).withColumn(SEQ, F.col(SEQ)), 8)
    staging = Staging(spark)
    sides = []
    for side in (a, b):
        narrow = D.stage_decoded(unwrapped(side.select(STREAM, SEQ, PAYLOAD)), "nested", staging, with_key=True)
        sides.append(compare.prepare_side(narrow, F.col("key")))
    return compare.compare_by_height(*sides)


@query
def stats_stream(spark, sf_dir):
    documents = fx.raw(spark, sf_dir, "documents").withColumn(SEQ, F.col("doc_id") + 1)
    sizes = jobs.size_stream(
        _stream(spark, documents, "documents"), F.col("source"), F.col("text"), 1
    )
    path = _folder(spark, "sizes")

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(path)

    jobs.start(sizes, keep, _folder(spark, "offsets"), output_mode="complete").awaitTermination()
    return spark.read.parquet(path)


@query
def throughput_stream(spark, sf_dir):
    windows = jobs.throughput_stream(
        _stream(spark, fx.backup_log(spark, sf_dir), "messages"), late="0 seconds"
    )
    path = _folder(spark, "windows")

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")

    jobs.start(windows, keep, _folder(spark, "offsets"), output_mode="update").awaitTermination()
    # An interval that several batches met is in the output of each; the last count is final.
    return (
        spark.read.parquet(path)
        .groupBy(STREAM, F.unix_seconds("window_start").alias("window_start"))
        .agg(F.max("n").alias("n"))
    )


@query
def dedup_window(spark, sf_dir):
    rows = jobs.dedup_window(_stream(spark, _messages(spark, sf_dir), "messages"), "3650 days")
    path = _folder(spark, "kept")
    jobs.start(
        rows.select(STREAM, SEQ, "msg_id", "ts"), sinks.plain_sink(path), _folder(spark, "offsets")
    ).awaitTermination()
    return spark.read.parquet(path).select(STREAM, "msg_id")


@query
def size_state(spark, sf_dir):
    rows = fx.raw(spark, sf_dir, "documents").select(
        F.lit(0).cast("bigint").alias(STREAM), (F.col("doc_id") + 1).alias(SEQ), "source", "text"
    )
    state = checks.SizeState(spark, _folder(spark, "state"))
    half = rows.agg(F.max(SEQ)).first()[0] // 2
    state.update(rows, F.col("source"), F.col("text"), end=half, resolution_kb=1)
    return state.update(rows, F.col("source"), F.col("text"), resolution_kb=1)
