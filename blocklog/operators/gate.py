"""The write gate: which rows of a log may be appended so that the output stays a linked chain.

Row by row the rule is: take the row if there is no tip, or if it is higher than the tip and its
``prev_hash`` is the tip's hash; a taken row becomes the tip. Here the taken rows are found as a path:

1. neighbours that link directly form islands (windows inside a bucket of a log);
2. from the last row of an island the path goes on at the earliest later row that links to it;
3. the islands reached from the first row are the path, each from its entry row on;
4. one more prefix pass gives every row the tip it was judged against, and so its label.

A starting tip is a virtual first row of its log, so it needs no join. The work after step 1 grows
with the number of broken links, not with the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blocklog.model import (
    ACCEPTED,
    CORRUPT,
    ERROR,
    EXPECTED_LAST_MSG_ID_HEADER,
    EXPECTED_LAST_SEQ_HEADER,
    EXPECTED_STREAM_HEADER,
    HASH,
    HASH_MISMATCH,
    HEIGHT,
    LOW_HEIGHT,
    LOW_SEQ,
    MSG_ID_HEADER,
    PREV_HASH,
    SEQ,
    STREAM,
)
from blocklog.operators.prefix import (
    DEFAULT_WIDTH,
    LastValid,
    NextValid,
    RunMax,
    RunSum,
    bucket_name,
    bucket_of,
    with_prefix,
    with_prefix_in_groups,
)
from blocklog.session import Staging

# Islands of one log that a single row holds; logs with more go through joins.
WALK_LIMIT = 10_000
_NONE = -2

WRONG_BRIDGE = (CORRUPT, HASH_MISMATCH)
WRONG_RESTORE = (HASH_MISMATCH,)


# --- path of linked rows ------------------------------------------------------------------------
#
# Internal columns: STREAM, p (order), key (what a successor must name), ref (what this row names),
# h (height or null), live (takes part), virtual (stands for a starting tip).


def _islands(rows: DataFrame, by_height: bool, width: int) -> DataFrame:
    """Add ``island`` (order of the first row of the run) and ``tail`` (last row of the run).

    A run also ends at a bucket border; the next bucket is then found as its successor.
    """
    bucketed = rows.withColumn("b", F.expr(f"p div {int(width)}"))
    w = Window.partitionBy(STREAM, "b", "live").orderBy("p")
    linked = F.lag("key").over(w) == F.col("ref")
    last = F.lead("ref").over(w) == F.col("key")
    if by_height:
        linked = linked & (F.col("h") > F.lag("h").over(w))
        last = last & (F.lead("h").over(w) > F.col("h"))
    flagged = bucketed.select(
        *bucketed.columns,
        F.coalesce(linked, F.lit(False)).alias("linked"),
        (~F.coalesce(last, F.lit(False))).alias("tail"),
    )
    head = F.when(~F.col("linked"), F.col("p"))
    return flagged.select(
        *rows.columns,
        "tail",
        F.last(head, ignorenulls=True)
        .over(w.rowsBetween(Window.unboundedPreceding, 0))
        .alias("island"),
    )


def _packed(text: Column) -> Column:
    """A hash as bytes, which :func:`_text` turns back: lower-case hex digits take half their room, other text its own.

    The first byte tells both apart, so different texts stay different.
    """
    digits = F.unhex(text)
    return F.when(F.lower(F.hex(digits)) == text, F.concat(F.lit(b"\x01"), digits)).otherwise(
        F.concat(F.lit(b"\x00"), text.cast("binary"))
    )


def _text(packed: Column) -> Column:
    """The hash behind its bytes."""
    rest = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def _bits(height: Column) -> Column:
    """The 64 bits of an unsigned height as a bigint."""
    wide = height.cast("decimal(20,0)")
    half = F.lit("9223372036854775808").cast("decimal(20,0)")
    return F.when(wide < half, wide).otherwise(wide - half - half).cast("bigint")


def _bands() -> Column:
    """Groups in which a probe of height h meets exactly the candidates higher than h.

    With one tail height per key the join has already dropped all lower candidates and one group is
    enough. Otherwise the heights above h are the union of at most 64 dyadic ranges, and a candidate
    lies in exactly one of those of each probe below it; so both sides grow by the number of bits and
    never by each other's number.
    """
    one = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("prefix")))
    levels = F.sequence(F.lit(0), F.lit(63))
    bits = _bits(F.col("h"))

    def shifted(shift: Column) -> Column:
        return F.call_function("shiftrightunsigned", bits, shift)

    def at(shift: Column, add: int) -> Column:
        return F.struct(shift.alias("level"), (shifted(shift) + add).alias("prefix"))

    def bit(shift: Column) -> Column:
        return shifted(shift).bitwiseAND(F.lit(1).cast("bigint"))

    above = F.transform(F.filter(levels, lambda i: bit(i) == 0), lambda i: at(i, 1))
    own = F.transform(F.filter(levels, lambda i: bit(i) == 1), lambda i: at(i, 0))
    return F.when(F.col("low") == F.col("high"), one).when(F.col("probe"), above).otherwise(own)


def _successors(
    candidates: DataFrame, probes: DataFrame, by_height: bool, staging: Staging, width: int
) -> DataFrame:
    """For each probe the earliest later candidate that names its key (and is higher).

    Both sides have STREAM, link, p, h, island. The search is a prefix pass over their union within
    (STREAM, link), so a key shared by very many rows is cut into buckets and no pairs are built. Behind the join
    the first probe of a link stands for it; the checksum tells links apart whose probes share a position.
    """
    on = [STREAM, "link"]
    first, group = F.min("p").alias("first"), [STREAM, "first", "tag"]
    events = candidates.withColumn("probe", F.lit(False)).unionByName(
        probes.withColumn("probe", F.lit(True))
    )
    if by_height:
        wanted = probes.groupBy(*on).agg(F.min("h").alias("low"), F.max("h").alias("high"), first)
        events = (
            events.join(wanted, on)
            .withColumn("tag", F.hash("link"))
            .where(F.col("probe") | (F.col("h") > F.col("low")))
            .select(*group, "p", "island", "probe", F.inline(_bands()).alias("level", "prefix"))
        )
        keys = [*group, "level", "prefix"]
    else:
        wanted = probes.groupBy(*on).agg(first)
        events = events.join(wanted, on).withColumn("tag", F.hash("link")).select(*group, "p", "island", "probe")
        keys = group
    found = with_prefix_in_groups(
        staging.table(events, "events"),
        [NextValid(F.when(~F.col("probe"), F.struct("p", "island")), "next")],
        keys=keys,
        order="p",
        tie=("probe",),
        staging=staging,
        width=width,
    )
    return (
        found.where("probe")
        .groupBy(STREAM, "island", "p")
        .agg(F.min("next").alias("next"))
    )


def _walk(edges: DataFrame) -> DataFrame:
    """Follow the path inside one row per log; for logs of a bounded number of islands.

    A path only goes forward, so one pass over the ordered islands meets its members in turn.
    """
    islands = edges.groupBy(STREAM).agg(
        F.array_sort(F.collect_list(F.struct("island", "next_island", "next_entry"))).alias("all")
    )
    first = F.col("all")[0]["island"]
    kind = edges.schema["island"].dataType.simpleString()

    def state(following: Column, entry: Column, path: Column) -> Column:
        return F.struct(
            following.alias("following"), entry.alias("entry"), path.alias("path")
        )

    def step(at: Column, edge: Column) -> Column:
        here = F.array(F.struct(at["following"].alias("island"), at["entry"].alias("entry")))
        taken = state(edge["next_island"], edge["next_entry"], F.concat(at["path"], here))
        return F.when(edge["island"] == at["following"], taken).otherwise(at)

    nothing = F.array().cast(f"array<struct<island: {kind}, entry: {kind}>>")
    path = F.aggregate(F.col("all"), state(first, first, nothing), step)["path"]
    return islands.select(STREAM, F.inline(path))


def _double(edges: DataFrame, staging: Staging) -> DataFrame:
    """Islands on the path by pointer doubling: round k reaches what lies within 2^k steps."""
    start = edges.groupBy(STREAM).agg(F.min("island").alias("island"))
    reached = staging.table(start.withColumn("entry", F.col("island")), "start")
    hop = edges.where(F.col("next_island") != _NONE)
    # Only the start and the islands that some island leads to can be on the path.
    nodes = hop.select(STREAM, F.col("next_island").alias("island")).unionByName(start).distinct()
    hop = staging.table(hop.join(nodes, [STREAM, "island"], "left_semi"), "hop")
    while True:
        step = staging.table(
            reached.join(hop, [STREAM, "island"]).select(
                STREAM, F.col("next_island").alias("island"), F.col("next_entry").alias("entry")
            ),
            "step",
        )
        if step.isEmpty():
            return reached
        reached = reached.unionByName(step)
        further = hop.select(
            STREAM,
            F.col("island").alias("next_island"),
            F.col("next_island").alias("far_island"),
            F.col("next_entry").alias("far_entry"),
        )
        hop = staging.table(
            hop.join(further, [STREAM, "next_island"]).select(
                STREAM,
                "island",
                F.col("far_island").alias("next_island"),
                F.col("far_entry").alias("next_entry"),
            ),
            "hop",
        )


def _reached(edges: DataFrame, staging: Staging, walk_limit: int) -> DataFrame:
    """Islands on the path with their entry row: STREAM, island, entry."""
    sizes = edges.groupBy(STREAM).agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= walk_limit:
        return staging.table(_walk(edges), "reached")
    long_logs = staging.table(sizes.where(F.col("n") > walk_limit).select(STREAM), "long-logs")
    short = edges.join(long_logs, STREAM, "left_anti")
    long = edges.join(long_logs, STREAM, "left_semi")
    both = _walk(short).unionByName(_double(staging.table(long, "long-edges"), staging))
    return staging.table(both, "reached")


def _on_path(
    rows: DataFrame, by_height: bool, staging: Staging, width: int, walk_limit: int
) -> DataFrame:
    """The rows with a flag ``taken`` for those on the path of their log, and their bucket, by which they are dealt out.

    A reached island lies in one bucket, so its entry is a row before its first there and needs no join.
    """
    islands = staging.table(_islands(rows, by_height, width), "islands")
    live = islands.where("live")
    side = [F.col("p"), F.col("h"), F.col("island")]
    candidates = live.where(~F.col("virtual")).select(STREAM, F.col("ref").alias("link"), *side)
    probes = live.where("tail").select(STREAM, F.col("key").alias("link"), *side)
    none = F.lit(_NONE)
    edges = staging.table(
        _successors(candidates, probes, by_height, staging, width).select(
            STREAM,
            "island",
            F.coalesce("next.island", none).alias("next_island"),
            F.coalesce("next.p", none).alias("next_entry"),
        ),
        "edges",
    )
    reached = _reached(edges, staging, walk_limit)
    marks = reached.select(STREAM, F.col("island").alias("p"), F.struct("island", "entry").alias("mark"))
    both = islands.drop("tail").unionByName(marks, allowMissingColumns=True)
    bucket = bucket_name()
    w = Window.partitionBy(STREAM, bucket).orderBy("p", F.desc_nulls_last("mark"))
    path = F.last("mark", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    judged = both.withColumn(bucket, bucket_of("p", width)).withColumn("path", path).where(F.col("mark").isNull())
    on_path = (F.col("path.island") == F.col("island")) & (F.col("p") >= F.col("path.entry"))
    # What a gate sets aside is not live. Told by that column, the passes over these rows read the same ones and share a shuffle.
    live = F.col("aside").isNull() if "aside" in rows.columns else F.col("live")
    taken = live & F.coalesce(on_path, F.lit(False))
    return judged.select(*rows.columns, bucket, taken.alias("taken"))


# --- gates --------------------------------------------------------------------------------------


def _gate_rows(rows: DataFrame, tips: DataFrame | None, start: int) -> DataFrame:
    """The columns the gates need, with one virtual row per tip."""
    error = F.col(ERROR) if ERROR in rows.columns else F.lit(None).cast("string")
    low = F.col(SEQ) < F.lit(start)
    out = rows.select(
        STREAM,
        F.col(SEQ).alias("p"),
        _packed(F.coalesce(HASH, F.lit(""))).alias("key"),
        _packed(F.coalesce(PREV_HASH, F.lit(""))).alias("ref"),
        F.col(HEIGHT).alias("h"),
        (error.isNull() & ~low).alias("live"),
        F.lit(False).alias("virtual"),
        F.when(low, LOW_SEQ).when(error.isNotNull(), CORRUPT).alias("aside"),
        error.alias(ERROR),
        F.lit(None).cast("bigint").alias("base"),
    )
    if tips is None:
        return out
    kind = {f.name: f.dataType for f in out.schema.fields}
    return out.unionByName(
        tips.select(
            F.col(STREAM).cast(kind[STREAM]).alias(STREAM),
            F.lit(-1).cast(kind["p"]).alias("p"),
            _packed(F.coalesce(HASH, F.lit(""))).alias("key"),
            _packed(F.lit("")).alias("ref"),
            F.col(HEIGHT).cast(kind["h"]).alias("h"),
            F.lit(True).alias("live"),
            F.lit(True).alias("virtual"),
            F.lit(None).cast("string").alias("aside"),
            F.lit(None).cast("string").alias(ERROR),
            F.col("out_seq").cast("bigint").alias("base"),
        )
    )


def _labelled(flagged: DataFrame, width: int, dealt: bool = False) -> DataFrame:
    """Labels, output sequence and the tip each row was judged against; with ``dealt`` the bucket too."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    written = F.when(F.col("virtual"), F.col("base")).when(F.col("taken"), one).otherwise(zero)
    judged = with_prefix(
        flagged,
        [
            RunSum(written, "written"),
            RunSum(F.when(F.col("virtual"), zero).otherwise(one), "pos"),
            # Apart, so that the hashes are not moved where only the height is wanted.
            LastValid(F.when(F.col("taken"), F.struct("h")), "tip", inclusive=False),
            LastValid(F.when(F.col("taken"), F.struct("key")), "tip_key", inclusive=False),
        ],
        keys=[STREAM],
        order="p",
        width=width,
        spread=False,
        keep_bucket=dealt,
    ).where(~F.col("virtual"))
    taken = F.col("taken")
    return judged.select(
        STREAM,
        F.col("p").alias(SEQ),
        F.col("h").alias(HEIGHT),
        _text(F.col("key")).alias(HASH),
        _text(F.col("ref")).alias(PREV_HASH),
        ERROR,
        F.coalesce(
            "aside",
            F.when(taken, ACCEPTED).when(F.col("h") <= F.col("tip.h"), LOW_HEIGHT)
            .otherwise(HASH_MISMATCH),
        ).alias("label"),
        "pos",
        F.when(taken, F.col("written")).alias("out_seq"),
        F.when(
            F.col("tip").isNotNull(), F.col("written") - F.when(taken, one).otherwise(zero)
        ).alias("tip_out_seq"),
        F.col("tip.h").alias("tip_height"),
        _text(F.col("tip_key.key")).alias("tip_hash"),
        *([bucket_name()] if dealt else []),
    )


def write_gate(
    rows: DataFrame,
    tips: DataFrame | None = None,
    *,
    start: int = 0,
    staging: Staging | None = None,
    width: int = DEFAULT_WIDTH,
    walk_limit: int = WALK_LIMIT,
    dealt: bool = False,
) -> DataFrame:
    """Label every row ACCEPTED, LOW_HEIGHT, HASH_MISMATCH, CORRUPT or LOW_SEQ.

    ``rows`` is the output of a decoder; ``tips`` has at most one row (stream_id, out_seq, height,
    hash) per log. Rows below ``start`` are LOW_SEQ and rows with an error CORRUPT; both are passed
    over. The result also holds ``pos`` (row number in the log), ``out_seq`` of accepted rows, and
    the tip before the row (``tip_out_seq``, ``tip_height``, ``tip_hash``).

    ``dealt`` keeps the bucket by which the rows are dealt out, so that :func:`wrong_runs` need not deal them out again.

    Where all hashes are equal use :func:`record_gate`.
    """
    staging = staging or Staging(rows.sparkSession)
    flagged = _on_path(_gate_rows(rows, tips, start), True, staging, width, walk_limit)
    return _labelled(flagged, width, dealt)


def record_gate(
    rows: DataFrame,
    tips: DataFrame | None = None,
    *,
    start: int = 0,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """The gate where all hashes are empty: a row passes if it is higher than all passed before."""
    gated = with_prefix(
        _gate_rows(rows, tips, start),
        [RunMax(F.when(F.col("live"), F.col("h")), "top")],
        keys=[STREAM],
        order="p",
        width=width,
    )
    taken = F.col("live") & (F.col("top").isNull() | (F.col("h") > F.col("top")))
    return _labelled(gated.withColumn("taken", taken).drop("top"), width)


def strict_sequence(
    rows: DataFrame,
    *,
    arrival: str,
    start: int = 1,
    strict: bool = True,
    staging: Staging | None = None,
    width: int = DEFAULT_WIDTH,
    walk_limit: int = WALK_LIMIT,
) -> DataFrame:
    """Keep a row only if its sequence is the last kept one plus 1, in the order of ``arrival``.

    With ``strict`` the first kept row has sequence ``start``, otherwise it is the first to arrive.
    Adds ``kept`` and ``pos``.
    """
    staging = staging or Staging(rows.sparkSession)
    base = rows.select(
        STREAM,
        F.col(arrival).alias("p"),
        F.col(SEQ).alias("key"),
        (F.col(SEQ) - 1).alias("ref"),
        F.lit(0).alias("h"),
        F.lit(True).alias("live"),
        F.lit(False).alias("virtual"),
    )
    if strict:
        first = base.select(STREAM).distinct().select(
            STREAM,
            F.lit(-1).cast(base.schema["p"].dataType).alias("p"),
            F.lit(max(start, 1) - 1).cast(base.schema["key"].dataType).alias("key"),
            F.lit(None).cast(base.schema["ref"].dataType).alias("ref"),
            F.lit(0).alias("h"),
            F.lit(True).alias("live"),
            F.lit(True).alias("virtual"),
        )
        base = base.unionByName(first)
    flagged = _on_path(base, False, staging, width, walk_limit).where(~F.col("virtual"))
    numbered = with_prefix(
        flagged.select(
            STREAM, F.col("p").alias(arrival), F.col("key").alias(SEQ), F.col("taken").alias("kept")
        ),
        [RunSum(F.lit(1).cast("bigint"), "pos")],
        keys=[STREAM],
        order=arrival,
        width=width,
    )
    return numbered


def successor(
    rows: DataFrame,
    after: DataFrame,
    *,
    staging: Staging | None = None,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """For each row of ``after`` (stream_id, seq, height, hash) the next acceptable row's sequence."""
    staging = staging or Staging(rows.sparkSession)
    candidates = rows.select(
        STREAM, _packed(F.coalesce(PREV_HASH, F.lit(""))).alias("link"), F.col(SEQ).alias("p"),
        F.col(HEIGHT).alias("h"), F.col(SEQ).alias("island"),
    )
    probes = after.select(
        STREAM, _packed(F.coalesce(HASH, F.lit(""))).alias("link"), F.col(SEQ).alias("p"),
        F.col(HEIGHT).alias("h"), F.col(SEQ).alias("island"),
    )
    return _successors(candidates, probes, True, staging, width).select(
        STREAM, F.col("p").alias(SEQ), F.col("next.p").alias("next_seq")
    )


# --- tolerance ----------------------------------------------------------------------------------


def wrong_runs(
    labelled: DataFrame,
    wrong: Column,
    *,
    carried: DataFrame | None = None,
    order: str = SEQ,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Add ``run``: how many wrong rows in a row end here, 0 on any other row.

    ``labelled`` has the row number ``pos`` that the gates give. ``carried`` (STREAM, run) is the run
    that was open before the first row of a log, from an earlier batch.
    """
    columns = [c for c in labelled.columns if c != bucket_name()]
    marked = labelled.withColumn("__wrong", wrong).withColumn("__start", F.lit(False))
    if carried is not None:
        start = carried.select(
            F.col(STREAM).cast(labelled.schema[STREAM].dataType).alias(STREAM),
            F.lit(-1).cast(labelled.schema[order].dataType).alias(order),
            (-F.col("run")).cast(labelled.schema["pos"].dataType).alias("pos"),
            F.lit(False).alias("__wrong"),
            F.lit(True).alias("__start"),
        )
        marked = marked.drop(bucket_name()).unionByName(start, allowMissingColumns=True)
    runs = with_prefix(
        marked,
        [LastValid(F.when(~F.col("__wrong"), F.col("pos")), "__good")],
        keys=[STREAM],
        order=order,
        width=width,
        spread=bucket_name() not in marked.columns,
    ).where(~F.col("__start"))
    none = F.lit(0).cast("bigint")
    run = F.when(F.col("__wrong"), F.col("pos") - F.coalesce("__good", none))
    return runs.select(*columns, F.coalesce(run, none).alias("run"))


def tolerance_cutoff(
    runs: DataFrame, limit: int, rule: str = "reach", *, order: str = SEQ
) -> DataFrame:
    """Per log the row at which processing stops: STREAM, cut. Logs that never stop have no row.

    ``rule='reach'`` stops when a run has ``limit`` rows, ``'exceed'`` when it has more.
    """
    return runs.where(over_tolerance(limit, rule)).groupBy(STREAM).agg(F.min(order).alias("cut"))


def over_tolerance(limit: int, rule: str = "reach") -> Column:
    """Whether processing stops at a row with this ``run``."""
    if rule not in ("reach", "exceed"):
        raise ValueError("rule should be 'reach' or 'exceed'")
    over = F.col("run") >= limit if rule == "reach" else F.col("run") > limit
    return over & (F.col("run") > 0)


def before_cutoff(
    rows: DataFrame, cutoff: DataFrame, *, order: str = SEQ, including: bool = False
) -> DataFrame:
    """Rows before the stop of their log; ``including`` keeps the row that caused it."""
    inside = F.col(order) <= F.col("cut") if including else F.col(order) < F.col("cut")
    return rows.join(cutoff, STREAM, "left").where(F.col("cut").isNull() | inside).drop("cut")


# --- headers ------------------------------------------------------------------------------------


def output_headers(
    stream_name: Column,
    *,
    disable_check_seq: int | None = None,
    disable_check_height: int | None = None,
) -> Column:
    """Headers of an accepted row as a map, from the columns the gate adds."""
    checked = F.col("tip_height").isNotNull()
    if disable_check_seq is not None:
        checked = checked & (F.col("tip_out_seq") + 1 != disable_check_seq)
    if disable_check_height is not None:
        checked = checked & (F.col(HEIGHT) != disable_check_height)

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), F.array(value.cast("string")).alias("value"))

    entries = F.array(
        entry(MSG_ID_HEADER, F.col(HEIGHT)),
        F.when(checked, entry(EXPECTED_LAST_MSG_ID_HEADER, F.col("tip_height"))),
        F.when(checked, entry(EXPECTED_LAST_SEQ_HEADER, F.col("tip_out_seq"))),
        entry(EXPECTED_STREAM_HEADER, stream_name),
    )
    return F.map_from_entries(F.array_compact(entries))
