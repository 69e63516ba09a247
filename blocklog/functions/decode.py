"""Decoders: message payload and headers to height, hash and prev_hash, or an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.model import (
    ENVELOPE_VERSION,
    ERROR,
    FLAT_PATHS,
    HASH,
    HEADERS,
    HEIGHT,
    HEIGHT_TYPE,
    MSG_ID_HEADER,
    NESTED_PATHS,
    PAYLOAD,
    PREV_HASH,
    SEQ,
    STREAM,
    UINT64_MAX,
)
from blocklog.session import Staging

ENVELOPE_ERROR = "envelope_error"

Decoder = Callable[[DataFrame], DataFrame]


class CorruptRowsError(ValueError):
    """Undecodable rows where the caller asked for none."""


def parse_uint(text: Column) -> Column:
    """Unsigned base-10 64-bit number as ``decimal(20,0)``, null if the text is anything else.

    The pattern comes first because a plain cast also takes signs, blanks and exponents.
    """
    number = F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("decimal(20,0)"))
    return F.when(number <= F.lit(str(UINT64_MAX)).cast("decimal(20,0)"), number)


def first_header(headers: Column, name: str) -> Column:
    return F.try_element_at(F.try_element_at(headers, F.lit(name)), F.lit(1))


def headers_in(entries: Column) -> Column:
    """Stored form ``array<struct<key, values>>`` to the header map."""
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["values"])))


def headers_out(headers: Column) -> Column:
    """Header map to the stored form, ordered by header name."""
    return F.sort_array(
        F.transform(
            F.map_entries(headers),
            lambda e: F.struct(e["key"].alias("key"), e["value"].alias("values")),
        )
    )


def envelope_error(data: Column) -> Column:
    """Null when the first byte names the known envelope version."""
    version = F.hex(F.substring(data.cast("binary"), 1, 1))
    return F.when(data.isNull() | (F.octet_length(data) == 0), "empty_payload").when(
        version != ENVELOPE_VERSION, "unknown_envelope_version"
    )


def payload_key(payload: Column, exact: bool = False) -> Column:
    """What payload comparison uses: a SHA-256 digest, or the payload itself when ``exact``.

    The digest keeps large payloads out of shuffles.
    """
    return payload.cast("binary") if exact else F.sha2(payload.cast("binary"), 256)


def _with_block(
    df: DataFrame, height: Column, hash_: Column, prev: Column, error: Column, height_type: str
) -> DataFrame:
    typed = height.try_cast(height_type)
    problem = F.coalesce(error, F.when(height.isNotNull() & typed.isNull(), "height_range"))
    kept = [c for c in df.columns if c not in (HEIGHT, HASH, PREV_HASH, ERROR)]
    out = df.select(
        *kept,
        problem.alias(ERROR),
        typed.alias(HEIGHT),
        hash_.alias(HASH),
        prev.alias(PREV_HASH),
    )
    ok = F.col(ERROR).isNull()
    return out.select(
        *kept,
        *[F.when(ok, F.col(c)).alias(c) for c in (HEIGHT, HASH, PREV_HASH)],
        ERROR,
    )


def decode_unverified(
    df: DataFrame, *, headers: str = HEADERS, height_type: str = "bigint"
) -> DataFrame:
    """Height from the message id header; both hashes empty."""
    text = first_header(F.col(headers), MSG_ID_HEADER)
    number = parse_uint(text)
    error = F.when(text.isNull() | (text == ""), "missing_msg_id").when(
        number.isNull(), "bad_msg_id"
    )
    return _with_block(df, number, F.lit(""), F.lit(""), error, height_type)


def decode_simple(df: DataFrame, *, height_type: str = "bigint") -> DataFrame:
    """No block fields: every row passes and hash checks hold because all hashes are empty."""
    zero = F.lit(0).cast("decimal(20,0)")
    return _with_block(df, zero, F.lit(""), F.lit(""), F.lit(None).cast("string"), height_type)


def _decode_json(
    df: DataFrame,
    paths: dict[str, str],
    *,
    payload: str,
    null_is_absent: bool,
    require_fields: bool,
    height_type: str,
) -> DataFrame:
    """Three JSON paths with type checks, from one parse of the payload."""
    text, tree = "__text", "__tree"
    parsed = df.withColumn(text, F.col(payload).cast("string")).withColumn(
        tree, F.try_parse_json(text)
    )
    # One projection per step, so that no leaf is taken or typed more than once.
    leaves = parsed.select(
        *df.columns,
        text,
        F.col(tree).isNull().alias("__bad"),
        *[F.try_variant_get(tree, f"$.{p}", "variant").alias(f"__{c}") for c, p in paths.items()],
    )
    typed = leaves.select(
        *df.columns,
        text,
        "__bad",
        *[F.schema_of_variant(f"__{c}").alias(f"__type_{c}") for c in paths],
        *[F.try_variant_get(f"__{c}", "$", "string").alias(f"__{c}") for c in (HASH, PREV_HASH)],
        F.try_variant_get(f"__{HEIGHT}", "$", "decimal(20,0)").alias(f"__{HEIGHT}"),
    )
    kind = {c: F.col(f"__type_{c}") for c in paths}
    absent = {
        c: kind[c].isNull() | (kind[c] == "VOID") if null_is_absent else kind[c].isNull()
        for c in paths
    }

    # A whole number in 64-bit range is BIGINT. A larger one is DECIMAL, as is 1.0, so there the
    # text of the number decides.
    number = (
        F.when(absent[HEIGHT], F.lit(0).cast("decimal(20,0)"))
        .when((kind[HEIGHT] == "BIGINT") & (F.col(f"__{HEIGHT}") >= 0), F.col(f"__{HEIGHT}"))
        .when(
            kind[HEIGHT].startswith("DECIMAL"),
            parse_uint(F.get_json_object(text, f"$.{paths[HEIGHT]}")),
        )
    )
    typed = typed.withColumn("__number", number)
    error = F.when(F.col("__bad"), "bad_json")
    for c in (HASH, PREV_HASH):
        error = error.when(~absent[c] & (kind[c] != "STRING"), f"bad_{c}")
        if require_fields:
            error = error.when(absent[c], f"missing_{c}")
    error = error.when(F.col("__number").isNull(), "bad_height")
    if require_fields:
        error = error.when(absent[HEIGHT], "missing_height")

    def text_of(c: str) -> Column:
        return F.when(absent[c], "").otherwise(F.col(f"__{c}"))

    out = _with_block(
        typed, F.col("__number"), text_of(HASH), text_of(PREV_HASH), error, height_type
    )
    # The fields leave through a generator. The planner moves a filter below projections, where each
    # use of a field in it would parse again; it does not move one below a generator.
    kept = [c for c in df.columns if c not in (HEIGHT, HASH, PREV_HASH, ERROR)]
    fields = F.struct(HEIGHT, HASH, PREV_HASH, ERROR)
    return out.select(*kept, F.inline(F.array(fields)))


def decode_nested(
    df: DataFrame,
    *,
    payload: str = PAYLOAD,
    require_fields: bool = False,
    height_type: str = "bigint",
) -> DataFrame:
    """Fields under ``block.header``. An absent path gives '' or 0 unless ``require_fields``."""
    return _decode_json(
        df,
        NESTED_PATHS,
        payload=payload,
        null_is_absent=False,
        require_fields=require_fields,
        height_type=height_type,
    )


def decode_flat(
    df: DataFrame,
    *,
    payload: str = PAYLOAD,
    require_fields: bool = False,
    height_type: str = "bigint",
) -> DataFrame:
    """Top-level ``hash``, ``parent_hash`` and ``height``; a JSON null counts as absent."""
    return _decode_json(
        df,
        FLAT_PATHS,
        payload=payload,
        null_is_absent=True,
        require_fields=require_fields,
        height_type=height_type,
    )


DECODERS: dict[str, Decoder] = {
    "nested": decode_nested,
    "flat": decode_flat,
    "unverified": decode_unverified,
    "simple": decode_simple,
}


def get_decoder(mode: str | Decoder, allowed: tuple[str, ...] | None = None) -> Decoder:
    """A decoder by mode name in any letter case; a function is taken as it is."""
    if callable(mode):
        return mode
    name = mode.lower()
    known = [m for m in DECODERS if allowed is None or m in allowed]
    if name not in known:
        raise ValueError(f"mode should be one of {known}")
    return DECODERS[name]


def decode(df: DataFrame, mode: str | Decoder, **options) -> DataFrame:
    """Add ``height``, ``hash``, ``prev_hash`` and ``error`` (null when the row decodes)."""
    decoder = get_decoder(mode)
    return decoder(df, **options) if options else decoder(df)


def decode_unsigned(df: DataFrame, mode: str | Decoder) -> DataFrame:
    """``decode`` with heights of the whole unsigned 64-bit range; a decoder of the user keeps its own errors."""
    if isinstance(mode, str):
        return decode(df, mode, height_type=HEIGHT_TYPE)
    return decode(df, mode).withColumn(HEIGHT, F.col(HEIGHT).cast(HEIGHT_TYPE))


def with_envelope_error(decoded: DataFrame) -> DataFrame:
    """A message whose envelope does not decode is corrupt, whatever its payload."""
    sound = F.col(ENVELOPE_ERROR).isNull()
    fields = {c: F.when(sound, F.col(c)) for c in (HEIGHT, HASH, PREV_HASH)}
    return decoded.withColumns({**fields, ERROR: F.coalesce(ENVELOPE_ERROR, ERROR)})


def stage_decoded(
    messages: DataFrame,
    mode: str | Decoder,
    staging: Staging,
    *,
    with_key: bool = False,
    with_headers: bool = False,
    unsigned: bool = False,
) -> DataFrame:
    """Decode once into a narrow table without the payload, for work that reads it several times.

    ``with_key`` adds the payload key as ``key``, in bytes; ``unsigned`` takes heights of the whole unsigned range.
    """
    known = [c for c in (STREAM, SEQ, HEADERS, PAYLOAD, ENVELOPE_ERROR) if c in messages.columns]
    decoded = (decode_unsigned if unsigned else decode)(messages.select(*known), mode)
    if ENVELOPE_ERROR in known:
        decoded = with_envelope_error(decoded)
    extra = [HEADERS] if with_headers else []
    if with_key:
        extra.append(F.unhex(payload_key(F.col(PAYLOAD))).alias("key"))
    return staging.table(
        decoded.select(STREAM, SEQ, HEIGHT, HASH, PREV_HASH, ERROR, *extra), "decoded"
    )


def decoded_rows(df: DataFrame, on_corrupt: str = "skip") -> DataFrame:
    """Rows that decode. ``on_corrupt='fail'`` stops the job at the first one that does not."""
    if on_corrupt == "skip":
        return df.where(F.col(ERROR).isNull())
    if on_corrupt == "fail":
        message = F.concat_ws(
            " ", F.lit("row does not decode:"), F.col(STREAM).cast("string"),
            F.col(SEQ).cast("string"), F.col(ERROR),
        )
        return df.where(
            F.when(F.col(ERROR).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
        )
    raise ValueError("on_corrupt should be 'skip' or 'fail'")


def corrupt_rows(df: DataFrame) -> DataFrame:
    """The rows set aside, with the reason in ``error``."""
    return df.where(F.col(ERROR).isNotNull())


def message_id_error(headers: Column, height: Column) -> Column:
    """Null when the message id header has exactly one value and it equals the height."""
    values = F.try_element_at(headers, F.lit(MSG_ID_HEADER))
    number = parse_uint(F.try_element_at(values, F.lit(1)))
    return (
        F.when(values.isNull(), "msg_id_missing")
        .when(F.size(values) != 1, "msg_id_count")
        .when(number.isNull(), "msg_id_unparsable")
        .when(number != height, "msg_id_mismatch")
    )
