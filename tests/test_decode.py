import pytest
from pyspark.sql import functions as F

from blocklog.functions import decode as D
from blocklog.functions.scalar import size_bucket

UINT = "decimal(20,0)"


def test_message_id_text(spark):
    texts = ["7", "007", "18446744073709551615", "18446744073709551616", "+7", " 7 ", "1e3", "1_0", "", "7\n", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn(
        "headers", F.when(F.col("t").isNotNull(), F.create_map(F.lit("Nats-Msg-Id"), F.array("t"))))
    rows = D.decode_unverified(df, height_type=UINT).orderBy("i").collect()
    assert [None if r.height is None else int(r.height) for r in rows] == [7, 7, 2**64 - 1] + [None] * 8
    assert [r.error for r in rows][3:] == ["bad_msg_id"] * 5 + ["missing_msg_id", "bad_msg_id", "missing_msg_id"]
    assert D.decode_unverified(df).orderBy("i").collect()[2].error == "height_range"


def test_header_counts(spark):
    df = spark.createDataFrame(
        [(1, {"Nats-Msg-Id": []}), (2, {"Nats-Msg-Id": ["5"]}), (3, {"Nats-Msg-Id": ["5", "5"]}), (4, {}),
         (5, {"Nats-Msg-Id": ["x"]}), (6, {"Nats-Msg-Id": ["6"]})], "i int, headers map<string,array<string>>")
    got = df.select("i", D.message_id_error(F.col("headers"), F.lit(5)).alias("e")).orderBy("i").collect()
    assert [r.e for r in got] == ["msg_id_count", None, "msg_id_count", "msg_id_missing", "msg_id_unparsable", "msg_id_mismatch"]


@pytest.mark.parametrize("text,want", [
    ('{"block":{"header":{"hash":"a","prev_hash":"b","height":5}},"x":[1]}', (5, "a", "b", None)),
    ('{"block":{"header":{"hash":"a",', (None, None, None, "bad_json")),
    ('{"block":5}', (0, "", "", None)),
    ('{"block":{"header":{"hash":1}}}', (None, None, None, "bad_hash")),
    ('{"block":{"header":{"prev_hash":null}}}', (None, None, None, "bad_prev_hash")),
    ('{"block":{"header":{"height":"5"}}}', (None, None, None, "bad_height")),
    ('{"block":{"header":{"height":1.5}}}', (None, None, None, "bad_height")),
    ('{"block":{"header":{"height":1.0}}}', (None, None, None, "bad_height")),
    ('{"block":{"header":{"height":-1}}}', (None, None, None, "bad_height")),
    ('{"block":{"header":{"height":18446744073709551615}}}', (2**64 - 1, "", "", None)),
    ('{"block":{"header":{"height":18446744073709551616}}}', (None, None, None, "bad_height")),
])
def test_nested_cases(spark, text, want):
    r = D.decode_nested(spark.createDataFrame([(text,)], "payload string"), height_type=UINT).first()
    assert (None if r.height is None else int(r.height), r.hash, r.prev_hash, r.error) == want


def test_flat_null_is_absent_and_required_fields(spark):
    df = spark.createDataFrame([('{"hash":"a","parent_hash":null,"height":3}',)], "payload string")
    assert tuple(D.decode_flat(df).first())[1:] == (3, "a", "", None)
    assert D.decode_flat(df, require_fields=True).first().error == "missing_prev_hash"


def test_binary_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"hash":"a","parent_hash":"b","height":3}'),)], "payload binary")
    assert tuple(D.decode(df, "FLAT").first())[1:] == (3, "a", "b", None)


def test_unknown_mode_and_own_decoder(spark):
    with pytest.raises(ValueError):
        D.get_decoder("other")
    with pytest.raises(ValueError):
        D.get_decoder("simple", ("nested", "flat"))
    df = spark.range(1)
    own = lambda rows: rows.select(F.lit(1).alias("height"))
    assert D.decode(df, own).columns == ["height"]


def test_corrupt_rows_can_fail_the_job(spark):
    df = spark.createDataFrame([(1, 2, "bad_json")], "stream_id int, seq int, error string")
    assert D.decoded_rows(df).count() == 0
    with pytest.raises(Exception, match="row does not decode"):
        D.decoded_rows(df, "fail").collect()


def test_envelope_and_sizes(spark):
    df = spark.createDataFrame([(bytearray(b""),), (bytearray(b"\x01x"),), (bytearray(b"\x02"),), (None,)], "d binary")
    assert [r[0] for r in df.select(D.envelope_error(F.col("d"))).collect()] == [
        "empty_payload", None, "unknown_envelope_version", "empty_payload"]
    sizes = spark.createDataFrame([(s,) for s in (0, 1, 65536, 65537)], "s bigint")
    assert [r[0] for r in sizes.select(size_bucket(F.col("s"))).collect()] == [0, 64, 64, 128]


def test_parse_happens_once_and_in_the_jvm(spark):
    df = spark.createDataFrame([(1, 1, "{}")], "stream_id int, seq int, payload string")
    rows = D.decoded_rows(D.decode_nested(df)).where("height > 3")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "Python" not in plan
