import pytest

from blocklog.functions.envelope import with_envelope

ID = bytes(range(16))


@pytest.mark.parametrize("data,want", [
    (b"\x01\x85\x05\x18\x64\x1a\x00\x01\x00\x00\x19\x03\xe7\x50" + ID + b"rest", (5, 100, 65536, 999, b"rest", None)),
    (b"\x01\x85\x00\x1b" + b"\xff" * 8 + b"\x00\x17\x50" + ID, (0, 2**64 - 1, 0, 23, b"", None)),
    (b"\x01\x84\x05\x18\x64\x1a\x00\x01\x00\x00\x19\x03\xe7\x50" + ID, "bad_envelope"),
    (b"\x01\x85\x05\x18\x64\x1a\x00\x01\x00\x00\x19\x03\xe7\x50" + ID[:9], "bad_envelope"),
    (b"\x01\x85\x1a\x00\x01\x00\x00\x00\x00\x00\x50" + ID, "bad_envelope"),
    (b"\x01\x85\x25\x00\x00\x00\x50" + ID, "bad_envelope"),
    (b"\x01\x85", "bad_envelope"),
    (b"\x01", "bad_envelope"),
    (b"\x02\x85", "unknown_envelope_version"),
    (b"", "empty_payload"),
])
def test_envelope(spark, data, want):
    r = with_envelope(spark.createDataFrame([(bytearray(data),)], "payload binary")).first()
    if isinstance(want, str):
        assert r.envelope_error == want and r.envelope is None and r.body is None
    else:
        e = r.envelope
        assert (e.type, int(e.sequential_id), e.ts_s, e.ts_ms, bytes(r.body), r.envelope_error) == want
        assert bytes(e.unique_id) == ID
