"""Frame headers: known cases, and random bytes against a plain Python reading of the layout."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicegate.operators import decode as dec
from sluicegate.operators.decode import admit, decode, outcomes
from sluicegate.schemas import FRAMES
from sluicegate.session import local_rows

CASES = [
    (b"\x00\x10telemetry_events\xa0", ("telemetry_events", 18)),
    (b"\x00\x01t\xf6", ("t", 3)),
    (b"", dec.SHORT_HEADER),
    (b"\x00", dec.SHORT_HEADER),
    (b"\x00\x0afoo", dec.SHORT_NAME),
    (b"\x00\x02\xff\xfe\xa0", dec.BAD_NAME),
    (b"\x00\x00\xa0", ("", 2)),
]


def _frames(spark, frames):
    return local_rows(spark, [(i, None, f) for i, f in enumerate(frames)], FRAMES)


def _read_header(body):
    if len(body) < 2:
        return dec.SHORT_HEADER
    end = 2 + int.from_bytes(body[:2], "big")
    if len(body) < end:
        return dec.SHORT_NAME
    try:
        return body[2:end].decode(), end
    except UnicodeDecodeError:
        return dec.BAD_NAME


def _expected(frame):
    if not frame:
        return None
    kind = frame[0]
    if kind == 1:
        return ("01", None, None)
    if kind == 3:
        return ("03", None, dec.FLUSH_DISABLED)
    if kind != 2:
        return (f"{kind:02X}", None, f"unknown message type 0x{kind:02X}")
    header = _read_header(frame[1:])
    return ("02", None, header) if isinstance(header, str) else ("02", header[0], None)


def _found(spark, frames):
    rows = decode(_frames(spark, frames)).select("seq", "kind", "table", "msg").collect()
    return {r.seq: (r.kind, r.table, r.msg) for r in rows}


def test_header_cases(spark):
    found = _found(spark, [b"\x02" + body for body, _ in CASES])
    for i, (body, expected) in enumerate(CASES):
        assert _read_header(body) == expected
        assert found[i] == _expected(b"\x02" + body)


def test_payload_follows_the_name(spark):
    frame = b"\x02\x00\x05\xc3\xa9v\xc3\xa9" + '{"a":"ü"}'.encode()
    row = decode(_frames(spark, [frame])).first()
    assert (row.table, row.payload) == ("évé", '{"a":"ü"}')


def test_payload_that_is_not_utf8_is_null_and_keeps_its_frame(spark):
    frame = b"\x02\x00\x01t\xff\xff"
    row = decode(_frames(spark, [frame])).first()
    assert (row.table, row.payload, bytes(row.frame), row.msg) == ("t", None, frame, None)


def test_size_guard(spark):
    rows = decode(_frames(spark, [b"", b"\x02\x00\x01t{}", b"\x02\x00\x01t{}x"]), max_frame_bytes=6).collect()
    assert [(r.seq, r.table, r.msg) for r in rows] == [(1, "t", None), (2, None, dec.TOO_LARGE)]


def test_flush_request(spark):
    frames = _frames(spark, [b"\x03"])
    assert decode(frames).first().msg == dec.FLUSH_DISABLED
    assert decode(frames, enable_manual_flush=True).first().msg is None


frame_bytes = st.one_of(
    st.binary(max_size=12),
    st.builds(
        lambda kind, length, rest: bytes([kind]) + length.to_bytes(2, "big") + rest,
        st.sampled_from([1, 2, 2, 2, 3, 255]),
        st.integers(0, 6) | st.just(65535),
        st.binary(max_size=8) | st.text(max_size=4).map(str.encode),
    ),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(frame_bytes, min_size=50, max_size=120))
def test_random_frames(spark, frames):
    assert _found(spark, frames) == {i: _expected(f) for i, f in enumerate(frames) if f}


def test_admission_order_and_empty_name(spark):
    frames = _frames(spark, [b"\x02\x00\x01t", b"\x02\x00\x01t", b"\x02\x00\x00{}", b"\x02\x00\x01u"])
    known = spark.createDataFrame([("t", 0)], "table string, first_seq bigint")
    by_order = {r.seq: r.msg for r in outcomes(admit(decode(frames), known)).collect()}
    late = "unknown table '{}' — send REGISTER_SCHEMA first".format
    assert by_order == {0: late("t"), 1: None, 2: late(""), 3: late("u")}
    complete = {r.seq: r.msg for r in outcomes(admit(decode(frames), known, by_order=False)).collect()}
    assert complete == {0: None, 1: None, 2: late(""), 3: late("u")}


def test_sources_without_seq(spark):
    from sluicegate.sources.frames import as_frames

    source = spark.createDataFrame([(bytearray(b"\x02\x00\x01t{}"),)], "value binary")
    frames = as_frames(source, F.col("value"), None, None)
    known = spark.createDataFrame([("t", 0)], "table string, first_seq bigint")
    assert admit(decode(frames), known, by_order=False).first().msg is None
    assert admit(decode(frames), known).first().msg is not None
