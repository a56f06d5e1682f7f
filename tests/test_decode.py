"""JSON event decoding (S04) and malformed-record split (D05) semantics."""

from ringfence.operators.quality import split_malformed
from ringfence.sources.files import decode_events
from ringfence.sources.schemas import stream_schema


def test_int_field_sent_as_float_survives_and_nan_is_null(spark):
    raw = spark.createDataFrame([('{"customer_id":"c1","monthly_call_count":120.0,"monthly_call_duration":"NaN"}',),
                                 ('{"customer_id":"c2","monthly_call_count":7,"event_ts":"2024-01-01T03:00:00"}',)],
                                "value string")
    rows = {r.customer_id: r for r in decode_events(raw, "cdr").collect()}
    assert rows["c1"].monthly_call_count == 120            # would be NULL with an int decode schema
    assert rows["c1"].monthly_call_duration is None         # NaN must not satisfy "> threshold"
    assert rows["c2"].monthly_call_count == 7 and rows["c2"].event_ts.hour == 3


def test_malformed_documents_are_split_off(spark):
    raw = spark.createDataFrame([('{"customer_id":"c1","ss7_requests":5}',), ('{"customer_id":"c2","ss7_req',),
                                 ('not json',), ('{}',)], "value string")
    good, bad = split_malformed(raw, stream_schema("sdr"))
    assert [r.customer_id for r in good.collect()] == ["c1"]
    assert bad.count() == 3
