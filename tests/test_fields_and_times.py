"""Lenient field reads on single records."""

import math

import pytest
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.functions.times import (
    event_timestamp, infer_epoch_ms, iso_instant, iso_local, text_to_ms,
)
from tillstream.operators.normalize import (
    normalize_sales, parse_sales_json, quarantine, with_event_time,
)

NOW = 42

TIME_CASES = [
    ('{"eventTime":1771488000}', 1771488000000),
    ('{"eventTime":1771488000000}', 1771488000000),
    ('{"eventTime":1771488000000000}', 1771488000000),
    ('{"eventTime":1000000000000}', 1000000000000000),
    ('{"eventTime":1000000000001}', 1000000000001),
    ('{"eventTime":1000000000000000}', 1000000000000000),
    ('{"eventTime":1000000000000001}', 1000000000000),
    ('{"eventTime":-5}', -5000),
    ('{"eventTime":0}', 0),
    ('{"eventTime":"1771488000"}', 1771488000),
    ('{"eventTime":"+5"}', 5),
    ('{"eventTime":"2026-02-19T08:00:00Z"}', 1771488000000),
    ('{"eventTime":"2026-02-19T08:00:00.250Z"}', 1771488000250),
    ('{"eventTime":"2026-02-19t08:00:00z"}', 1771488000000),
    ('{"eventTime":"2026-02-19T08:00:00-03:00"}', 1771498800000),
    ('{"eventTime":"2026-02-19T08:00Z"}', NOW),
    ('{"eventTime":"2026-02-30T08:00:00Z"}', NOW),
    ('{"sale_date":"2026-02-19T08:00:00"}', 1771488000000),
    ('{"sale_date":"2026-02-19T08:00"}', 1771488000000),
    ('{"sale_date":"2026-02-19 08:00:00"}', NOW),
    ('{"sale_date":"2026-02-19"}', NOW),
    ('{"sale_date":""}', NOW),
    ('{"sale_date":"2026-02-19T08:00:00Z\\n"}', NOW),
    ('{"eventTime":"bad","created_at":1771488000}', NOW),
    ('{"eventTime":null,"created_at":1771488000}', 1771488000000),
    ('{"x":1}', NOW),
    ('{"eventTime":1771488000000.9}', 1771488000000),
    ('{"eventTime":1.5e3}', 1500),
    ('{"eventTime":"1.5e3"}', NOW),
    ('{"eventTime":true}', 1),
    ('{"eventTime":false}', 0),
    ('{"eventTime":"true"}', NOW),
    ('{"eventTime":{}}', NOW),
    ('{"eventTime":[1771488000000]}', NOW),
    ('{"eventTime":" 5"}', NOW),
    ('{"eventTime":9223372036854775807}', 9223372036854775),
    ('{"eventTime":-9223372036854775807}', NOW),
    ('{"eventTime":"99999999999999999999"}', NOW),
    ("[1]", NOW),
    ("", NOW),
    ("  ", NOW),
    ("7", NOW),
]

TEXT_CASES = [
    ('{"saleId":"a","id":1}', "a"),
    ('{"sale_id":"a","id":1}', "a"),
    ('{"id":17}', "17"),
    ('{"id":-17}', "-17"),
    ('{"saleId":"","id":1}', ""),
    ('{"saleId":null,"id":1}', "1"),
    ('{"id":5.0}', "5.0"),
    ('{"id":"5.0"}', "5.0"),
    ('{"id":"5.10"}', "5.10"),
    ('{"id":5.10}', "5.1"),
    ('{"id":1e3}', "1000.0"),
    ('{"id":"1e3"}', "1e3"),
    ('{"id":12345678901234567890}', "12345678901234567890"),
    ('{"id":true}', "true"),
    ('{"id":{"a":1}}', ""),
    ('{"id":"{a}"}', "{a}"),
    ('{"id":"[1]"}', "[1]"),
    ('{"id":[1]}', ""),
    ('{"saleId":{},"id":1}', ""),
    ('{"id":1,"id":2}', "2"),
    ('{"id":"-"}', "-"),
    ('{"id":"S\\u00e3o \\"x\\""}', 'São "x"'),
    ('{"ID":1}', ""),
    ("[]", ""),
]

DOUBLE_CASES = [
    ('{"amount":12.5}', 12.5),
    ('{"amount":7}', 7.0),
    ('{"amount":"12.5"}', 12.5),
    ('{"amount":" 1e3 "}', 1000.0),
    ('{"amount":"1d"}', 1.0),
    ('{"amount":"0x1p3"}', 8.0),
    ('{"amount":"R$5"}', 0.0),
    ('{"amount":""}', 0.0),
    ('{"amount":null}', 0.0),
    ('{"amount":true}', 1.0),
    ('{"amount":"true"}', 0.0),
    ('{"amount":false}', 0.0),
    ('{"amount":[1]}', 0.0),
    ('{"amount":"NaN"}', math.nan),
    ('{"amount":"-NaN"}', math.nan),
    ('{"amount":"nan"}', 0.0),
    ('{"amount":"Infinity"}', math.inf),
    ('{"amount":"-Infinity"}', -math.inf),
    ('{"amount":"inf"}', 0.0),
    ('{"amount":"infinity"}', 0.0),
    ('{"amount":"1e999"}', math.inf),
    ("{}", 0.0),
]


def normalized(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = normalize_sales(
        frame.repartition(1).sortWithinPartitions("i"), "files",
        now_ms=F.lit(NOW).cast("bigint"), with_flags=True).collect()
    assert len(rows) == len(texts)
    return rows


def test_times(spark):
    rows = normalized(spark, [text for text, _ in TIME_CASES])
    got = [(text, row.event_time_ms) for (text, _), row in zip(TIME_CASES, rows)]
    assert got == TIME_CASES
    fallback = [row.time_fallback for row in rows]
    assert fallback == [expected == NOW for _, expected in TIME_CASES]


def test_texts(spark):
    rows = normalized(spark, [text for text, _ in TEXT_CASES])
    got = [(text, row.sale_id) for (text, _), row in zip(TEXT_CASES, rows)]
    assert got == TEXT_CASES
    assert [row.empty_sale_id for row in rows] == [e == "" for _, e in TEXT_CASES]


def test_doubles(spark):
    rows = normalized(spark, [text for text, _ in DOUBLE_CASES])
    got = [(text, repr(row.amount)) for (text, _), row in zip(DOUBLE_CASES, rows)]
    assert got == [(text, repr(expected)) for text, expected in DOUBLE_CASES]
    assert [row.zero_amount for row in rows] == [e == 0.0 for _, e in DOUBLE_CASES]


def test_source_is_the_topic_or_the_field(spark):
    frame = spark.createDataFrame([('{"source":"x"}',)], "value string")
    assert normalize_sales(frame, "legacy").first().source == "legacy"
    assert normalize_sales(frame).first().source == "x"


def test_unstorable_amounts_count_as_zero(spark):
    texts = ['{"amount":"NaN"}', '{"amount":1e16}', '{"amount":0.295}',
             '{"amount":-9999999999999998}']
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    flagged = normalize_sales(frame, "files", with_flags=True)
    rows = with_event_time(flagged).collect()
    assert sorted((str(row.amount), row.unstorable_amount) for row in rows) == [
        ("-9999999999999998.00", False), ("0.00", True), ("0.00", True), ("0.30", False)]


@pytest.mark.parametrize("text, readable", [
    ('{"id":1}', True), ("[1]", True), ("7", True), ("null", True), ('"s"', True), ("", True),
    ('{"id":1} trailing', True), (None, False), ("nope", False), ('{"id":1,}', False),
    ("{'id':1}", False), ('{"id":1,"x":tru}', False), ('{"amount":NaN}', False), ('{"id":', False),
])
def test_quarantine_takes_exactly_the_rest(spark, text, readable):
    frame = spark.createDataFrame([(text,)], "value string")
    assert parse_sales_json(frame).count() == int(readable)
    assert quarantine(frame).count() == int(not readable)
    assert quarantine(frame).columns == ["value"]


def test_epoch_bounds_are_exclusive(spark):
    numbers = [C.MILLIS_ABOVE, C.MILLIS_ABOVE + 1, C.MICROS_ABOVE, C.MICROS_ABOVE + 1, 2**62]
    frame = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = [row[0] for row in frame.select(infer_epoch_ms(F.col("n"))).collect()]
    assert got == [10**15, 10**12 + 1, 10**15, 10**12, 2**62 // 1000]


def test_timestamp_beyond_its_range_is_null(spark):
    frame = spark.createDataFrame([(2**62,), (0,)], "ms bigint")
    got = [row[0] for row in frame.select(event_timestamp(F.col("ms"))).collect()]
    assert got[0] is None and got[1] is not None


@pytest.mark.parametrize("text, expected", [
    ("2026-02-19 08:00:00", "2026-02-19T08:00:00"),
    ("2026-02-19 08:00:00.25", "2026-02-19T08:00:00.250"),
    ("2026-02-19 08:00:00.000001", "2026-02-19T08:00:00.000001"),
    ("2026-02-19 08:00:00.1005", "2026-02-19T08:00:00.100500"),
])
def test_iso_texts_have_groups_of_three_digits(spark, text, expected):
    ts = F.to_timestamp(F.lit(text))
    row = spark.range(1).select(iso_instant(ts), iso_local(ts), text_to_ms(iso_local(ts)),
                                F.unix_millis(ts)).first()
    assert (row[0], row[1]) == (expected + "Z", expected)
    assert row[2] == row[3]
