"""What a message may hold, and what becomes of it."""

import json

import pytest
from helpers import event, messages, plan
from pyspark.sql import functions as F

from rollcall.functions import position_id
from rollcall.operators.codec import encode, parse_messages, quarantine, records
from rollcall.schemas import DECODED, EVENT, STORED_FIELDS

GOOD = [
    (json.dumps(event(post_code=12345)), {"post_code": "12345"}),
    (json.dumps(event(post_code=True)), {"post_code": "true"}),
    (json.dumps(event(post_code=[1, 2])), {"post_code": "[1,2]"}),
    (json.dumps(event(post_code={"x": 1})), {"post_code": '{"x":1}'}),
    (json.dumps(event(post_code=None)), {"post_code": None}),
    (json.dumps(event(city="É")), {"city": "É"}),
    (json.dumps(event(city="É"), ensure_ascii=False), {"city": "É"}),
    (json.dumps({"city": "Oslo"}), {"city": "Oslo", "email": None}),
    ("{}", {"city": None}),
    (json.dumps({"City": "Oslo"}), {"city": None}),
    ('{"city":"a","city":"b"}', {"city": "b"}),
    ('{"city":"a"} trailing', {"city": "a"}),
    ('{"post_code":1.50}', {"post_code": "1.5"}),
]

BAD = [
    (None, "null_value"),
    ("", "empty_value"),
    (b"\xffA", "invalid_utf8"),
    ("{bad", "malformed_json"),
    ('{"city":"Oslo"', "malformed_json"),
    ('"text"', "malformed_json"),
    ("[]", "malformed_json"),
    ('[{"city":"a"}]', "malformed_json"),
    ('[{"city":"a"},{"city":"b"}]', "malformed_json"),
    ("null", "malformed_json"),
    ("   ", "malformed_json"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    return parse_messages(messages(spark, [value for value, _ in GOOD] + [value for value, _ in BAD])).cache()


def test_readable_messages(parsed):
    found = {row.offset: row for row in records(parsed).collect()}
    assert sorted(found) == list(range(len(GOOD)))
    for offset, (value, expected) in enumerate(GOOD):
        for name, content in expected.items():
            assert found[offset][name] == content, value


def test_unreadable_messages_keep_bytes_position_and_reason(parsed):
    found = {row.offset: row for row in quarantine(parsed).collect()}
    assert len(found) == len(BAD)
    for offset, (value, reason) in enumerate(BAD, len(GOOD)):
        raw = value.encode() if isinstance(value, str) else value
        assert found[offset].reason == reason, value
        assert (None if found[offset].value is None else bytes(found[offset].value)) == raw
        assert (found[offset].topic, found[offset].partition) == ("users", 0)


def test_columns_are_the_stored_fields_in_order(parsed):
    assert records(parsed, keep=()).columns == list(STORED_FIELDS)


def test_unreadable_messages_can_be_kept_as_rows_of_nulls(parsed):
    rows = records(parsed, keep=("offset",), include_unreadable=True).collect()
    assert len(rows) == len(GOOD) + len(BAD)
    malformed = [row for row in rows if row.offset == len(GOOD) + 3]
    assert all(malformed[0][name] is None for name in STORED_FIELDS)


def test_encode_keeps_nulls_and_decodes_to_the_same_record(spark):
    rows = [event(), event(gender=None, city='É "quoted" \\ \n')]
    events = spark.createDataFrame(rows, EVENT)
    encoded = encode(events)
    texts = [bytes(row.value).decode() for row in encoded.collect()]
    assert [json.loads(text) for text in texts] == rows
    decoded = events.sparkSession.createDataFrame(encoded.collect(), "value binary")
    back = records(parse_messages(decoded, EVENT, keep=()), keep=())
    assert [row.asDict() for row in back.collect()] == rows


def test_no_python_worker_and_one_parse(spark):
    topic = messages(spark, ["{}"]).withColumn("id", position_id())
    for output in (records, quarantine):
        text = plan(output(parse_messages(topic, DECODED, keep=("id",)), keep=("id",)))
        assert "EvalPython" not in text and "InPandas" not in text
        assert "Filter" not in text
        assert "Exchange" not in text
        # explain repeats an operator's input and output, but only the Project that parses names from_json
        assert text.count("from_json(") == 1


def test_ids_are_stable_and_uuid_shaped(spark):
    topic = messages(spark, ["{}"] * 50).withColumn("id", position_id())
    once = [row.id for row in topic.orderBy("offset").collect()]
    again = [row.id for row in topic.repartition(3).orderBy("offset").collect()]
    assert once == again
    assert len(set(once)) == 50
    assert topic.filter(~F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).count() == 0
