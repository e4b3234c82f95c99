"""Small helpers shared by the tests."""

from __future__ import annotations

import contextlib
import io
import json

from rollcall.schemas import EVENT_FIELDS


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def event(**changes) -> dict:
    values = {name: name for name in EVENT_FIELDS}
    values |= {"dob": "1980-02-03T04:05:06.789Z", "registered_date": "2007-12-31T23:30:00.000Z"}
    return values | changes


def response(**changes) -> dict:
    user = {
        "gender": "female",
        "name": {"title": "Ms", "first": "Ada", "last": "Élan"},
        "location": {
            "street": {"number": 12, "name": "High Street"},
            "city": "Oslo",
            "state": "Oslo",
            "country": "Norway",
            "postcode": 150,
        },
        "email": "ada@example.com",
        "login": {"username": "ada", "password": "x"},
        "dob": {"date": "1980-02-03T04:05:06.789Z", "age": 44},
        "registered": {"date": "2007-12-31T23:30:00.000Z", "age": 17},
        "phone": "0123",
        "picture": {"large": "l.jpg", "medium": "m.jpg", "thumbnail": "t.jpg"},
    }
    return {"results": [user | changes], "info": {"page": 1}}


def messages(spark, values, start=0, topic="users"):
    """Kafka-shaped rows on one partition."""
    from rollcall.schemas import MESSAGE

    rows = []
    for offset, value in enumerate(values, start):
        if isinstance(value, dict):
            value = json.dumps(value)
        if isinstance(value, str):
            value = value.encode()
        rows.append((None, None if value is None else bytearray(value), topic, 0, offset, None, 0))
    return spark.createDataFrame(rows, MESSAGE)


def sequential(rows, taken=()):
    """The uniqueness rule, one row after the other: rows are (order, first key, second key)."""
    firsts, seconds = {a for a, _ in taken}, {b for _, b in taken}
    won = []
    for order, first, second in sorted(rows):
        if first not in firsts and second not in seconds:
            firsts.add(first)
            seconds.add(second)
            won.append(order)
    return won
