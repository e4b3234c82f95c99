"""Record shapes, declared once and shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# The field names of a user event, in the order events carry them.
EVENT_FIELDS = (
    "first_name",
    "last_name",
    "gender",
    "address",
    "city",
    "state",
    "country",
    "post_code",
    "email",
    "username",
    "dob",
    "registered_date",
    "phone",
    "picture",
)

# The date of birth stays out of the stream store.
STORED_FIELDS = tuple(name for name in EVENT_FIELDS if name != "dob")

# ISO texts in the event, timestamps without time zone in the constrained table.
DATE_FIELDS = ("dob", "registered_date")

# Where a message came from. The triple is unique per topic and never changes on a replay.
POSITION_FIELDS = ("topic", "partition", "offset")


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


EVENT = _strings(EVENT_FIELDS)
DECODED = _strings(STORED_FIELDS)
STORED = _strings(("id", *STORED_FIELDS))

# What the counts need of a message.
COUNTED = _strings(("gender", "country", "registered_date"))

# What tells whether a message was sent again.
ADDRESSED = _strings(("email",))

CONSTRAINED = T.StructType(
    [T.StructField("id", T.StringType())]
    + [
        T.StructField(name, T.TimestampNTZType() if name in DATE_FIELDS else T.StringType())
        for name in EVENT_FIELDS
    ]
)

# The part of an API response that events are made from. `number` and `postcode`
# arrive as numbers or texts; reading them as text accepts both.
USER_DDL = """
    gender string,
    name struct<first: string, last: string>,
    location struct<
      street: struct<number: string, name: string>,
      city: string, state: string, country: string, postcode: string>,
    email string,
    login struct<username: string>,
    dob struct<date: string>,
    registered struct<date: string>,
    phone string,
    picture struct<medium: string>
"""

# The columns Spark's Kafka source delivers; file-backed topics use the same shape.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
