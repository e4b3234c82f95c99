"""The users of the driver queries, derived from the given order and customer tables.

One order stands for one registration. Dirt is part of the data: every 50th gender is NULL, every 97th
registration date cannot be read, e-mails repeat per customer, user names collide modulo 997.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.codec import json_bytes
from rollcall.schemas import MESSAGE
from rollcall.sources.tables import table, table_stream


def users(spark: SparkSession, folder: str) -> DataFrame:
    return _join_users(spark, folder, table(spark, folder, "orders"))


def users_stream(spark: SparkSession, folder: str, **options) -> DataFrame:
    return _join_users(spark, folder, table_stream(spark, folder, "orders", **options))


def _join_users(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Broadcasts are left to Spark's size check, customers with many orders to its skew join.

    Places join last, so that their names do not travel through the shuffle on the customer.
    """
    customer, nation, region = (table(spark, folder, name) for name in ("customer", "nation", "region"))
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        key.alias("user_key"),
        F.col("c_name").alias("first_name"),
        F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("last_name"),
        F.when(key % 50 != 0, F.col("c_mktsegment")).alias("gender"),
        F.concat(key.cast("string"), F.lit(" "), F.col("n_name")).alias("address"),
        F.concat(F.lit("City_"), F.col("c_nationkey").cast("string")).alias("city"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("country"),
        F.col("c_nationkey").cast("string").alias("post_code"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("u"), (key * 7919 % 997).cast("string")).alias("username"),
        F.concat(day, F.lit("T05:00:00.000Z")).alias("dob"),
        F.when(key % 97 == 0, "not-a-date")
        .otherwise(F.concat(day, F.lit("T23:30:00.000Z")))
        .alias("registered_date"),
        F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("phone"),
        F.concat(F.lit("https://example.com/"), key.cast("string"), F.lit(".jpg")).alias("picture"),
    )


def responses(users: DataFrame) -> DataFrame:
    """Each user as an API response text.

    Every 40th response has no result, every 41st two of them, the second of every 82nd being no user at all, every
    43rd lacks the phone, every 47th is cut off at its end, and every 53rd is followed by other text.
    """
    key = F.col("user_key")
    text = (
        F.when(key % 40 == 0, _response(F.slice(F.array(_user()), 1, 0)))
        .when(key % 82 == 0, F.concat(F.lit('{"results":['), _json(_user()), F.lit(',{"location":"x"}]}')))
        .when(key % 41 == 0, _response(F.array(_user(), _user().withField("email", F.lit("second@example.com")))))
        .when(key % 43 == 0, _response(F.array(_user().dropFields("phone"))))
        .otherwise(_response(F.array(_user())))
    )
    whole = F.when(key % 47 == 0, F.rtrim(text, F.lit("}"))).when(key % 53 == 0, F.concat(text, F.lit(" x"))).otherwise(text)
    return users.select("user_key", whole.alias("response"))


def _response(results: Column) -> Column:
    return _json(F.struct(results.alias("results")))


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _user() -> Column:
    return F.struct(
        "gender",
        F.struct(F.col("first_name").alias("first"), F.col("last_name").alias("last")).alias("name"),
        F.struct(
            F.struct(F.col("user_key").alias("number"), F.col("country").alias("name")).alias("street"),
            "city",
            "state",
            "country",
            F.col("post_code").cast("int").alias("postcode"),
        ).alias("location"),
        "email",
        F.struct("username").alias("login"),
        F.struct(F.col("dob").alias("date")).alias("dob"),
        F.struct(F.col("registered_date").alias("date")).alias("registered"),
        "phone",
        F.struct(F.col("picture").alias("medium")).alias("picture"),
    )


def messages(users: DataFrame, damaged: bool = False) -> DataFrame:
    """Each user as a message with the columns of the Kafka source, on 8 partitions of one topic.

    With ``damaged``, every 101st message is unreadable, in one of five ways.
    """
    key = F.col("user_key")
    value = json_bytes()
    if damaged:
        value = F.when(key % 101 != 0, value).otherwise(_damage(value, F.expr("user_key div 101") % 5))
    return users.select(
        "user_key",
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit("users").alias("topic"),
        (key % 8).cast("int").alias("partition"),
        F.expr("user_key div 8").alias("offset"),
        F.col("dob").try_cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


# Parts in which a topic is published, one after the other, and files of each.
PARTS, FILES = 4, 8


def publish_topic(
    spark: SparkSession, folder: str, path: str, damaged: bool = False, *, by_time: bool = False, by_key: bool = False, copies: int = 1
) -> str:
    """All users as a file-backed topic at ``path``, to be read as the Kafka source would be.

    They are published in PARTS parts of FILES files: by time or key, where messages are to arrive in that order. Messages
    without a time come first. Each part is made from its orders, so no message is written twice, and copies are made
    after the messages were dealt to files.
    """
    given = users(spark, folder)
    again = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    # A file stream takes files in the order in which they were written, so a part's files come after those before it.
    for part in _parts(given, by_time, by_key):
        published = messages(given.filter(part), damaged).select(*MESSAGE.names).repartition(FILES)
        published.select("*", again.alias("copy")).drop("copy").write.mode("append").parquet(path)
    return path


def _parts(given: DataFrame, by_time: bool, by_key: bool) -> list[Column]:
    """What the users of each part fulfil. A range is compared with its ends only, which Spark tests before it joins."""
    if not (by_time or by_key):
        return [F.pmod(F.xxhash64("user_key"), F.lit(PARTS)) == part for part in range(PARTS)]
    value = F.unix_micros(F.col("dob").try_cast("timestamp")) if by_time else F.col("user_key")
    ends = given.select(F.min(value).alias("low"), F.max(value).alias("high")).first()
    low, high = ends.low or 0, (ends.high or 0) + 1
    starts = [F.lit(low + -(-(high - low) * part // PARTS)).cast("long") for part in range(1, PARTS)]
    between = [(value >= start) & (value < end) for start, end in zip(starts, starts[1:], strict=False)]
    return [value.isNull() | (value < starts[0]), *between, value >= starts[-1]]


def _damage(value: Column, kind: Column) -> Column:
    def around(before: str, after: str = "") -> Column:
        return F.concat(F.unhex(F.lit(before.encode().hex())), value, F.unhex(F.lit(after.encode().hex())))

    return (
        F.when(kind == 0, around("{"))
        .when(kind == 1, F.lit(None).cast("binary"))
        .when(kind == 2, F.lit("").cast("binary"))
        .when(kind == 3, F.concat(value, F.unhex(F.lit("FF"))))
        .otherwise(around("[", "]"))
    )
