"""API responses to flat events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import street_address
from rollcall.schemas import USER_DDL

_CORRUPT = "_corrupt"

# Where a user record keeps each field of an event; the address is made of two parts. A record
# without one of these keys is unusable. One that has it as null is not, the NOT NULL check decides about it.
FIELD_PATHS = {
    "first_name": "name.first",
    "last_name": "name.last",
    "gender": "gender",
    "address": ("location.street.number", "location.street.name"),
    "city": "location.city",
    "state": "location.state",
    "country": "location.country",
    "post_code": "location.postcode",
    "email": "email",
    "username": "login.username",
    "dob": "dob.date",
    "registered_date": "registered.date",
    "phone": "phone",
    "picture": "picture.medium",
}
USER_PATHS = [path for paths in FIELD_PATHS.values() for path in ([paths] if isinstance(paths, str) else paths)]


def parse_responses(responses: DataFrame, column: str = "response") -> DataFrame:
    """Add ``user``, the first result of the response text, and ``reason`` where it cannot be used.

    Only the first result is read; later ones may have any shape. The text must be one JSON value and nothing
    after it.
    """
    # In brackets, so that text after the value is an error, and not left unread. The results stay text.
    body = F.from_json(F.concat(F.lit("["), F.col(column), F.lit("]")), "array<struct<results: array<string>>>")
    parsed = responses.withColumn("_body", body)
    malformed = F.col("_body").isNull() | (F.size("_body") != 1) | F.get("_body", F.lit(0)).isNull()
    # get() gives NULL on an empty array where [0] would end an ANSI job.
    first = F.get(F.get("_body", F.lit(0))["results"], F.lit(0))
    parsed = parsed.select(*responses.columns, malformed.alias("_malformed"), F.when(~malformed, first).alias("_first"))
    user = F.from_json("_first", f"{USER_DDL}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = parsed.withColumn("user", user)
    any_null = F.size(F.array_compact(F.array(*(_at(path) for path in USER_PATHS)))) < len(USER_PATHS)
    parsed = parsed.withColumn("_missing", F.when(any_null, _missing_paths("_first")).otherwise(""))
    reason = (
        F.when(F.col("_malformed"), "malformed_response")
        .when(F.col("_first").isNull(), "no_result")
        .when(F.col(f"user.{_CORRUPT}").isNotNull(), "malformed_response")
        .when(F.col("_missing") != "", F.concat(F.lit("missing:"), F.col("_missing")))
    )
    usable = F.col("_first").isNotNull() & F.col(f"user.{_CORRUPT}").isNull()
    kept = F.when(usable, F.col("user").dropFields(_CORRUPT)).alias("user")
    return parsed.select(*responses.columns, kept, reason.alias("reason"))


def flatten_users(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One flat event per response that holds a usable user."""
    user = F.explode(F.when(F.col("reason").isNull(), F.array("user"))).alias("user")
    return parsed.select(*keep, user).select(*keep, *event_columns())


def unusable_responses(parsed: DataFrame, keep: tuple[str, ...] = ("response",)) -> DataFrame:
    """The responses `flatten_users` leaves out, with the reason."""
    reason = F.explode(F.when(F.col("reason").isNotNull(), F.array("reason")))
    return parsed.select(*keep, reason.alias("reason"))


def event_columns() -> list[Column]:
    return [
        (_at(paths) if isinstance(paths, str) else street_address(*map(_at, paths))).alias(field)
        for field, paths in FIELD_PATHS.items()
    ]


def _at(path: str) -> Column:
    return F.col(f"user.{path}")


def _missing_paths(first: str) -> Column:
    """The paths the first result lacks. Its text is searched again only for values that are NULL.

    One expression over an array: spelled out per path, the generated code grows too large to be compiled.
    """
    parts = [f"$.{path}".rpartition(".") for path in USER_PATHS]
    places = F.array(
        *(
            F.struct(
                F.lit(path).alias("path"),
                F.lit(parent).alias("parent"),
                F.lit(name).alias("name"),
                _at(path).isNull().alias("empty"),
            )
            for path, (parent, _, name) in zip(USER_PATHS, parts)
        )
    )

    def is_missing(place: Column) -> Column:
        text = F.when(place["parent"] == "$", F.col(first)).otherwise(F.call_function("get_json_object", F.col(first), place["parent"]))
        return ~F.coalesce(F.array_contains(F.json_object_keys(text), place["name"]), F.lit(False))

    empty = F.filter(places, lambda place: place["empty"])
    return F.array_join(F.transform(F.filter(empty, is_missing), lambda place: place["path"]), ",")
