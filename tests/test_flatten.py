import json

from helpers import response

from rollcall.operators.flatten import flatten_users, parse_responses, unusable_responses
from rollcall.schemas import EVENT_FIELDS
from rollcall.sources.responses import responses_from_files


def _parsed(spark, bodies):
    texts = [(i, body if isinstance(body, str) else json.dumps(body)) for i, body in enumerate(bodies)]
    return parse_responses(spark.createDataFrame(texts, "n int, response string"))


def test_flatten(spark):
    row = flatten_users(_parsed(spark, [response()])).first().asDict()
    assert list(row) == list(EVENT_FIELDS)
    assert row == {
        "first_name": "Ada",
        "last_name": "Élan",
        "gender": "female",
        "address": "12 High Street",
        "city": "Oslo",
        "state": "Oslo",
        "country": "Norway",
        "post_code": "150",
        "email": "ada@example.com",
        "username": "ada",
        "dob": "1980-02-03T04:05:06.789Z",
        "registered_date": "2007-12-31T23:30:00.000Z",
        "phone": "0123",
        "picture": "m.jpg",
    }


def test_text_postcode_and_first_of_two_results(spark):
    two = response(location=response()["results"][0]["location"] | {"postcode": "N1 9GU"})
    two["results"].append(response(email="other@example.com")["results"][0])
    row = flatten_users(_parsed(spark, [two])).collect()
    assert len(row) == 1
    assert (row[0].post_code, row[0].email) == ("N1 9GU", "ada@example.com")


def test_only_the_first_result_is_read(spark):
    good = response()["results"][0]
    bodies = [{"results": [good, {"location": "x"}]}, {"results": [good, 5]}, {"results": [{"location": "x"}, good]}]
    bodies += [json.dumps(response()) + tail for tail in (" x", ", 1", "\n", "{}")]
    parsed = _parsed(spark, bodies).select("n", "user.email", "reason").collect()
    assert {row.n for row in parsed if row.reason is None} == {0, 1, 5}
    assert all(row.email == "ada@example.com" for row in parsed if row.reason is None)
    assert {row.reason for row in parsed if row.n not in (0, 1, 5)} == {"malformed_response"}


def test_unusable_responses(spark):
    without_phone = response()
    del without_phone["results"][0]["phone"]
    without_first = response(name={"last": "Élan"})
    bodies = [
        {"results": []},
        {"error": "limit"},
        {"results": None},
        {"results": [None]},
        "{broken",
        "",
        without_phone,
        without_first,
        response(name=None),
        response(phone=None),
        response(),
    ]
    reasons = {row.n: row.reason for row in unusable_responses(_parsed(spark, bodies), keep=("n",)).collect()}
    assert reasons == {
        0: "no_result",
        1: "no_result",
        2: "no_result",
        3: "no_result",
        4: "malformed_response",
        5: "malformed_response",
        6: "missing:phone",
        7: "missing:name.first",
        8: "missing:name.first,name.last",
    }


def test_null_value_is_kept_for_the_not_null_check(spark):
    row = flatten_users(_parsed(spark, [response(phone=None)])).first()
    assert row.phone is None


def test_address_is_null_when_a_part_is(spark):
    place = response()["results"][0]["location"]
    no_number = response(location=place | {"street": {"number": None, "name": "High Street"}})
    assert flatten_users(_parsed(spark, [no_number])).first().address is None


def test_landed_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"r{i}.json").write_text(json.dumps(response(email=f"{i}@example.com"), indent=2))
    landed = responses_from_files(spark, str(tmp_path))
    events = flatten_users(parse_responses(landed), keep=("id", "arrival")).collect()
    assert {row.email for row in events} == {"0@example.com", "1@example.com", "2@example.com"}
    assert len({row.id for row in events}) == 3
    assert len({row.arrival for row in events}) == 3
