"""The same results in SQL, for an engine that runs on one machine."""

from __future__ import annotations

from rollcall.schemas import EVENT_FIELDS, STORED_FIELDS

USERS = """
users as (
 select o_orderkey as user_key, c_name as first_name, concat('L', cast(c_custkey as string)) as last_name,
  case when o_orderkey % 50 = 0 then null else c_mktsegment end as gender,
  concat(cast(o_orderkey as string), ' ', n_name) as address, concat('City_', cast(c_nationkey as string)) as city,
  r_name as state, n_name as country, cast(c_nationkey as string) as post_code,
  concat(c_name, '@example.com') as email, concat('u', cast(o_orderkey * 7919 % 997 as string)) as username,
  concat(cast(cast(o_orderdate as date) as string), 'T05:00:00.000Z') as dob,
  case when o_orderkey % 97 = 0 then 'not-a-date'
       else concat(cast(cast(o_orderdate as date) as string), 'T23:30:00.000Z') end as registered_date,
  concat('0', cast(c_custkey as string)) as phone,
  concat('https://example.com/', cast(o_orderkey as string), '.jpg') as picture
 from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

_EVENT = ", ".join(EVENT_FIELDS)
_STORED = ", ".join(STORED_FIELDS)
_JSON = "to_json({" + ", ".join(f"'{name}': {name}" for name in EVENT_FIELDS) + "})"
_DIGEST = "md5(concat('users/', user_key % 8, '/', user_key // 8))"
_ID = (
    f"concat(substr({_DIGEST},1,8),'-',substr({_DIGEST},9,4),'-',substr({_DIGEST},13,4),'-',"
    f"substr({_DIGEST},17,4),'-',substr({_DIGEST},21,12))"
)


def _dates() -> str:
    return ", ".join(
        f"try_cast(replace({name}, 'Z', '') as timestamp) as {name}" if name in ("dob", "registered_date") else name
        for name in EVENT_FIELDS
    )


def _with_users(select: str, *more: str) -> str:
    return "with recursive " + ",".join((USERS, *more)) + "\n" + select


# All messages, and which of them arrive damaged: see messages() of the Spark side.
_DAMAGED = f"""
damaged as (
 select *, user_key % 101 = 0 as bad, (user_key // 101) % 5 as kind, {_JSON} as json from users)"""

_QUARANTINE = _with_users(
    """select 'users' as topic, cast(user_key % 8 as int) as "partition", user_key // 8 as "offset",
 case kind when 0 then concat('7B', hex(json)) when 1 then null when 2 then '' when 3 then concat(hex(json), 'FF')
  else concat('5B', hex(json), '5D') end as value_hex,
 case kind when 1 then 'null_value' when 2 then 'empty_value' when 3 then 'invalid_utf8' else 'malformed_json' end as reason
from damaged where bad""",
    _DAMAGED,
)

_STORE = _with_users(f"select {_ID} as id, {_STORED} from damaged where not bad", _DAMAGED)

_USER = """{'gender': gender, 'name': {'first': first_name, 'last': last_name},
  'location': {'street': {'number': user_key, 'name': country}, 'city': city, 'state': state, 'country': country,
   'postcode': cast(post_code as int)},
  'email': email, 'login': {'username': username}, 'dob': {'date': dob}, 'registered': {'date': registered_date}"""
_FULL_USER = _USER + """, 'phone': phone, 'picture': {'medium': picture}}"""
_USER_WITHOUT_PHONE = _USER + """, 'picture': {'medium': picture}}"""
_SECOND_USER = _FULL_USER.replace("'email': email", "'email': 'second@example.com'")

# The responses and what is wrong with them: see responses() of the Spark side.
_RESPONSES = f"""
texts as (
 select *, cast(case when user_key % 40 = 0 then '{{"results":[]}}'
  when user_key % 82 = 0 then '{{"results":[' || to_json({_FULL_USER}) || ',{{"location":"x"}}]}}'
  when user_key % 41 = 0 then to_json({{'results': [{_FULL_USER}, {_SECOND_USER}]}})
  when user_key % 43 = 0 then to_json({{'results': [{_USER_WITHOUT_PHONE}]}})
  else to_json({{'results': [{_FULL_USER}]}}) end as varchar) as text from users),
answered as (
 select * exclude (text), case when user_key % 47 = 0 then rtrim(text, '}}') when user_key % 53 = 0 then text || ' x' else text end as response,
  case when user_key % 47 = 0 or user_key % 53 = 0 then 'malformed_response' when user_key % 40 = 0 then 'no_result'
   when user_key % 43 = 0 and user_key % 41 <> 0 then 'missing:phone' end as reason
 from texts)"""

_VIOLATION = """
checked as (
 select *, case when gender is null then 'null:gender'
  when try_cast(replace(registered_date, 'Z', '') as timestamp) is null then 'date:registered_date' end as violation
 from users)"""


def _sequential(rows: str, order: str, first: str, second: str, first_type: str, second_type: str) -> str:
    """One row after the other, with the keys taken so far."""
    taken = f"list_contains(firsts, o.{first}) or list_contains(seconds, o.{second})"
    return f"""
o as materialized (
 select row_number() over (order by {order}) as rn, {order}, {first}, {second} from {rows}),
s(rn, firsts, seconds, won) as (
 select 0::bigint, []::{first_type}[], []::{second_type}[], null::bigint
 union all
 select o.rn,
  case when {taken} then firsts else list_append(firsts, o.{first}) end,
  case when {taken} then seconds else list_append(seconds, o.{second}) end,
  case when {taken} then null else o.{order} end
 from s join o on o.rn = s.rn + 1)"""


_USERS_ONE_BY_ONE = _sequential(
    "(select * from checked where violation is null)", "user_key", "email", "username", "varchar", "varchar"
)

_TOTALS = _with_users(
    """select 'country' as dim, country as k, count(*) as total from users group by country
union all select 'gender', gender, count(*) from users group by gender
union all select 'registration_year', cast(y as varchar), count(*)
 from (select year(try_cast(substr(registered_date, 1, 10) as date)) as y from users) group by y"""
)

ORACLES: dict[str, str] = {
    "load_users": _with_users("select * from users"),
    "raw_first_result": _with_users(
        """select user_key, case when found then email end as email,
 case when found then cast(user_key as varchar) end as street_number, case when found then post_code end as postcode,
 reason from (select *, reason is null or reason = 'missing:phone' as found from answered)""",
        _RESPONSES,
    ),
    "flatten_user": _with_users(f"select user_key, {_EVENT} from answered where reason is null", _RESPONSES),
    "unusable_responses": _with_users(
        "select user_key, response, reason from answered where reason is not null", _RESPONSES
    ),
    "encode_event": _with_users(f"select user_key, cast({_JSON} as varchar) as value from users"),
    "decode_event": _with_users(
        f"""select cast(user_key % 8 as int) as "partition", user_key // 8 as "offset", {_STORED}
from damaged where not bad""",
        _DAMAGED,
    ),
    "decode_event_all": _with_users(
        'select cast(user_key % 8 as int) as "partition", user_key // 8 as "offset", '
        + ", ".join(f"case when not bad or kind = 3 then {name} end as {name}" for name in STORED_FIELDS)
        + " from damaged",
        _DAMAGED,
    ),
    "quarantine": _QUARANTINE,
    "assign_id": _with_users(f"select {_ID} as id, {_STORED} from users"),
    "reject_nulls": _with_users(f"select user_key, {_dates()} from checked where violation is null", _VIOLATION),
    "constraint_violations": _with_users(
        """select user_key, violation from checked where violation is not null""", _VIOLATION
    ),
    "iso_date_cast": _with_users(
        """select user_key, try_cast(replace(dob, 'Z', '') as timestamp) as dob,
 try_cast(replace(registered_date, 'Z', '') as timestamp) as registered_date from users"""
    ),
    "unique_first_wins": """with recursive e as (
 select event_id, user_id, cast(json_extract_string(props, '$.k') as int) as k from events),"""
    + _sequential("e", "event_id", "user_id", "k", "bigint", "int")
    + "\nselect e.* from e join s on e.event_id = s.won",
    "constrained_users": _with_users(
        f"select user_key, {_dates()} from checked join s on user_key = s.won", _VIOLATION, _USERS_ONE_BY_ONE
    ),
    "rejected_users": _with_users(
        """select user_key, coalesce(violation, 'unique:email,username') as violation
from checked left join s on user_key = s.won where s.won is null""",
        _VIOLATION,
        _USERS_ONE_BY_ONE,
    ),
    "upsert_latest": _with_users(
        "select * from users qualify row_number() over (partition by email order by user_key desc) = 1"
    ),
    "count_by_country": _with_users("select country, count(*) as total from users group by country"),
    "count_by_gender": _with_users("select gender, count(*) as total from users group by gender"),
    "count_by_year": _with_users(
        """select cast(year(try_cast(substr(registered_date, 1, 10) as date)) as int) as registration_year,
 count(*) as total from users group by 1 order by 1 nulls last"""
    ),
    "chart_totals": _TOTALS,
    "share_by_country": _with_users(
        "select country, count(*) as total, round(count(*) / sum(count(*)) over (), 6) as share from users group by country"
    ),
    "distinct_countries": _with_users("select distinct country from users where country is not null"),
    "country_match": _with_users(
        """select country, count(*) as total,
 country in (select n_name from nation join region on n_regionkey = r_regionkey where r_name <> 'AFRICA') as matched
from users group by country"""
    ),
    "top_countries": _with_users(
        "select country, count(*) as total from users group by country order by total desc, country limit 5"
    ),
    "stream_decode": _STORE,
    "stream_quarantine": _QUARANTINE,
    "stream_sink_idempotent": _STORE,
    "stream_counts": _TOTALS,
    "stream_dedup": _with_users(
        """select email, cast(sent as varchar) as sent from (
 select email, d as sent, d - lag(d) over (partition by email order by d) as gap
 from (select distinct email, cast(replace(dob, 'Z', '') as date) as d from users))
where gap is null or gap > 30"""
    ),
    "stream_constrained": _with_users(
        f"select {_ID} as id, {_dates()} from checked join s on user_key = s.won", _VIOLATION, _USERS_ONE_BY_ONE
    ),
    "ddl_idempotent": _with_users(f"select {_EVENT} from users"),
}
