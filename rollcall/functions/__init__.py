from rollcall.functions.dates import naive_timestamp, registration_year
from rollcall.functions.identity import position_id, stable_id
from rollcall.functions.text import street_address

__all__ = ["naive_timestamp", "position_id", "registration_year", "stable_id", "street_address"]
