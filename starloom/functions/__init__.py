"""Column -> Column helpers (built-in Spark expressions only, no UDFs)."""

from starloom.functions.calendar import (
    date_key,
    date_name,
    date_part,
    day_spine,
    day_spine_covering,
    is_weekend,
    iso_day_of_week,
)
from starloom.functions.keys import hash_pii, md5_hex, packed_text, surrogate_key, unpacked_text
from starloom.functions.masking import email_domain, mask_email, mask_phone
from starloom.functions.money import money, to_money
from starloom.functions.timefmt import iso_millis, millis_between

__all__ = [
    "date_key", "date_name", "date_part", "day_spine", "day_spine_covering", "is_weekend", "iso_day_of_week",
    "hash_pii", "md5_hex", "packed_text", "surrogate_key", "unpacked_text", "email_domain", "mask_email", "mask_phone",
    "money", "to_money", "iso_millis", "millis_between",
]
