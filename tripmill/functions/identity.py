"""Versioned content identity of a trip, as Spark expressions.

A value's canonical text is hashed with the texts of the other identity
columns in a fixed order. A value that cannot be read in its class (NaN as a
decimal) has no text and drops out of the hash; neither the separator nor the
null token is escaped. Both are part of the identity as published and stay.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# They enter published hashes and must not change.
NULL_TOKEN = "<NULL>"
SEPARATOR = "\x1f"
ROW_POLICY_2024 = "nyc-hvfhv-row-v1-2024"
ROW_POLICY_2025 = "nyc-hvfhv-row-v1-2025"
BUSINESS_POLICY = "nyc-hvfhv-business-v1"
FEE_COLUMN = "cbd_congestion_fee"
FEE_YEAR = 2025
TIMES = ("request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime")
WHOLE_NUMBERS = ("PULocationID", "DOLocationID", "trip_time")
AMOUNTS = ("trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay", FEE_COLUMN)
ROW_COLUMNS = (
    "hvfhs_license_num", "dispatching_base_num", "originating_base_num",
    "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime",
    "PULocationID", "DOLocationID", "trip_miles", "trip_time",
    "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay",
    "shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag",
)
BUSINESS_COLUMNS = ("hvfhs_license_num", "dispatching_base_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID")


def row_columns(year: int) -> tuple[str, ...]:
    return ROW_COLUMNS + (FEE_COLUMN,) * (year >= FEE_YEAR)


def policy(year: int) -> str:
    return ROW_POLICY_2025 if year >= FEE_YEAR else ROW_POLICY_2024


#: How the text of a value is read in each class; of all other columns it is the trimmed text itself.
_READ = {
    TIMES: lambda value: F.date_format(value.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    WHOLE_NUMBERS: lambda value: value.try_cast("decimal(38,0)").cast("string"),
    AMOUNTS: lambda value: value.try_cast("decimal(38,6)").cast("string"),
}


#: Numbers below this are NEAR their millionths, where they are within NEAR of a whole one, whatever the order of rounding.
MOST, NEAR = 1e8, 0.25


def is_millionths(value: Column) -> Column:
    """Whether a double's millionths, to the nearest one, are ``millionths(value)``; if not, they are to be read as a decimal.

    The text of a double, and a product with it, are each off by half a place of its 53 bits
    at most: under 0.03 millionths below MOST, so both round to the same one unless they are between two.
    """
    scaled = value * F.lit(1e6)
    return (F.abs(value) < F.lit(MOST)) & (F.abs(scaled - F.rint(scaled)) < F.lit(NEAR))


def millionths(value: Column) -> Column:
    return F.rint(value * F.lit(1e6)).cast("bigint")


def _amount(value: Column) -> Column:
    """The text of a double as decimal(38,6), without making a decimal of most."""
    n = millionths(value)
    digits = F.abs(n)
    after = F.substring((digits % F.lit(1_000_000) + F.lit(1_000_000)).cast("string"), 2, 6)
    text = F.concat(F.when(n < 0, F.lit("-")).otherwise(F.lit("")), F.floor(digits / F.lit(1_000_000)).cast("string"), F.lit("."), after)
    return F.when(is_millionths(value), text).otherwise(_READ[AMOUNTS](value))


#: The same texts, made in a shorter way of values of these types.
_SHORT = {
    TIMES: {},
    WHOLE_NUMBERS: dict.fromkeys(("tinyint", "smallint", "int", "bigint"), lambda value: value.cast("string")),
    AMOUNTS: {"double": _amount},
}


#: Types whose values have a text that is never empty, so that only nulls are absent.
_NEVER_EMPTY = ("timestamp", "timestamp_ntz", "date", "tinyint", "smallint", "int", "bigint", "float", "double")


def canonical(name: str, kind: str | None = None) -> Column:
    """A column's canonical text; null where the value cannot be read in its class.

    With the column's type, no text is made of a number or a time only to see that it is not empty.
    """
    trimmed = F.trim(F.col(name).cast("string"))
    absent = F.col(name).isNull() if kind in _NEVER_EMPTY else F.coalesce(trimmed == "", F.lit(True))
    read = [_SHORT[names].get(kind, make)(F.col(name)) for names, make in _READ.items() if name in names] or [trimmed]
    return F.when(absent, F.lit(NULL_TOKEN)).otherwise(read[0])


def by_year(year: Column | int, before: Column | str, since: Column | str) -> Column:
    """``since`` from the fee's first year on, ``before`` else: for a literal year, or by a year column."""
    made = [x if isinstance(x, Column) else F.lit(x) for x in (before, since)]
    return made[year >= FEE_YEAR] if isinstance(year, int) else F.when(year >= FEE_YEAR, made[1]).otherwise(made[0])


def policy_column(year: Column | int) -> Column:
    return by_year(year, ROW_POLICY_2024, ROW_POLICY_2025)


def row_id(year: Column | int, kinds: dict[str, str] | None = None) -> Column:
    """The hash of all identity columns, whose types may be given. The fee has no text before its first year, so it drops out then."""
    kinds = kinds or {}
    texts = [canonical(c, kinds.get(c)) for c in ROW_COLUMNS]
    fee = canonical(FEE_COLUMN, kinds.get(FEE_COLUMN))
    if not isinstance(year, int):
        texts.append(F.when(year >= FEE_YEAR, fee))
    elif year >= FEE_YEAR:
        texts.append(fee)
    return F.sha2(F.concat_ws(SEPARATOR, policy_column(year), *texts), 256)


def business_key(kinds: dict[str, str] | None = None) -> Column:
    kinds = kinds or {}
    return F.sha2(F.concat_ws(SEPARATOR, F.lit(BUSINESS_POLICY), *(canonical(c, kinds.get(c)) for c in BUSINESS_COLUMNS)), 256)


def packed(text: Column) -> tuple[Column, Column]:
    """The bytes of a text of lower-case hexadecimal digits, as hashes are, and the text where it is none; one of both is null."""
    made = F.unhex(text)
    whole = F.coalesce(F.lower(F.hex(made)) == text, F.lit(False))
    return F.when(whole, made), F.when(~whole, text)


def run_id(uri: str, checksum: str, size: int, year: int, month: int) -> str:
    """The key of one immutable source file: the same file, the same key."""
    digest = hashlib.sha256(SEPARATOR.join(map(str, (uri, checksum, size, year, month))).encode()).hexdigest()
    return f"fhvhv-{year}-{month:02d}-{digest[:16]}"
