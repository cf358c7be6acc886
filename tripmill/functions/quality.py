"""The ordered quality policy: the first rule that holds names the reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The codes, in the order in which they apply.
DUPLICATE = "DUPLICATE_ROW_ID"
NUMERIC = "MISSING_OR_INVALID_NUMERIC"
NEGATIVE = {
    "trip_miles": "NEGATIVE_TRIP_MILES",
    "trip_time": "NEGATIVE_TRIP_TIME",
    "base_passenger_fare": "NEGATIVE_PASSENGER_FARE",
    "tolls": "NEGATIVE_TOLLS",
    "sales_tax": "NEGATIVE_SALES_TAX",
    "tips": "NEGATIVE_TIPS",
    "driver_pay": "NEGATIVE_DRIVER_PAY",
}
REASONS = (
    "MISSING_OR_INVALID_TIMESTAMP",
    "PICKUP_BEFORE_REQUEST",
    "DROPOFF_BEFORE_PICKUP",
    "INVALID_ZONE_ID",
    "UNKNOWN_PICKUP_ZONE",
    "UNKNOWN_DROPOFF_ZONE",
    NUMERIC,
    *NEGATIVE.values(),
    DUPLICATE,
)


def rules() -> dict[str, Column]:
    """Each reason's predicate over a trip joined with its two zones; all but the duplicates."""
    asked, picked, dropped = (F.col(f"{x}_datetime") for x in ("request", "pickup", "dropoff"))
    any_of = lambda tests: F.greatest(*(F.coalesce(t, F.lit(False)) for t in tests))
    odd = lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return {
        "MISSING_OR_INVALID_TIMESTAMP": asked.isNull() | picked.isNull() | dropped.isNull(),
        "PICKUP_BEFORE_REQUEST": picked < asked,
        "DROPOFF_BEFORE_PICKUP": dropped < picked,
        "INVALID_ZONE_ID": F.col("PULocationID").try_cast("int").isNull() | F.col("DOLocationID").try_cast("int").isNull(),
        "UNKNOWN_PICKUP_ZONE": F.col("pickup_zone_id").isNull(),
        "UNKNOWN_DROPOFF_ZONE": F.col("dropoff_zone_id").isNull(),
        NUMERIC: any_of(odd(F.col(c).try_cast("double")) for c in NEGATIVE),
        **{code: F.col(c).try_cast("double") < 0 for c, code in NEGATIVE.items()},
    }


def reason() -> Column:
    """The first reason whose rule holds, null for a valid trip."""
    found, known = None, rules()
    for code in REASONS:
        if code in known:
            found = (F if found is None else found).when(known[code], F.lit(code))
    return found
