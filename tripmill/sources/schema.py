"""Declared schemas of all layers and of the monthly source files.

Names, types and order of the layers' columns are fixed values: they have to be those
of the tables that other systems read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql.types import StructType

from tripmill.functions.identity import AMOUNTS, FEE_COLUMN, FEE_YEAR, TIMES, row_columns

FIRST_YEAR, LAST_YEAR = 2019, 2099


class ContractError(ValueError):
    """A source, a request or a state is not what the pipeline accepts."""


class ConflictError(ContractError):
    """Another writer was faster; another attempt can succeed."""


@dataclass(frozen=True)
class TableSpec:
    namespace: str
    name: str
    columns: tuple[tuple[str, str], ...]
    partitions: tuple[str, ...] = ()
    #: what a merge compares, and ordered columns that follow from it
    key: str | None = None
    ranges: tuple[str, ...] = ()

    @property
    def identifier(self) -> str:
        return f"{self.namespace}.{self.name}"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))


def _source_type(name: str) -> str:
    if name in TIMES:
        return "timestamp"
    if name in AMOUNTS:
        return "double"
    return {"PULocationID": "int", "DOLocationID": "int", "trip_time": "bigint"}.get(name, "string")


SOURCE = tuple((c, _source_type(c)) for c in row_columns(FEE_YEAR - 1))
INGESTION = (("_source_uri", "string"), ("_source_file", "string"), ("_source_year", "int"), ("_source_month", "int"), ("_source_checksum", "string"), ("_ingestion_run_id", "string"), ("_ingested_at", "timestamp"))
IDENTITY = (("row_id", "string"), ("business_trip_key", "string"), ("identity_policy_version", "string"))

BRONZE_TRIPS = TableSpec("bronze", "bronze_hvfhs_trips", SOURCE + INGESTION + IDENTITY, ("_source_year", "_source_month"))
BRONZE_ZONES = TableSpec("bronze", "bronze_taxi_zones", (("LocationID", "int"), ("Borough", "string"), ("Zone", "string"), ("service_zone", "string"), ("_source_uri", "string"), ("_source_checksum", "string"), ("_ingested_at", "timestamp")))
SILVER_TRIPS = TableSpec(
    "silver",
    "silver_trips",
    (
        ("row_id", "string"), ("business_trip_key", "string"), ("identity_policy_version", "string"), ("operator_code", "string"),
        ("request_datetime", "timestamp"), ("pickup_datetime", "timestamp"), ("dropoff_datetime", "timestamp"),
        ("pickup_zone_id", "int"), ("dropoff_zone_id", "int"), ("trip_miles", "double"), ("trip_time_seconds", "bigint"),
        ("passenger_fare", "double"), ("tolls", "double"), ("sales_tax", "double"), ("tips", "double"), ("driver_pay", "double"),
        ("shared_request_flag", "string"), ("shared_match_flag", "string"),
        ("source_year", "int"), ("source_month", "int"), ("ingestion_run_id", "string"),
        ("trip_duration_minutes", "double"), ("pickup_date", "date"), ("pickup_hour", "int"),
    ),
    ("source_year", "source_month"),
)
QUARANTINE = TableSpec("silver", "quarantine_trips", BRONZE_TRIPS.columns + (("pickup_zone_id", "int"), ("dropoff_zone_id", "int"), ("reason_code", "string")), ("_source_year", "_source_month"))
MANIFEST = TableSpec(
    "ops",
    "source_run_manifest",
    (
        ("source_uri", "string"), ("source_checksum", "string"), ("source_size_bytes", "bigint"), ("source_year", "int"), ("source_month", "int"),
        ("ingestion_run_id", "string"), ("identity_policy_version", "string"), ("run_status", "string"),
        ("first_seen_at", "timestamp"), ("updated_at", "timestamp"),
        ("bronze_row_count", "bigint"), ("silver_row_count", "bigint"), ("quarantine_row_count", "bigint"),
        ("bronze_snapshot_id", "string"), ("silver_snapshot_id", "string"), ("quarantine_snapshot_id", "string"),
        ("failure_stage", "string"), ("failure_message", "string"), ("completed_at", "timestamp"),
    ),
    ("source_year", "source_month"),
)
FACT = TableSpec(
    "gold",
    "fct_trips",
    (
        ("row_id", "string"), ("business_trip_key", "string"), ("identity_policy_version", "string"), ("operator_code", "string"), ("pickup_date_key", "int"),
        ("pickup_zone_id", "int"), ("dropoff_zone_id", "int"), ("request_datetime", "timestamp"), ("pickup_datetime", "timestamp"), ("dropoff_datetime", "timestamp"),
        ("pickup_hour", "int"), ("trip_miles", "double"), ("trip_time_seconds", "bigint"), ("trip_duration_minutes", "double"),
        ("passenger_fare", "double"), ("tolls", "double"), ("sales_tax", "double"), ("tips", "double"), ("driver_pay", "double"),
        ("shared_request_flag", "string"), ("shared_match_flag", "string"), ("cbd_congestion_fee", "double"),
        ("source_year", "int"), ("source_month", "int"), ("ingestion_run_id", "string"),
    ),
    ("source_year", "source_month"),
    key="row_id",
    ranges=("pickup_datetime",),
)
_MONTH = (("source_year", "int"), ("source_month", "int"))
#: What each month adds to the dimensions of days and operators.
DAYS = TableSpec("gold", "dim_date_months", (("pickup_date", "date"), *_MONTH), ("source_year", "source_month"))
OPERATORS = TableSpec("gold", "dim_operator_months", (("operator_code", "string"), *_MONTH), ("source_year", "source_month"))
DIM_DATE = TableSpec(
    "gold",
    "dim_date",
    (
        ("date_key", "int"), ("calendar_date", "date"), ("calendar_year", "int"), ("calendar_month", "int"),
        ("day_of_month", "int"), ("day_of_week", "int"), ("day_name", "string"),
    ),
)
DIM_OPERATOR = TableSpec("gold", "dim_operator", (("operator_code", "string"),))
DIM_ZONE = TableSpec("gold", "dim_zone", (("zone_id", "int"), ("borough", "string"), ("zone_name", "string"), ("service_zone", "string")))
HOURLY = TableSpec(
    "gold",
    "mart_hourly_zone_demand",
    (
        ("hourly_zone_key", "string"), *_MONTH, ("pickup_date_key", "int"), ("pickup_hour", "int"), ("pickup_zone_id", "int"),
        ("trip_count", "bigint"), ("total_trip_miles", "double"), ("average_passenger_fare", "double"), ("total_driver_pay", "double"),
    ),
    ("source_year", "source_month"),
)
METRICS = TableSpec(
    "gold",
    "mart_operator_metrics",
    (
        ("operator_month_key", "string"), *_MONTH, ("operator_code", "string"), ("trip_count", "bigint"), ("average_passenger_fare", "double"),
        ("total_passenger_fare", "double"), ("total_driver_pay", "double"), ("total_tips", "double"), ("average_trip_miles", "double"),
    ),
    ("source_year", "source_month"),
)
TABLES = (BRONZE_TRIPS, BRONZE_ZONES, SILVER_TRIPS, QUARANTINE, MANIFEST)
#: The one schema change: tables that get a nullable fee column.
EVOLVED = (BRONZE_TRIPS, SILVER_TRIPS, QUARANTINE)
FEE = (FEE_COLUMN, "double")


def check_month(year: int, month: int) -> None:
    if not FIRST_YEAR <= year <= LAST_YEAR:
        raise ContractError(f"year must be between {FIRST_YEAR} and {LAST_YEAR}")
    if not 1 <= month <= 12:
        raise ContractError("month must be between 1 and 12")


def required_columns(year: int) -> frozenset[str]:
    if year < FIRST_YEAR:
        raise ContractError(f"source files are supported from {FIRST_YEAR} on")
    return frozenset(row_columns(year))


def check_columns(columns: Iterable[str], year: int) -> None:
    """Refuse a source that lacks a column of its year; more columns are no error here."""
    if missing := sorted(required_columns(year) - set(columns)):
        raise ContractError(f"missing required source columns: {', '.join(missing)}")
