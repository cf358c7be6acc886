"""Every operator of the trip pipeline as a query over the test tables, with its SQL.

The queries call the library's operators on trips made from the order tables
(``sources.sample``). The SQL builds the same trips, keys and checks by itself, from
lists of its own, so that a wrong list in the library shows. A query that needs rows more than
once writes them to a folder of its own first.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.functions import identity
from tripmill.operators import bronze, checks, gold, silver
from tripmill.plans import manifest, release
from tripmill.plans.month import Lake
from tripmill.sources import sample, trips
from tripmill.sources.files import Files, SourceFile, file_name
from tripmill.sources.schema import FEE, MANIFEST, ContractError, TableSpec
from tripmill.sources.store import SnapshotTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- the SQL side

_H = "(l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 1000"
_TRIPS = f"""
lines AS (SELECT *, {_H} AS h, o_orderkey % 1440 AS base, CAST(2024 + o_orderkey % 2 AS INTEGER) AS y, 'B' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 5, '0') AS base_num
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
once AS (SELECT
    'HV000' || CAST(l_suppkey % 4 + 2 AS VARCHAR) AS hvfhs_license_num,
    base_num AS dispatching_base_num,
    CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE base_num END AS originating_base_num,
    o_orderdate + to_minutes(CAST(base AS BIGINT)) AS request_datetime,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE o_orderdate + to_minutes(CAST(base AS BIGINT)) END AS on_scene_datetime,
    CASE WHEN h = 1 THEN NULL ELSE o_orderdate + to_minutes(CAST(base + CASE WHEN h BETWEEN 2 AND 9 THEN -5 ELSE l_linenumber END AS BIGINT)) END AS pickup_datetime,
    o_orderdate + to_minutes(CAST(base + l_linenumber + CASE WHEN h BETWEEN 10 AND 19 THEN -10 ELSE l_quantity END AS BIGINT)) AS dropoff_datetime,
    CAST(CASE WHEN h BETWEEN 20 AND 29 THEN NULL WHEN h BETWEEN 30 AND 39 THEN 999 ELSE l_partkey % 25 END AS INTEGER) AS PULocationID,
    CAST(CASE WHEN h BETWEEN 40 AND 49 THEN 998 ELSE l_suppkey % 25 END AS INTEGER) AS DOLocationID,
    CASE WHEN h BETWEEN 50 AND 54 THEN CAST('NaN' AS DOUBLE) WHEN h BETWEEN 55 AND 59 THEN CAST('Infinity' AS DOUBLE) WHEN h BETWEEN 60 AND 64 THEN -1.0 ELSE l_quantity END AS trip_miles,
    CAST(CASE WHEN h BETWEEN 65 AND 69 THEN -60 ELSE l_quantity * 60 END AS BIGINT) AS trip_time,
    CASE WHEN h BETWEEN 70 AND 74 THEN -l_extendedprice ELSE l_extendedprice END AS base_passenger_fare,
    CASE WHEN h BETWEEN 75 AND 79 THEN -0.5 ELSE l_tax END AS tolls,
    l_discount AS bcf,
    CASE WHEN h BETWEEN 80 AND 84 THEN -0.5 ELSE l_tax END AS sales_tax,
    CAST(2.75 AS DOUBLE) AS congestion_surcharge,
    CAST(0 AS DOUBLE) AS airport_fee,
    CASE WHEN h BETWEEN 85 AND 89 THEN -0.5 ELSE l_discount END AS tips,
    CASE WHEN h BETWEEN 90 AND 94 THEN -0.5 ELSE l_extendedprice * CAST(0.7 AS DOUBLE) END AS driver_pay,
    l_returnflag AS shared_request_flag, l_linestatus AS shared_match_flag, 'N' AS access_a_ride_flag, 'N' AS wav_request_flag, 'N' AS wav_match_flag,
    CASE WHEN y >= 2025 THEN (h % 4) * CAST(0.25 AS DOUBLE) END AS cbd_congestion_fee,
    y AS _source_year, CAST(month(o_orderdate) AS INTEGER) AS _source_month, h
  FROM lines),
trips AS (SELECT * EXCLUDE (h) FROM once UNION ALL SELECT * EXCLUDE (h) FROM once WHERE h BETWEEN 900 AND 909),
zones AS (SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, 'Boro Zone' AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


# Fixed values of the contract, stated here once more for the SQL side alone.
_ROW = (
    "hvfhs_license_num dispatching_base_num originating_base_num request_datetime on_scene_datetime pickup_datetime dropoff_datetime PULocationID DOLocationID trip_miles trip_time "
    "base_passenger_fare tolls bcf sales_tax congestion_surcharge airport_fee tips driver_pay shared_request_flag shared_match_flag access_a_ride_flag wav_request_flag wav_match_flag"
).split()
_BUSINESS = "hvfhs_license_num dispatching_base_num request_datetime pickup_datetime dropoff_datetime PULocationID DOLocationID".split()
_FEE = "cbd_congestion_fee"
_POLICY = {2024: "nyc-hvfhv-row-v1-2024", 2025: "nyc-hvfhv-row-v1-2025"}
_WHOLE = "PULocationID DOLocationID trip_time".split()
_DECIMAL = f"trip_miles base_passenger_fare tolls bcf sales_tax congestion_surcharge airport_fee tips driver_pay {_FEE}".split()
_NEGATIVE_REASONS = {c: f"NEGATIVE_{r}" for c, r in [("trip_miles", "TRIP_MILES"), ("trip_time", "TRIP_TIME"), ("base_passenger_fare", "PASSENGER_FARE"), ("tolls", "TOLLS"), ("sales_tax", "SALES_TAX"), ("tips", "TIPS"), ("driver_pay", "DRIVER_PAY")]}
_UNIQUE_KEYS = (
    "bronze_taxi_zones.LocationID silver_trips.row_id dim_operator.operator_code dim_zone.zone_id dim_date.date_key dim_date.calendar_date "
    "fct_trips.row_id mart_hourly_zone_demand.hourly_zone_key mart_operator_metrics.operator_month_key"
).split()
_PRESENT = _UNIQUE_KEYS + (
    "silver_trips.business_trip_key silver_trips.identity_policy_version silver_trips.pickup_datetime silver_trips.dropoff_datetime "
    "fct_trips.business_trip_key fct_trips.identity_policy_version fct_trips.operator_code fct_trips.pickup_date_key fct_trips.pickup_zone_id fct_trips.dropoff_zone_id "
    "fct_trips.passenger_fare fct_trips.driver_pay mart_hourly_zone_demand.trip_count mart_operator_metrics.trip_count"
).split()
_REFER = {"operator_code": "dim_operator.operator_code", "pickup_date_key": "dim_date.date_key", "pickup_zone_id": "dim_zone.zone_id", "dropoff_zone_id": "dim_zone.zone_id"}


def _text(name: str) -> str:
    if name.endswith("_datetime"):
        read = f"strftime({name}, '%Y-%m-%dT%H:%M:%S.%f')"
    elif name in _WHOLE:
        read = f"CAST(TRY_CAST({name} AS DECIMAL(38,0)) AS VARCHAR)"
    elif name in _DECIMAL:
        read = f"CAST(TRY_CAST({name} AS DECIMAL(38,6)) AS VARCHAR)"
    else:
        read = f"trim({name})"
    return f"CASE WHEN {name} IS NULL OR trim(CAST({name} AS VARCHAR)) = '' THEN '<NULL>' ELSE {read} END"


def _hash(prefix: str, names: list[str]) -> str:
    return f"sha256(concat_ws(chr(31), '{prefix}', {', '.join(map(_text, names))}))"


_BRONZE = f"""{_TRIPS},
bronze AS (SELECT *,
    CASE WHEN _source_year >= 2025 THEN {_hash(_POLICY[2025], [*_ROW, _FEE])} ELSE {_hash(_POLICY[2024], _ROW)} END AS row_id,
    {_hash('nyc-hvfhv-business-v1', _BUSINESS)} AS business_trip_key,
    CASE WHEN _source_year >= 2025 THEN '{_POLICY[2025]}' ELSE '{_POLICY[2024]}' END AS identity_policy_version
  FROM trips)"""

_ODD = " OR ".join(f"{c} IS NULL OR isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE))" for c in _NEGATIVE_REASONS)
_NEGATIVE = " ".join(f"WHEN {c} < 0 THEN '{r}'" for c, r in _NEGATIVE_REASONS.items())
_CLASSIFIED = f"""{_BRONZE},
joined AS (SELECT b.*, p.LocationID AS pickup_zone_id, d.LocationID AS dropoff_zone_id FROM bronze b LEFT JOIN zones p ON b.PULocationID = p.LocationID LEFT JOIN zones d ON b.DOLocationID = d.LocationID),
reasoned AS (SELECT *, CASE
    WHEN request_datetime IS NULL OR pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'MISSING_OR_INVALID_TIMESTAMP'
    WHEN pickup_datetime < request_datetime THEN 'PICKUP_BEFORE_REQUEST'
    WHEN dropoff_datetime < pickup_datetime THEN 'DROPOFF_BEFORE_PICKUP'
    WHEN PULocationID IS NULL OR DOLocationID IS NULL THEN 'INVALID_ZONE_ID'
    WHEN pickup_zone_id IS NULL THEN 'UNKNOWN_PICKUP_ZONE'
    WHEN dropoff_zone_id IS NULL THEN 'UNKNOWN_DROPOFF_ZONE'
    WHEN {_ODD} THEN 'MISSING_OR_INVALID_NUMERIC' {_NEGATIVE} END AS first_reason FROM joined),
numbered AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY request_datetime) AS rn FROM reasoned),
classified AS (SELECT * EXCLUDE (first_reason), CASE WHEN first_reason IS NULL AND rn > 1 THEN 'DUPLICATE_ROW_ID' ELSE first_reason END AS reason_code FROM numbered)"""

_SILVER = f"""{_CLASSIFIED},
silver AS (SELECT row_id, business_trip_key, identity_policy_version, hvfhs_license_num AS operator_code, request_datetime, pickup_datetime, dropoff_datetime,
    PULocationID AS pickup_zone_id, DOLocationID AS dropoff_zone_id, trip_miles, trip_time AS trip_time_seconds, base_passenger_fare AS passenger_fare,
    tolls, sales_tax, tips, driver_pay, shared_request_flag, shared_match_flag, _source_year AS source_year, _source_month AS source_month, 'run' AS ingestion_run_id,
    CAST(CAST(floor(epoch(dropoff_datetime)) AS BIGINT) - CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS DOUBLE) / 60 AS trip_duration_minutes,
    CAST(pickup_datetime AS DATE) AS pickup_date, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, cbd_congestion_fee
  FROM classified WHERE reason_code IS NULL)"""

_GOLD = f"""{_SILVER},
dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date, CAST(year(d) AS INTEGER) AS calendar_year, CAST(month(d) AS INTEGER) AS calendar_month,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(extract(dow FROM d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name
  FROM (SELECT DISTINCT pickup_date AS d FROM silver WHERE pickup_date IS NOT NULL)),
dim_operator AS (SELECT DISTINCT operator_code FROM silver WHERE operator_code IS NOT NULL),
dim_zone AS (SELECT CAST(LocationID AS INTEGER) AS zone_id, Borough AS borough, Zone AS zone_name, service_zone FROM zones WHERE LocationID IS NOT NULL),
fact AS (SELECT row_id, business_trip_key, identity_policy_version, operator_code, CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS pickup_date_key, pickup_zone_id, dropoff_zone_id,
    request_datetime, pickup_datetime, dropoff_datetime, pickup_hour, trip_miles, trip_time_seconds, trip_duration_minutes, passenger_fare, tolls, sales_tax, tips, driver_pay,
    shared_request_flag, shared_match_flag, CASE WHEN source_year >= 2025 THEN cbd_congestion_fee END AS cbd_congestion_fee, source_year, source_month, ingestion_run_id FROM silver)"""


def _sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,6))) AS DOUBLE)"


def _mean(c: str) -> str:
    return f"{_sum(c)} / count({c})"


_MARTS = f"""{_GOLD},
hourly AS (SELECT CAST(source_year AS VARCHAR) || '-' || lpad(CAST(source_month AS VARCHAR), 2, '0') || '-' || CAST(pickup_date_key AS VARCHAR) || '-' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || '-' || CAST(pickup_zone_id AS VARCHAR) AS hourly_zone_key,
    source_year, source_month, pickup_date_key, pickup_hour, pickup_zone_id, count(*) AS trip_count, {_sum('trip_miles')} AS total_trip_miles, {_mean('passenger_fare')} AS average_passenger_fare, {_sum('driver_pay')} AS total_driver_pay
  FROM fact GROUP BY source_year, source_month, pickup_date_key, pickup_hour, pickup_zone_id),
operators AS (SELECT CAST(source_year AS VARCHAR) || '-' || lpad(CAST(source_month AS VARCHAR), 2, '0') || '-' || operator_code AS operator_month_key,
    source_year, source_month, operator_code, count(*) AS trip_count, {_mean('passenger_fare')} AS average_passenger_fare, {_sum('passenger_fare')} AS total_passenger_fare,
    {_sum('driver_pay')} AS total_driver_pay, {_sum('tips')} AS total_tips, {_mean('trip_miles')} AS average_trip_miles
  FROM fact GROUP BY source_year, source_month, operator_code)"""

_NAMES = {"bronze_taxi_zones": "zones", "silver_trips": "silver", "fct_trips": "fact", "mart_hourly_zone_demand": "hourly", "mart_operator_metrics": "operators"}


def _relation(name: str) -> str:
    return _NAMES.get(name, name)


def _check_sql(kind: str, relation: str, column: str, failures: str) -> str:
    return f"SELECT '{kind}' AS kind, '{relation}' AS relation, '{column}' AS column_name, CAST(({failures}) AS BIGINT) AS failures"


_UNIQUE_SQL = [_check_sql("unique", r, c, f"SELECT count(*) FROM (SELECT {c} FROM {_relation(r)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for r, c in (x.split(".") for x in _UNIQUE_KEYS)]
_NOT_NULL_SQL = [_check_sql("not_null", r, c, f"SELECT count(*) FROM {_relation(r)} WHERE {c} IS NULL") for r, c in (x.split(".") for x in _PRESENT)]
_REFERENCE_SQL = [_check_sql("relationships", r, c, f"SELECT count(*) FROM {_relation(r)} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_relation(p)} y WHERE y.{k} = x.{c})") for r, c, p, k in (("fct_trips", c, *x.split(".")) for c, x in _REFER.items())]
_SINGULAR_SQL = [_check_sql("singular", "fct_trips", "fct_trips_reconciles_to_silver", "SELECT count(*) FROM (SELECT (SELECT count(*) FROM silver) AS a, (SELECT count(*) FROM fact) AS b) WHERE a <> b")]
_UNION = " UNION ALL "


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


# -------------------------------------------------------------- the Spark side


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_identity(sample.trips(spark, sf_dir), F.col("_source_year")).withColumn("_ingestion_run_id", F.lit("run"))


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their row_id as 32 bytes."""
    rows = bronze.with_row_id(sample.trips(spark, sf_dir), F.col("_source_year"))
    return rows.withColumn("row_id", F.unhex("row_id"))


def _whole(rows: DataFrame) -> DataFrame:
    """Numbered trips with row_id as text and the other columns of bronze."""
    rows = rows.withColumn("row_id", F.lower(F.hex("row_id")))
    return bronze.with_business(rows, F.col("_source_year")).withColumn("_ingestion_run_id", F.lit("run"))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips are numbered before anything is made of them but row_id, and that is 32 bytes then, so their one shuffle is of narrow rows."""
    numbered = silver.numbered(_identified(spark, sf_dir), ("request_datetime",))
    return silver.classify_numbered(_whole(numbered), sample.zones(spark, sf_dir))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for queries that want few columns: trips are judged first, so their one shuffle has no more than those."""
    return _whole(silver.judged(_identified(spark, sf_dir), sample.zones(spark, sf_dir), ("request_datetime",)))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver(_judged(spark, sf_dir))


def _stored(df: DataFrame) -> DataFrame:
    """df, written once, for queries that read it again."""
    path = f"{_state(df.sparkSession)}/rows"
    df.write.option("compression", "zstd").parquet(path)  # hashes as text have two bytes for one
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """row_id (as bytes) and columns of bronze from a stored table, whose rows have places."""
    rows = bronze.with_row_id(sample.trips(spark, sf_dir), F.col("_source_year"))
    rows = rows.select(F.unhex("row_id").alias("row_id"), *columns, "_source_year", "_source_month")
    spec = TableSpec("bronze", "trips", tuple(rows.dtypes), ("_source_year", "_source_month"))
    table = SnapshotTable(spark, _state(spark), spec).create()
    table.replace(rows)
    return table.read(places=True)


#: row_id as text again.
_ROW_ID = "lower(hex(row_id)) as row_id"


#: The columns of silver that data tests of each kind come to read, by themselves or through gold.
_TESTED = {
    "unique": ("row_id", "operator_code", "pickup_date", "pickup_hour", "pickup_zone_id", "source_year", "source_month"),
    "not_null": (
        *("row_id", "business_trip_key", "identity_policy_version", "operator_code", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour"),
        *("pickup_zone_id", "dropoff_zone_id", "passenger_fare", "driver_pay", "source_year", "source_month"),
    ),
    "relationships": ("operator_code", "pickup_date", "pickup_zone_id", "dropoff_zone_id"),
    "singular": (),
}


def _checked(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Data tests of some kinds; silver is stored for the models that read it, with the columns that they come to read, and null in the others."""
    made = _silver(spark, sf_dir)
    read = {c for k in kinds for c in _TESTED[k]}
    rows = _stored(made.select(*(c for c in made.columns if c in read)))
    whole = rows.select(*(F.col(n) if n in read else F.lit(None).cast(kind).alias(n) for n, kind in made.dtypes))
    return checks.all_checks(gold.build(whole, sample.zones(spark, sf_dir)), kinds)


def _state(spark: SparkSession) -> str:
    """A folder of its own for a query that builds tables, as a URI with its scheme, however the setting is written."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{Files(spark).qualified(shared).rstrip('/')}/state-{uuid.uuid4().hex}"


@_query(_with(_BRONZE, "SELECT row_id, business_trip_key, identity_policy_version, _source_year, _source_month FROM bronze"))
def bronze_identity(spark, sf_dir):
    """Canonical texts, both hashes and the policy of every trip."""
    return _bronze(spark, sf_dir).select("row_id", "business_trip_key", "identity_policy_version", "_source_year", "_source_month")


@_query(_with(_BRONZE, "SELECT _source_year, _source_month, count(*) AS trips, count(DISTINCT row_id) AS identities FROM bronze GROUP BY ALL"))
def bronze_profile(spark, sf_dir):
    """A3: rows and identities of each month."""
    return _bronze(spark, sf_dir).groupBy("_source_year", "_source_month").agg(F.count(F.lit(1)).alias("trips"), F.count_distinct("row_id").alias("identities"))


@_query(_with(_TRIPS, "SELECT LocationID, Borough, Zone, service_zone FROM zones"))
def zones_reference(spark, sf_dir):
    """The zone lookup, written as CSV and read back by the pipeline's reader."""
    path = f"{_state(spark)}/zones.csv"
    sample.zones(spark, sf_dir).write.option("header", True).csv(path)
    return trips.read_zones(spark, path)


_VALUES = "hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_time, driver_pay, shared_request_flag"
_URI = "'s3://landing/fhvhv_tripdata_' || _source_year || '-' || lpad(CAST(_source_month AS VARCHAR), 2, '0') || '.parquet'"
_RUN_ID = "'fhvhv-' || {y} || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || substr(sha256(concat_ws(chr(31), {uri}, repeat('a', 64), {size}, {y}, {m})), 1, 16)"


def _months() -> list[tuple[int, int]]:
    return [(y, m) for y in (2024, 2025) for m in range(1, 13)]


@_query(_with(_TRIPS, f"SELECT {_VALUES}, _source_year, _source_month, {_URI} AS _source_uri, repeat('a', 64) AS _source_checksum, {_RUN_ID.format(y='_source_year', m='_source_month', uri=_URI, size=1)} AS _ingestion_run_id, substr({_URI}, 14) AS file, TRUE AS is_new FROM trips"))
def month_with_source(spark, sf_dir):
    """Every month's file, read with its trips and the seven columns of its source."""
    folder = _state(spark)
    rows = sample.trips(spark, sf_dir)
    name = F.format_string("fhvhv_tripdata_%d-%02d.parquet", "_source_year", "_source_month")
    rows.withColumn("file", name).drop("_source_year", "_source_month").write.partitionBy("file").parquet(folder)
    made = []
    for year, month in _months():
        source = SourceFile(year, month, f"s3://landing/{file_name(year, month)}", "a" * 64, 1)
        source.validate()
        made.append(bronze.with_source(trips.read_month(spark, f"{folder}/file={file_name(year, month)}", year), source))
    both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made)
    named = F.regexp_extract("_source_file", "(fhvhv_tripdata_[0-9-]*[.]parquet)", 1)
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("_ingested_at")
    return both.select(*_VALUES.split(", "), "_source_year", "_source_month", "_source_uri", "_source_checksum", "_ingestion_run_id", named.alias("file"), age.between(0, 3600).alias("is_new"))


@_query(_with(_TRIPS, "SELECT count(*) AS row_count, count(DISTINCT LocationID) AS distinct_ids, CAST(count(*) FILTER (LocationID IS NULL) AS BIGINT) AS null_ids FROM zones"))
def zone_profile(spark, sf_dir):
    """A1: what the zone lookup must satisfy."""
    return bronze.profile_zones(sample.zones(spark, sf_dir))


def _zone_sql(own: str, zone: str) -> str:
    return _with(_TRIPS, f"SELECT {own}, z.LocationID AS {zone}, count(*) AS trips FROM trips LEFT JOIN zones z ON {own} = z.LocationID GROUP BY ALL")


@_query(_zone_sql("PULocationID", "pickup_zone_id"))
def zone_pickup_left_join(spark, sf_dir):
    """Trips with their pickup zone, where the lookup has it."""
    joined = silver.with_zones(sample.trips(spark, sf_dir), sample.zones(spark, sf_dir))
    return joined.groupBy("PULocationID", "pickup_zone_id").agg(F.count(F.lit(1)).alias("trips"))


@_query(_zone_sql("DOLocationID", "dropoff_zone_id"))
def zone_dropoff_left_join(spark, sf_dir):
    """Trips with their drop-off zone, where the lookup has it."""
    joined = silver.with_zones(sample.trips(spark, sf_dir), sample.zones(spark, sf_dir))
    return joined.groupBy("DOLocationID", "dropoff_zone_id").agg(F.count(F.lit(1)).alias("trips"))


@_query(_with(_CLASSIFIED, "SELECT row_id, first_reason AS reason_code FROM reasoned"))
def reason_classify(spark, sf_dir):
    """Q1-Q14: the first rule that each trip breaks."""
    joined = silver.with_zones(_bronze(spark, sf_dir), sample.zones(spark, sf_dir))
    return silver.with_reason(joined).select("row_id", "reason_code")


@_query(_with(_CLASSIFIED, "SELECT row_id, CAST(rn AS BIGINT) AS trip_row_number FROM numbered"))
def dedup_row_number(spark, sf_dir):
    """Trips numbered within their identity."""
    numbered = silver.numbered(_placed(spark, sf_dir, "request_datetime"), ("request_datetime",))
    return numbered.select(F.expr(_ROW_ID), F.col("_trip_row_number").cast("bigint").alias("trip_row_number"))


@_query(_with(_CLASSIFIED, "SELECT row_id, CAST(rn AS BIGINT) AS trip_row_number, reason_code FROM classified"))
def duplicate_override(spark, sf_dir):
    """Q15: valid trips that are not the first of their identity; they are judged first, so that their one shuffle has what is returned alone."""
    rows = silver.judged(_identified(spark, sf_dir), sample.zones(spark, sf_dir), ("request_datetime",))
    return rows.select(F.expr(_ROW_ID), F.col("_trip_row_number").cast("bigint").alias("trip_row_number"), "reason_code")


@_query(_with(_SILVER, "SELECT * FROM silver"))
def silver_trips(spark, sf_dir):
    """Valid trips in the silver columns."""
    return _silver(spark, sf_dir)


_QUARANTINE_COLUMNS = "row_id, business_trip_key, hvfhs_license_num, PULocationID, DOLocationID, pickup_zone_id, dropoff_zone_id, request_datetime, pickup_datetime, dropoff_datetime, trip_time, driver_pay, _source_year, _source_month, reason_code"


@_query(_with(_CLASSIFIED, f"SELECT {_QUARANTINE_COLUMNS} FROM classified WHERE reason_code IS NOT NULL"))
def quarantine_trips(spark, sf_dir):
    """Rejected trips with their reason (columns without NaN)."""
    return silver.quarantine(_classified(spark, sf_dir)).select(*_QUARANTINE_COLUMNS.split(", "))


@_query(_with(_CLASSIFIED, "SELECT reason_code, count(*) AS trips FROM classified WHERE reason_code IS NOT NULL GROUP BY reason_code ORDER BY reason_code"))
def quarantine_by_reason(spark, sf_dir):
    """Rejected trips of each reason."""
    return silver.by_reason(silver.quarantine(_classified(spark, sf_dir)))


@_query(_with(_CLASSIFIED, "SELECT count(*) AS bronze_count, CAST(count(*) FILTER (reason_code IS NULL) AS BIGINT) AS silver_count, CAST(count(*) FILTER (reason_code IS NOT NULL) AS BIGINT) AS quarantine_count FROM classified"))
def classified_counts(spark, sf_dir):
    """A2: all, valid and rejected trips."""
    return silver.counts(_classified(spark, sf_dir))


@_query(_with(_BRONZE, f"SELECT EXISTS (SELECT 1 FROM bronze WHERE _source_year = 2025 AND identity_policy_version IS DISTINCT FROM '{_POLICY[2025]}') AS mismatch_2025, EXISTS (SELECT 1 FROM bronze WHERE identity_policy_version IS DISTINCT FROM '{_POLICY[2025]}') AS mismatch_any"))
def policy_mismatch_exists(spark, sf_dir):
    """F2, A4: whether any row has another policy, in one month's year and in all."""
    rows = _bronze(spark, sf_dir)
    found = [not silver.other_policy(r, identity.ROW_POLICY_2025).isEmpty() for r in (rows.where("_source_year = 2025"), rows)]
    return spark.createDataFrame([tuple(found)], "mismatch_2025 boolean, mismatch_any boolean")


@_query(_with(_BRONZE, "SELECT row_id, request_datetime, pickup_datetime, dropoff_datetime FROM bronze WHERE _source_year = 2024 AND _source_month = 3"))
def month_scope_filter(spark, sf_dir):
    """F1, F8: the rows of one month."""
    rows = _bronze(spark, sf_dir).where("_source_year = 2024 and _source_month = 3")
    return rows.select("row_id", "request_datetime", "pickup_datetime", "dropoff_datetime")


@_query(_with(_GOLD, "SELECT * FROM dim_date"))
def dim_date(spark, sf_dir):
    """The calendar of pickup days."""
    return gold.dim_date(_silver(spark, sf_dir))


@_query(_with(_GOLD, "SELECT * FROM dim_operator"))
def dim_operator(spark, sf_dir):
    """The operators."""
    return gold.dim_operator(_silver(spark, sf_dir))


@_query(_with(_GOLD, "SELECT * FROM dim_zone"))
def dim_zone(spark, sf_dir):
    """The zones."""
    return gold.dim_zone(sample.zones(spark, sf_dir))


@_query(_with(_GOLD, "SELECT * FROM fact"))
def fct_trips(spark, sf_dir):
    """The fact table of all months."""
    return gold.fct_trips(_silver(spark, sf_dir))


@_query(_with(_GOLD, "SELECT * FROM fact WHERE source_year = 2025 AND source_month = 6"))
def fct_trips_month(spark, sf_dir):
    """One month's load of the fact table."""
    return gold.fct_trips(_silver(spark, sf_dir), 2025, 6)


_MERGED = "SELECT row_id, source_year, source_month, CASE WHEN source_month = 3 THEN tips + 1 ELSE tips END AS tips FROM fact WHERE source_year = 2024 AND source_month IN (2, 3)"


def _merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _stored(gold.fct_trips(_silver(spark, sf_dir)).where("source_year = 2024 and source_month in (2, 3)").select("row_id", "source_year", "source_month", "tips"))
    changed = rows.where("source_month = 3").withColumn("tips", F.col("tips") + 1)
    return rows.where("source_month = 2 or substr(row_id, 1, 1) < '8'"), changed


@_query(_with(_GOLD, _MERGED))
def fct_merge_upsert(spark, sf_dir):
    """A month merged over a table that has half of it."""
    return gold.upsert(*_merge_sides(spark, sf_dir))


_TIPS = TableSpec("gold", "tips", (("row_id", "string"), ("tips", "double"), ("source_year", "int"), ("source_month", "int")), ("source_year", "source_month"), key="row_id")


@_query(_with(_GOLD, _MERGED))
def fct_merge_stored(spark, sf_dir):
    """K11 on a snapshot table: the merge writes anew only the months it touches."""
    target, changed = _merge_sides(spark, sf_dir)
    table = SnapshotTable(spark, _state(spark), _TIPS).create()
    table.replace(target)
    table.merge(changed, "row_id")
    return table.read().select("row_id", "source_year", "source_month", "tips")


@_query(_with(_MARTS, "SELECT * FROM hourly"))
def mart_hourly_zone_demand(spark, sf_dir):
    """Demand of each hour and pickup zone."""
    return gold.mart_hourly_zone_demand(gold.fct_trips(_silver(spark, sf_dir)))


@_query(_with(_MARTS, "SELECT * FROM operators"))
def mart_operator_metrics(spark, sf_dir):
    """Money and miles of each operator and month."""
    return gold.mart_operator_metrics(gold.fct_trips(_silver(spark, sf_dir)))


@_query(_with(_MARTS, _UNION.join(_UNIQUE_SQL)))
def dq_unique(spark, sf_dir):
    """A10: the nine tests of uniqueness."""
    return _checked(spark, sf_dir, "unique")


@_query(_with(_MARTS, _UNION.join(_NOT_NULL_SQL)))
def dq_not_null(spark, sf_dir):
    """The 23 tests of presence."""
    return _checked(spark, sf_dir, "not_null")


@_query(_with(_MARTS, _UNION.join(_REFERENCE_SQL)))
def dq_relationships(spark, sf_dir):
    """The four tests of references."""
    return _checked(spark, sf_dir, "relationships")


@_query(_with(_MARTS, "SELECT silver_count, fact_count FROM (SELECT (SELECT count(*) FROM silver) AS silver_count, (SELECT count(*) FROM fact WHERE source_month <> 7) AS fact_count) WHERE silver_count <> fact_count"))
def dq_fct_reconciles(spark, sf_dir):
    """The counts' test, on a fact table that lacks a month."""
    rows = _stored(_silver(spark, sf_dir))
    return checks.same_count(rows, gold.fct_trips(rows).where("source_month <> 7"))


@_query(_with(_MARTS, _UNION.join([*_UNIQUE_SQL, *_NOT_NULL_SQL, *_REFERENCE_SQL, *_SINGULAR_SQL])))
def dq_summary(spark, sf_dir):
    """All 37 data tests."""
    return _checked(spark, sf_dir, *checks.KINDS)


_COUNTS_SQL = "(SELECT count(*) FROM bronze WHERE _source_year = 2024 AND _source_month = 5) AS bronze_row_count, (SELECT count(*) FROM silver WHERE source_year = 2024 AND source_month = 5) AS silver_row_count, (SELECT count(*) FROM classified WHERE reason_code IS NOT NULL AND _source_year = 2024 AND _source_month = 5) AS quarantine_row_count, (SELECT count(*) FROM fact WHERE source_year = 2024 AND source_month = 5) AS gold_row_count"


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored(_classified(spark, sf_dir))
    made = silver.silver(rows)
    return release.counts(spark, rows, made, silver.quarantine(rows), gold.fct_trips(made), 2024, 5)


@_query(_with(_GOLD, f"SELECT *, bronze_row_count = silver_row_count + quarantine_row_count AS bronze_equals_classified, silver_row_count = gold_row_count AS silver_equals_gold, 'silver_published' AS run_status FROM (SELECT {_COUNTS_SQL})"))
def reconcile_month(spark, sf_dir):
    """A month's counts in all layers beside its manifest row."""
    month = spark.createDataFrame([(2024, 5, "run", "silver_published")], "source_year int, source_month int, ingestion_run_id string, run_status string")
    columns = [F.lit(None).cast("long").alias(f"{x}_row_count") for x in release.LAYERS] + [F.lit(None).cast("string").alias(f"{x}_snapshot_id") for x in release.LAYERS]
    beside = release.beside_manifest(_counted(spark, sf_dir), month.select("*", *columns), 2024, 5, "run")
    b, s, q, g = (F.col(f"{x}_row_count") for x in ("bronze", "silver", "quarantine", "gold"))
    return beside.select(b, s, q, g, (b == s + q).alias("bronze_equals_classified"), (s == g).alias("silver_equals_gold"), F.col("manifest_run_status").alias("run_status"))


@_query(_with(_GOLD, f"SELECT silver_row_count, gold_row_count FROM (SELECT {_COUNTS_SQL})"))
def verify_counts(spark, sf_dir):
    """The read-back pair of counts."""
    return _counted(spark, sf_dir).select("silver_row_count", "gold_row_count")


# state: queries that build tables and read them back

_SILVER_DAYS = TableSpec("silver", "days", (("row_id", "string"), ("pickup_date", "date"), ("source_year", "int"), ("source_month", "int")), ("source_year", "source_month"))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_silver(spark, sf_dir).select("row_id", "pickup_date", "source_year", "source_month"))


@_query(_with(_SILVER, "SELECT row_id, pickup_date, source_year, source_month FROM silver WHERE NOT (source_year = 2024 AND source_month = 4) AND NOT (source_year = 2024 AND source_month = 3 AND substr(row_id, 1, 1) >= '8')"))
def partition_overwrite(spark, sf_dir):
    """K1, K2: one month replaced by fewer rows, another by none; the others stay."""
    rows = _days(spark, sf_dir)
    table = SnapshotTable(spark, _state(spark), _SILVER_DAYS).create()
    table.replace(rows)
    table.replace(rows.where("source_year = 2024 and source_month = 3 and substr(row_id, 1, 1) < '8'"), source_year=2024, source_month=3)
    table.replace(rows.limit(0), source_year=2024, source_month=4)
    return table.read()


@_query(_with(_SILVER, "SELECT 'before' AS version, count(*) AS row_count FROM silver WHERE source_year = 2024 AND source_month = 3 UNION ALL SELECT 'after', count(*) FROM silver WHERE source_year = 2024 AND source_month = 3 AND substr(row_id, 1, 1) < '8'"))
def time_travel_count(spark, sf_dir):
    """A month's rows in two snapshots."""
    rows = _days(spark, sf_dir).where("source_year = 2024 and source_month = 3")
    table = SnapshotTable(spark, _state(spark), _SILVER_DAYS).create()
    before = table.replace(rows, source_year=2024, source_month=3)
    after = table.replace(rows.where("substr(row_id, 1, 1) < '8'"), source_year=2024, source_month=3)
    count = lambda name, at: table.read(at, source_year=2024, source_month=3).agg(F.lit(name).alias("version"), F.count(F.lit(1)).alias("row_count"))
    return count("before", before).unionByName(count("after", after))


@_query("SELECT 'replace' AS operation, CAST(2 AS BIGINT) AS place, count(*) AS row_count FROM nation")
def latest_snapshot_top1(spark, sf_dir):
    """The latest of a table's snapshots."""
    spec = TableSpec("bronze", "zones", (("LocationID", "int"), ("Zone", "string")))
    rows = sample.zones(spark, sf_dir).select("LocationID", "Zone")
    table = SnapshotTable(spark, _state(spark), spec).create()
    table.replace(rows.limit(0))
    table.replace(rows)
    latest = table.snapshots().orderBy(F.desc("committed_at"), F.desc(F.col("snapshot_id").cast("long"))).limit(1)
    return latest.select("operation", F.col("snapshot_id").cast("long").alias("place"), "row_count")


@_query(_with(_SILVER, "SELECT row_id, pickup_date, source_year, source_month, CASE WHEN source_year >= 2025 THEN cbd_congestion_fee END AS cbd_congestion_fee FROM silver"))
def schema_evolution_nullfill(spark, sf_dir):
    """K9: rows from before and after a column was added, read as one table."""
    rows = _stored(_silver(spark, sf_dir).select("row_id", "pickup_date", "source_year", "source_month", "cbd_congestion_fee"))
    table = SnapshotTable(spark, _state(spark), _SILVER_DAYS).create()
    months = [{"source_year": y, "source_month": m} for y, m in _months()]
    table.replace_months(rows.where("source_year = 2024").drop("cbd_congestion_fee"), months[:12])
    table.add_column(*FEE)
    table.replace_months(rows.where("source_year = 2025"), months[12:])
    return table.read()


_MOMENTS = ("2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00")
_MANIFEST_COLUMNS = "source_year, source_month, source_uri, ingestion_run_id, run_status, bronze_row_count, silver_row_count, quarantine_row_count, bronze_snapshot_id, silver_snapshot_id, failure_stage, failure_message"
#: Months of the trips with their counts and keys.
_RECORDED = f"""{_TRIPS},
recorded AS (SELECT _source_year AS source_year, _source_month AS source_month, count(*) AS n FROM trips GROUP BY ALL),
named AS (SELECT *, 'file:///landing/fhvhv_tripdata_' || source_year || '-' || lpad(CAST(source_month AS VARCHAR), 2, '0') || '.parquet' AS source_uri FROM recorded),
months AS (SELECT *, {_RUN_ID.format(y='source_year', m='source_month', uri='source_uri', size='n')} AS ingestion_run_id FROM named)"""


def _sources(spark: SparkSession, sf_dir: str) -> dict[tuple[int, int], SourceFile]:
    """A source for each month of the trips, as large as it has trips."""
    counted = sample.trips(spark, sf_dir).groupBy("_source_year", "_source_month").count().collect()  # a row for each month
    return {(y, m): SourceFile(y, m, f"file:///landing/{file_name(y, m)}", "a" * 64, n) for y, m, n in sorted(map(tuple, counted))}


def _update(spark: SparkSession, sources: dict, status: str, **more: Callable) -> DataFrame:
    """What the runs of several months have to say, in one relation."""
    return functools.reduce(DataFrame.unionByName, [manifest.update_row(spark, s, status, **{k: f(s) for k, f in more.items()}) for s in sources.values()])


def _begun(spark: SparkSession, sources: dict) -> DataFrame:
    """The manifest after bronze of all months."""
    return manifest.merged(spark.createDataFrame([], MANIFEST.schema), _update(spark, sources, manifest.BRONZE, bronze_count=lambda s: s.size, bronze_snapshot=lambda s: str(s.month)), _MOMENTS[0])


def _of(sources: dict, which: Callable[[int], bool]) -> dict:
    return {k: s for k, s in sources.items() if which(k[1])}


@_query(_with(_RECORDED, f"""SELECT source_year, source_month, source_uri, ingestion_run_id, CASE source_month % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'bronze_published' ELSE 'silver_published' END AS run_status,
    CASE source_month % 3 WHEN 1 THEN n + 1 ELSE n END AS bronze_row_count, CASE source_month % 3 WHEN 1 THEN 0 ELSE n // 2 END AS silver_row_count, CASE source_month % 3 WHEN 1 THEN 0 ELSE n - n // 2 END AS quarantine_row_count,
    CASE source_month % 3 WHEN 1 THEN '99' ELSE CAST(source_month AS VARCHAR) END AS bronze_snapshot_id, CASE source_month % 3 WHEN 1 THEN NULL ELSE '5' END AS silver_snapshot_id,
    CASE source_month % 3 WHEN 0 THEN 'bronze' END AS failure_stage, CASE source_month % 3 WHEN 0 THEN 'it''s lost' END AS failure_message FROM months"""))
def manifest_merge(spark, sf_dir):
    """Of all months a third fails and keeps its counts, a third has new bronze, which resets silver's."""
    sources = _sources(spark, sf_dir)
    half = F.floor(F.col("bronze_row_count") / 2)
    now = manifest.silver_done(_begun(spark, sources), F.col("ingestion_run_id"), half, F.col("bronze_row_count") - half, "5", "6", _MOMENTS[1])
    failed = _update(spark, _of(sources, lambda m: m % 3 == 0), manifest.FAILED, stage=lambda s: "bronze", message=lambda s: "it's lost")
    again = _update(spark, _of(sources, lambda m: m % 3 == 1), manifest.BRONZE, bronze_count=lambda s: s.size + 1, bronze_snapshot=lambda s: "99")
    return manifest.merged(now, failed.unionByName(again), _MOMENTS[2]).select(*_MANIFEST_COLUMNS.split(", "))


@_query(_with(_RECORDED, f"""SELECT source_year, source_month, source_uri, ingestion_run_id, CASE source_month % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'silver_published' ELSE 'bronze_published' END AS run_status,
    n AS bronze_row_count, CASE source_month % 3 WHEN 1 THEN n - 1 ELSE 0 END AS silver_row_count, CASE source_month % 3 WHEN 1 THEN CAST(1 AS BIGINT) ELSE 0 END AS quarantine_row_count,
    CAST(source_month AS VARCHAR) AS bronze_snapshot_id, CASE source_month % 3 WHEN 1 THEN '5' END AS silver_snapshot_id,
    CASE source_month % 3 WHEN 0 THEN 'silver' END AS failure_stage, CASE source_month % 3 WHEN 0 THEN 'no disk' END AS failure_message FROM months"""))
def manifest_update_silver(spark, sf_dir):
    """K5, K6: of all months silver is published for a third and fails for another."""
    sources = _sources(spark, sf_dir)
    run = lambda rest: F.when(F.col("source_month") % 3 == rest, F.col("ingestion_run_id"))
    now = manifest.silver_done(_begun(spark, sources), run(1), F.col("bronze_row_count") - 1, F.lit(1), "5", "6", _MOMENTS[1])
    return manifest.silver_failed(now, run(0), "no disk", _MOMENTS[1]).select(*_MANIFEST_COLUMNS.split(", "))


@_query(_with(_RECORDED, """SELECT source_year, source_month, ingestion_run_id,
    CASE WHEN source_month = 12 THEN 'go' WHEN source_month % 4 = 0 THEN 'refused' WHEN source_month % 3 = 1 THEN 'published' ELSE 'go' END AS ingest,
    CASE WHEN source_month = 12 OR source_month % 4 = 0 THEN 'refused' WHEN source_month % 3 = 1 THEN 'published' WHEN source_month % 3 = 2 AND source_month % 2 = 0 THEN 'refused' ELSE 'go' END AS silver
FROM (SELECT source_year, source_month, CASE WHEN source_month % 4 = 0 THEN 'fhvhv-other' ELSE ingestion_run_id END AS ingestion_run_id FROM months)"""))
def month_admissions(spark, sf_dir):
    """What each month may do next: new, published, failed in either step, or from another source."""
    sources = _sources(spark, sf_dir)
    now = _begun(spark, _of(sources, lambda m: m != 12))
    run = lambda which: F.when(which, F.col("ingestion_run_id"))
    now = manifest.silver_done(now, run(F.col("source_month") % 3 == 1), F.lit(1), F.lit(1), "5", "6", _MOMENTS[1])
    now = manifest.silver_failed(now, run(F.col("source_month") % 3 == 0), "no disk", _MOMENTS[1])
    now = manifest.merged(now, _update(spark, _of(sources, lambda m: m % 3 == 2 and m % 2 == 0), manifest.FAILED, stage=lambda s: "bronze", message=lambda s: "lost"), _MOMENTS[2])
    claims = _update(spark, sources, manifest.BRONZE).select(*manifest.CLAIM)
    other = F.col("source_month") % 4 == 0
    claims = claims.withColumns({"source_checksum": F.when(other, "b" * 64).otherwise(F.col("source_checksum")), "ingestion_run_id": F.when(other, "fhvhv-other").otherwise(F.col("ingestion_run_id"))})
    return manifest.decisions(now, claims).select("source_year", "source_month", "ingestion_run_id", "ingest", "silver")


_RELEASED = """
SELECT _source_year AS source_year, CAST(5 AS INTEGER) AS source_month, count(*) AS bronze_row_count, CAST(count(*) FILTER (reason_code IS NULL) AS BIGINT) AS silver_row_count,
    CAST(count(*) FILTER (reason_code IS NOT NULL) AS BIGINT) AS quarantine_row_count, CAST(count(*) FILTER (reason_code IS NULL) AS BIGINT) AS gold_row_count, 'silver_published' AS run_status,
    'year=' || _source_year || '/month=05' AS publication_folder, CAST(37 AS BIGINT) AS passed_tests, TRUE AS run_id_is_of_the_file, TRUE AS a_rerun_is_the_same, 'refused' AS another_source, 'refused' AS another_publication, 'refused' AS other_zones,
    (SELECT count(*) FROM bronze WHERE _source_year = 2024) AS rows_before, (SELECT count(cbd_congestion_fee) FROM bronze) AS rows_with_fee
FROM classified GROUP BY _source_year
"""


@_query(_with(_CLASSIFIED, _RELEASED))
def month_release(spark, sf_dir):
    """A year's trips as one monthly file, from landing to a verified release; then the schema change and the next year's.

    The last columns are what a second run and changed sources, zones and documents
    come to.
    """
    root = _state(spark)
    landed, lake = Files(spark), Lake(spark, f"{root}/lake")

    def land(folder: str, uri: str) -> str:
        """The one file of a folder under the name it is known by."""
        landed.rename(f"{folder}/{next(n for n in landed.names(folder) if n.startswith('part-'))}", uri)
        return uri

    sample.zones(spark, sf_dir).repartition(1).write.option("header", True).csv(f"{root}/zones")
    zones = land(f"{root}/zones", f"{root}/zones.csv")
    rows, said = sample.trips(spark, sf_dir), []
    refused = lambda do: _refusal(do, (ContractError, release.ReleaseError))
    for year in (2024, 2025):
        folder = f"{root}/landing/{year}"
        of_year = rows.where(F.col("_source_year") == year).drop("_source_year", "_source_month", *([FEE[0]] if year < identity.FEE_YEAR else []))
        of_year.repartition(1).write.option("compression", "zstd").parquet(folder)
        uri = land(folder, f"{root}/landing/{file_name(year, 5)}")
        if year == identity.FEE_YEAR:
            before = lake.bronze.latest()["id"]
            lake.evolve()
        source = SourceFile.of(spark, year, 5, uri)
        first, again = lake.run(source, zones), lake.run(source, zones)
        row, month = lake.manifest.row(year, 5), {"source_year": year, "source_month": 5}
        kept = json.loads(landed.read(release.checks_uri(lake, source)))
        published = json.loads(landed.read(first["publication_uri"]))
        key = hashlib.sha256("\x1f".join(map(str, (uri, source.checksum, source.size, year, 5))).encode()).hexdigest()[:16]
        changed = SourceFile(year, 5, uri, "b" * 64, source.size)
        other = release.reconcile(lake, source) | {"snapshot_ids": dict.fromkeys(release.LAYERS, "0")}
        said.append(
            month
            | {f"{x}_row_count": published["layers"][x]["row_count"] for x in release.LAYERS}
            | {
                "gold_row_count": published["gold"]["row_count"],
                "run_status": row.run_status,
                "publication_folder": "/".join(first["publication_uri"].split("/")[-3:-1]),
                "passed_tests": sum(r["status"] == "pass" for r in kept["results"]),
                "run_id_is_of_the_file": row.ingestion_run_id == f"fhvhv-{year}-05-{key}",
                "a_rerun_is_the_same": again == first,
                "another_source": refused(lambda s=changed: lake.manifest.guard(s)),
                "another_publication": refused(lambda s=source, r=other: release.publish(lake, s, r)),
                "other_zones": refused(lambda: lake.ensure_zones(f"{root}/landing/{file_name(2024, 5)}")),
            }
        )
    shown = release.evolution(lake.bronze, before, FEE[0])
    kinds = "source_year int, source_month int, bronze_row_count long, silver_row_count long, quarantine_row_count long, gold_row_count long, run_status string, publication_folder string, passed_tests long, run_id_is_of_the_file boolean, a_rerun_is_the_same boolean, another_source string, another_publication string, other_zones string, rows_before long, rows_with_fee long"
    return spark.createDataFrame([tuple({**x, "rows_before": shown["rows_before"], "rows_with_fee": shown["with_value"]}[c.split()[0]] for c in kinds.split(", ")) for x in said], kinds)


def _refusal(do: Callable, kinds: tuple) -> str:
    try:
        do()
    except kinds:
        return "refused"
    return "accepted"


@_query(_with(_SILVER, "SELECT row_id, 'first' AS side FROM silver WHERE substr(row_id, 1, 1) < '2' UNION ALL SELECT row_id, 'rerun' AS side FROM silver WHERE substr(row_id, 1, 1) >= 'e'"))
def rerun_row_ids_except(spark, sf_dir):
    """Identities that only one of two runs has."""
    rows = _stored(_silver(spark, sf_dir).select("row_id", "source_year", "source_month"))
    return release.other_row_ids(rows.where("substr(row_id, 1, 1) < 'e'"), rows.where("substr(row_id, 1, 1) >= '2'"))


# the same operators on tables that the sample did not shape


@_query("SELECT c_custkey, c_mktsegment, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def native_left_joins(spark, sf_dir):
    """J1, J2 on customers, nations and regions."""
    customer, nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation", "region"))
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("c_custkey", "c_mktsegment", "n_name", "r_name")


@_query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS BIGINT) AS rn FROM lineitem")
def native_row_number(spark, sf_dir):
    """W1 on order lines, whose key repeats."""
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", F.row_number().over(w).cast("bigint").alias("rn"))


@_query("SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour(ts) AS INTEGER) AS event_hour, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total_value FROM events GROUP BY ALL")
def native_hourly_demand(spark, sf_dir):
    """A6, E13 on the event table."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    keys = [F.date_format("ts", "yyyyMMdd").cast("int").alias("date_key"), F.hour("ts").alias("event_hour"), "event_type"]
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("total_value"))


@_query("SELECT o_orderstatus, count(*) AS orders, CAST(count(*) FILTER (o_totalprice < 100000) AS BIGINT) AS small_orders, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus")
def native_conditional_counts(spark, sf_dir):
    """A1, A2 on orders."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_totalprice") < 100000).alias("small_orders"), F.count_distinct("o_custkey").alias("customers"))


@_query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS calendar_date, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(o_orderdate) AS INTEGER) AS calendar_year, CAST(month(o_orderdate) AS INTEGER) AS calendar_month, CAST(day(o_orderdate) AS INTEGER) AS day_of_month, CAST(extract(dow FROM o_orderdate) + 1 AS INTEGER) AS day_of_week, strftime(o_orderdate, '%a') AS day_name FROM orders")
def native_calendar(spark, sf_dir):
    """P12 on order dates."""
    return gold.dim_date(spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("pickup_date")))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain from source rows to the operators' metrics."""
    return mart_operator_metrics(spark, sf_dir)
