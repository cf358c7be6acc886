"""Identity: published hashes, canonical texts and their edges."""

import pytest
from pyspark.sql import functions as F

from tripmill.functions import identity
from tripmill.operators.bronze import with_identity

# A published record, changes to it, and the hashes they must have.
BASE = {
    "hvfhs_license_num": "HV0003", "dispatching_base_num": "B03404", "originating_base_num": None,
    "request_datetime": "2024-01-15T08:00:00", "on_scene_datetime": None, "pickup_datetime": "2024-01-15T08:05:00", "dropoff_datetime": "2024-01-15T08:25:00",
    "PULocationID": "1", "DOLocationID": "2", "trip_miles": "4.2", "trip_time": "1200", "base_passenger_fare": "18.5", "tolls": "0", "bcf": "0", "sales_tax": "0",
    "congestion_surcharge": "0", "airport_fee": "0", "tips": "3", "driver_pay": "11.5",
    "shared_request_flag": "N", "shared_match_flag": "N", "access_a_ride_flag": "N", "wav_request_flag": "N", "wav_match_flag": "N",
}
BUSINESS_2024 = "e18001bc7a6c97f2cd3912c8f9b8caa3536eaa8a81589b7f2bc59fd1c6389d46"
VECTORS = [
    ("normal_2024", 2024, {}, "46645481a2549bd9e431be72c3260f86439eaad7ceea1307b9ce09cc1127cc7d", BUSINESS_2024),
    ("nullable_optional_flag", 2024, {"shared_match_flag": None}, "2b32327b830e7ff9da22785c872ae273e90cfae41ef90ac80028c5cec42dbea4", BUSINESS_2024),
    ("zero_numeric_values", 2024, {"trip_miles": "0", "trip_time": "0", "base_passenger_fare": "0", "tips": "0", "driver_pay": "0"}, "08a5b4271dd9e85ae1beca81d172f4d6c15c1b55360648537bf60f812d62b6f6", BUSINESS_2024),
    ("normalized_timestamps", 2024, {"request_datetime": "2024-01-15T08:00:00.000000", "pickup_datetime": "2024-01-15T08:05:00Z", "dropoff_datetime": "2024-01-15T08:25:00+00:00"}, "46645481a2549bd9e431be72c3260f86439eaad7ceea1307b9ce09cc1127cc7d", BUSINESS_2024),
    ("corrected_tips", 2024, {"tips": "4"}, "d7444d3f44710b154bb007bc1a1a79f594ecdba459d04a14555c3307943ec0ad", BUSINESS_2024),
    ("corrected_shared_flag", 2024, {"shared_match_flag": "Y"}, "92b75679be1888e439098bd86cc80046f7c278dd7ff65234326ae63f456e4199", BUSINESS_2024),
    ("normal_2025", 2025, {"request_datetime": "2025-01-15T08:00:00", "pickup_datetime": "2025-01-15T08:05:00", "dropoff_datetime": "2025-01-15T08:25:00", "cbd_congestion_fee": "0.75"}, "b8afdfb5293a4632f603ca04f2002ec0a74ea5f3eade7d75e8d2d67c1473410d", "69109ea7f1e67b3d939a9da69008b109f661f69ac6aab6ec97d8e186c9e4dd98"),
]
COLUMNS = identity.row_columns(2025)


def frame(spark, *rows):
    return spark.createDataFrame([tuple((BASE | r).get(c) for c in COLUMNS) for r in rows], ", ".join(f"{c} string" for c in COLUMNS))


@pytest.mark.parametrize("name, year, changes, row_id, business", VECTORS)
def test_published_vectors(spark, name, year, changes, row_id, business):
    got = with_identity(frame(spark, changes), year).first()
    assert (got.row_id, got.business_trip_key, got.identity_policy_version) == (row_id, business, identity.policy(year))


def test_year_column_chooses_the_policy(spark):
    rows = frame(spark, *(v[2] for v in VECTORS)).withColumn("y", F.year(F.col("request_datetime").cast("timestamp")))
    assert [r.row_id for r in with_identity(rows, F.col("y")).collect()] == [v[3] for v in VECTORS]


def test_edges_of_canonical_texts(spark):
    rows = frame(spark, {"trip_miles": "NaN", "tips": "0.0000025", "trip_time": "1.9", "originating_base_num": "  ", "tolls": "x"})
    got = rows.select(*(identity.canonical(c).alias(c) for c in COLUMNS)).first()
    assert got.trip_miles is None and got.tolls is None  # drop out of the hash
    assert (got.tips, got.trip_time, got.originating_base_num) == ("0.000003", "2", "<NULL>")
    same = with_identity(frame(spark, {"tips": "-0.0000001"}, {"tips": "0"}), 2024).select("row_id").distinct()
    assert same.count() == 1


def test_run_id_follows_every_part_of_the_source():
    parts = ("s3://x/fhvhv_tripdata_2024-01.parquet", "a" * 64, 5, 2024, 1)
    one = identity.run_id(*parts)
    assert one.startswith("fhvhv-2024-01-") and len(one) == len("fhvhv-2024-01-") + 16
    for i, other in enumerate(("s3://y", "b" * 64, 6, 2025, 2)):
        assert identity.run_id(*(other if j == i else p for j, p in enumerate(parts))) != one


def test_types_given_change_no_hash(spark):
    rows = spark.sql("select stack(5, 1.5D, timestamp'2024-01-15 08:00:00', 1, null, null, null, double('NaN'), timestamp'1999-12-31 23:59:59.5', -2, double('inf'), null, 0, -0.0D, timestamp'2024-01-15 08:00:00', null) as (x, t, n)")
    of = {identity.TIMES: "t", identity.WHOLE_NUMBERS: "n", identity.AMOUNTS: "x"}
    made = rows.select("*", *(F.col(c).alias(name) for names, c in of.items() for name in names), *(F.lit(t).alias(c) for c, t in zip([c for c in identity.ROW_COLUMNS if c not in sum(of, ())], ["", " ", "a", None, "b ", "c", "d", "e"])))
    kinds = dict(made.dtypes)
    same = made.select(*((f(2025) if f is identity.row_id else f()).eqNullSafe(f(2025, kinds) if f is identity.row_id else f(kinds)).alias(f.__name__) for f in (identity.row_id, identity.business_key)))
    assert {tuple(r) for r in same.collect()} == {(True, True)}


def test_texts_of_doubles_are_those_of_decimals(spark):
    edges = [0.0, -0.0, 1.0, -1.0, 0.5, -0.05, 0.1 + 0.2, 5e-7, -5e-7, 4.99e-7, 2.5e-6, 1e-300, 99999999.9999995, -1e8, 1e8, 1e22, -3e31, 1e33, 8641.968999999999, 1 / 3, float("nan"), float("inf"), None]
    rows = spark.createDataFrame([(v,) for v in edges], "x double").unionByName(spark.range(20000).select(((F.rand(7) - 0.5) * F.pow(F.lit(10), F.rand(8) * 11 - 2)).alias("x")))
    rows = rows.unionByName(spark.range(20000).select((F.col("id") * 7919 % 1_000_003 / 100).alias("x"))).withColumnRenamed("x", "tips")
    other = rows.where(~identity.canonical("tips", "double").eqNullSafe(identity.canonical("tips")))
    assert other.collect() == []
    # most texts need no decimal
    assert rows.where(identity.is_millionths(F.col("tips"))).count() > 20000
    whole = spark.createDataFrame([(0,), (-5,), (2**62,), (None,)], "trip_time long")
    assert whole.where(~identity.canonical("trip_time", "bigint").eqNullSafe(identity.canonical("trip_time"))).isEmpty()
    assert "decimal" not in whole.select(identity.canonical("trip_time", "bigint"))._jdf.queryExecution().optimizedPlan().toString()
