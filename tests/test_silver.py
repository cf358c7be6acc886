"""Quality rules in their order, duplicates and the silver columns."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from tripmill import queries
from tripmill.functions import quality
from tripmill.operators import bronze, checks, gold, silver
from tripmill.sources.schema import TableSpec
from tripmill.sources.store import SnapshotTable

T = dt.datetime(2024, 1, 15, 8, 0, tzinfo=dt.timezone.utc)
GOOD = {
    "hvfhs_license_num": "HV0003", "dispatching_base_num": "B1", "originating_base_num": None,
    "request_datetime": T, "on_scene_datetime": None, "pickup_datetime": T + dt.timedelta(minutes=5), "dropoff_datetime": T + dt.timedelta(minutes=25),
    "PULocationID": "1", "DOLocationID": "2", "trip_miles": 4.2, "trip_time": 1200.0, "base_passenger_fare": 18.5, "tolls": 0.0, "bcf": 0.0, "sales_tax": 0.0,
    "congestion_surcharge": 0.0, "airport_fee": 0.0, "tips": 3.0, "driver_pay": 11.5,
    "shared_request_flag": "N", "shared_match_flag": "N", "access_a_ride_flag": "N", "wav_request_flag": "N", "wav_match_flag": "N",
    "_source_file": "f", "_ingested_at": T, "_source_year": 2024, "_source_month": 1, "_ingestion_run_id": "run",
}


def _type(name):
    value = GOOD[name]
    if name.endswith("_datetime") or name == "_ingested_at":
        return "timestamp"
    return "double" if isinstance(value, float) else "int" if isinstance(value, int) else "string"


def trips(spark, *changes):
    rows = spark.createDataFrame([tuple((GOOD | c).values()) for c in changes], ", ".join(f"{c} {_type(c)}" for c in GOOD))
    return bronze.with_identity(rows, 2024)


def zones(spark, ids=(1, 2, 3)):
    return spark.createDataFrame([(i,) for i in ids], "LocationID int")


def reasons(spark, *changes):
    found = silver.classify(trips(spark, *({"dispatching_base_num": f"B{i}"} | c for i, c in enumerate(changes))), zones(spark))
    return [r.reason_code for r in found.orderBy("dispatching_base_num").collect()]


BROKEN = [
    ("MISSING_OR_INVALID_TIMESTAMP", {"pickup_datetime": None}),
    ("PICKUP_BEFORE_REQUEST", {"request_datetime": T + dt.timedelta(minutes=6)}),
    ("DROPOFF_BEFORE_PICKUP", {"dropoff_datetime": T + dt.timedelta(minutes=4)}),
    ("INVALID_ZONE_ID", {"PULocationID": "abc"}),
    ("UNKNOWN_PICKUP_ZONE", {"PULocationID": "999"}),
    ("UNKNOWN_DROPOFF_ZONE", {"DOLocationID": "998"}),
    ("MISSING_OR_INVALID_NUMERIC", {"tips": None}),
    *((code, {c: -1.0}) for c, code in quality.NEGATIVE.items()),
]


def test_each_rule(spark):
    assert reasons(spark, *(c for _, c in BROKEN[:10])) == [r for r, _ in BROKEN[:10]]
    assert reasons(spark, *(c for _, c in BROKEN[10:])) == [r for r, _ in BROKEN[10:]]
    assert [r for r, _ in BROKEN] + [quality.DUPLICATE] == list(quality.REASONS)


def test_first_rule_wins(spark):
    changes = {}
    for code, change in reversed([b for b in BROKEN if b[0] not in ("UNKNOWN_PICKUP_ZONE", "INVALID_ZONE_ID", "MISSING_OR_INVALID_NUMERIC")]):
        changes |= change
        if code == "DROPOFF_BEFORE_PICKUP":
            changes = {k: v for k, v in changes.items() if k != "request_datetime"}
        assert reasons(spark, changes) == [code]


@pytest.mark.parametrize("value", [math.nan, math.inf, -math.inf])
def test_no_finite_number(spark, value):
    assert reasons(spark, {"driver_pay": value}) == ["MISSING_OR_INVALID_NUMERIC"]


def test_equal_times_and_zero_amounts_are_valid(spark):
    assert reasons(spark, {"pickup_datetime": T, "dropoff_datetime": T, "tips": 0.0}) == [None]


def test_duplicates_count_rows_that_are_not_valid(spark):
    # both have the identity of 0 miles; the first in order is not valid, and still the first
    rows = trips(spark, {"trip_miles": -1e-7, "_source_file": "a"}, {"trip_miles": 0.0, "_source_file": "b"}, {"trip_miles": 0.0, "_source_file": "c"})
    got = silver.classify(rows, zones(spark)).orderBy("_source_file").collect()
    assert len({r.row_id for r in got}) == 1
    assert [r.reason_code for r in got] == ["NEGATIVE_TRIP_MILES", "DUPLICATE_ROW_ID", "DUPLICATE_ROW_ID"]


def test_silver_columns_and_counts(spark):
    found = silver.classify(trips(spark, {}, {}, {"PULocationID": "9"}, {"dropoff_datetime": T + dt.timedelta(minutes=5, seconds=30, microseconds=900_000), "tips": 9.0}), zones(spark))
    assert tuple(silver.counts(found).first()) == (4, 2, 2)
    rows = silver.silver(found).orderBy("tips").collect()
    assert [r.trip_duration_minutes for r in rows] == [20.0, 0.5] and rows[0].pickup_hour == 8 and rows[0].pickup_date == dt.date(2024, 1, 15)
    assert "cbd_congestion_fee" not in silver.silver(found).columns
    assert [tuple(r) for r in silver.by_reason(silver.quarantine(found)).collect()] == [("DUPLICATE_ROW_ID", 1), ("UNKNOWN_PICKUP_ZONE", 1)]


def test_missing_policy_is_another_policy(spark):
    rows = trips(spark, {}, {}).withColumn("identity_policy_version", F.lit(None).cast("string"))
    assert silver.other_policy(rows, "p").count() == 2


def test_one_shuffle_and_broadcast_zones(spark):
    plan = silver.silver(silver.classify(trips(spark, {}), zones(spark)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row_id") == 1 and "SortMergeJoin" not in plan


def stored(spark, tmp_path, rows):
    spec = TableSpec("bronze", "t", tuple(rows.dtypes), ("_source_year", "_source_month"))
    table = SnapshotTable(spark, f"file://{tmp_path}", spec).create()
    table.replace(rows)
    return table.read(places=True)


@pytest.mark.parametrize("bits", [silver.BLOCK_BITS, 1])
def test_copies_are_numbered_as_narrow_rows(spark, tmp_path, monkeypatch, bits):
    """With blocks of two rows, the copies of one trip are numbered across many."""
    monkeypatch.setattr(silver, "BLOCK_BITS", bits)
    changes = [{"dispatching_base_num": f"B{i % 7}" if i % 3 else "HOT", "_source_file": f"f{i % 2}"} for i in range(60)]
    changes += [{"dispatching_base_num": "HOT", "PULocationID": "999", "_source_file": None}] * 3
    rows = stored(spark, tmp_path, trips(spark, *changes))
    found = silver.classify(rows, zones(spark))
    wide = [s for s in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in s]
    assert wide and not any("passenger_fare" in s or "license" in s for s in wide)
    by_window = silver.classify(rows.drop(*silver.PLACE), zones(spark))
    count = lambda df: sorted((r.row_id, r._trip_row_number, r.n) for r in df.groupBy("row_id", "_trip_row_number").agg(F.count(F.lit(1)).alias("n")).collect())
    assert count(found) == count(by_window) and {n for _, _, n in count(found)} == {1}
    reasons = lambda df: sorted((str(r[0]), r[1]) for r in df.groupBy("reason_code").count().collect())
    assert reasons(found) == reasons(by_window)
    # the order is kept: nulls, f0, f1
    hot = found.where("dispatching_base_num = 'HOT' and PULocationID = '1'").orderBy("_trip_row_number").select("_source_file").collect()
    assert [r[0] for r in hot] == sorted(r[0] for r in hot)
    assert "row_file" not in silver.quarantine(found).columns


def test_a_table_without_copies(spark, tmp_path):
    rows = stored(spark, tmp_path, trips(spark, *({"dispatching_base_num": f"B{i}"} for i in range(5))))
    assert {r._trip_row_number for r in silver.classify(rows, zones(spark)).collect()} == {1}
    assert silver.repeated(rows).isEmpty()


def test_data_tests_count_what_fails(spark):
    zone = spark.createDataFrame([(1, "a", "b", "c"), (1, "a", "b", "c"), (None, "a", "b", "c"), (2, "a", "b", "c")], "LocationID int, Borough string, Zone string, service_zone string")
    good = silver.silver(silver.classify(trips(spark, *({"dispatching_base_num": f"B{i}"} for i in range(6))), zones(spark)))
    relations = gold.build(good, zone)
    fact = relations["fct_trips"]
    twice = fact.limit(1)
    odd = fact.unionByName(twice).withColumns({"pickup_zone_id": F.when(F.col("row_id") > "8", 77).otherwise(F.col("pickup_zone_id")), "operator_code": F.lit(None).cast("string"), "driver_pay": F.lit(None).cast("double")})
    found = {(r.kind, r.relation, r.column_name): r.failures for r in checks.all_checks(relations | {"fct_trips": odd}).collect()}
    assert len(found) == 37
    high = odd.where("row_id > '8'").count()
    expected = {
        ("unique", "bronze_taxi_zones", "LocationID"): 1, ("not_null", "bronze_taxi_zones", "LocationID"): 1, ("unique", "dim_zone", "zone_id"): 1,
        ("unique", "fct_trips", "row_id"): 1, ("not_null", "fct_trips", "operator_code"): 7, ("not_null", "fct_trips", "driver_pay"): 7,
        ("relationships", "fct_trips", "pickup_zone_id"): high, ("singular", "fct_trips", checks.COUNTS): 1,
    }
    assert {k: n for k, n in found.items() if n} == {k: n for k, n in expected.items() if n}


@pytest.mark.parametrize("kinds", [(k,) for k in ("unique", "not_null", "relationships", "singular")] + [("unique", "singular")])
def test_data_tests_of_some_kinds_are_those_of_all_and_read_no_more(spark, tmp_path, kinds):
    zone = spark.createDataFrame([(1, "a", "b", "c"), (1, "a", "b", "c"), (None, "a", "b", "c")], "LocationID int, Borough string, Zone string, service_zone string")
    good = silver.silver(silver.classify(trips(spark, *({"dispatching_base_num": f"B{i}"} for i in range(6))), zones(spark)))
    odd = good.unionByName(good.limit(1)).withColumns({"pickup_zone_id": F.when(F.col("row_id") > "8", 77).otherwise(F.col("pickup_zone_id")), "operator_code": F.lit(None).cast("string"), "driver_pay": F.lit(None).cast("double")})
    odd.withColumn("cbd_congestion_fee", F.lit(None).cast("double")).write.parquet(f"file://{tmp_path}/silver")
    stored_silver = spark.read.parquet(f"file://{tmp_path}/silver")
    relations = gold.build(stored_silver, zone, gold.fct_trips(stored_silver.where("row_id < 'e'")))
    found = checks.all_checks(relations, kinds)
    said = lambda df: sorted((r.kind, r.relation, r.column_name, r.failures) for r in df.collect())
    assert said(found) == [x for x in said(checks.all_checks(relations)) if x[0] in kinds]
    whole = checks.all_checks(gold.build(stored_silver, zone), kinds)
    plan = spark._jvm.PythonSQLUtils.explainString(whole._jdf.queryExecution(), "formatted")
    read = {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<(.*)>", plan) for c in s.split(",") if c}
    assert read == {c for k in kinds for c in queries._TESTED[k]}


def test_dq_unique_stores_what_its_tests_read(spark, monkeypatch):
    made = []
    keep = queries._stored
    monkeypatch.setattr(queries, "_stored", lambda df: made.append(keep(df)) or made[-1])
    assert queries.dq_unique(spark, "/root/testdata/sf0.001").count() == 9
    assert {*made[0].columns} == {*queries._TESTED["unique"]}


def test_trips_are_numbered_before_they_are_widened(spark):
    plan = queries._classified(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [") :]
    assert "unhex" in below and not any(x in below for x in ("business_trip_key", "identity_policy_version", "reason_code", "SortMerge"))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_keys_of_hashes_are_bytes_and_keep_texts_apart(spark):
    rows = spark.createDataFrame([(x,) for x in ("00ab", "00AB", "0ab", "ab", "xy", "00ab", None)], "row_id string")
    rows = rows.select("row_id", *(F.lit("1").alias(c) for c in checks.NOT_NULL["silver_trips"][1:]))
    own = checks.keys(rows, "silver_trips").where(F.col("domain") == checks.DOMAINS.index("silver_trips.row_id")).where(F.col("part") == checks.OWN)
    found = {(r.key and bytes(r.key), r.text): r.n for r in own.groupBy("key", "text").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {(b"\x00\xab", None): 2, (None, "00AB"): 1, (None, "0ab"): 1, (b"\xab", None): 1, (None, "xy"): 1}


WANTED = {
    "mart_hourly_zone_demand": lambda s: gold.mart_hourly_zone_demand(gold.fct_trips(s)),
    "schema_evolution_nullfill": lambda s: s.select("row_id", "pickup_date", "source_year", "source_month", "cbd_congestion_fee"),
    "rerun_row_ids_except": lambda s: s.select("row_id", "source_year", "source_month"),
    "fct_merge_upsert": lambda s: gold.fct_trips(s).select("row_id", "source_year", "source_month", "tips"),
}


@pytest.mark.parametrize("name", WANTED)
def test_what_only_the_rules_read_is_not_shuffled(spark, name):
    made = WANTED[name](queries._silver(spark, "/root/testdata/sf0.001"))
    plan = spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "formatted")
    numbered = re.search(r"\) Window\nInput \[\d+\]: \[(.*)\]", plan).group(1)
    names = {x.split("#")[0].strip() for x in numbered.split(",")}
    assert "row_id" in names and not {"dropoff_datetime", "DOLocationID", "tolls", "sales_tax", "trip_time"} & names


def test_duplicates_of_trips_shuffle_and_store_no_more_than_is_returned(spark, monkeypatch):
    monkeypatch.setattr(queries, "_state", lambda spark: pytest.fail("rows are stored"))
    made = queries.duplicate_override(spark, "/root/testdata/sf0.001")
    plan = spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "formatted")
    assert len(re.findall(r"\) Window\n", plan)) == 1 and plan.count("hashpartitioning(row_id") == 1
    shuffled = re.search(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(row_id", plan).group(1)
    assert {x.split("#")[0].strip() for x in shuffled.split(",")} == {"row_id", "request_datetime", "reason_code"}


def test_judged_rows_are_the_classified(spark):
    changes = [{}, {}, {"tips": -1.0}, {"tips": -1.0}, {"PULocationID": "999"}, {"trip_miles": math.nan}, {"dispatching_base_num": "B1"}]
    rows, zone = trips(spark, *changes), zones(spark)
    said = lambda df: sorted((r.row_id, str(r.reason_code), r._trip_row_number) for r in df.collect())
    assert said(silver.judged(rows, zone)) == said(silver.classify(rows, zone))


def test_sums_are_those_of_decimals(spark):
    values = [0.0, -0.0, 0.1, -0.1, 1.005, 12345.67 * 0.7, -98765.43, 5e-7, -5e-7, 4.9999999e-7, 1e8, -1e8, 99999999.999999, 123456789012.123456, -999999999999.0, 2.0**39 + 0.5, None]
    rows = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values * 7)] + [(9, None)], "g int, x double")
    summed = rows.groupBy("g").agg(gold._sum("x").alias("a"), F.sum(F.col("x").cast("decimal(18,6)")).cast("double").alias("b"))
    assert all(r.a == r.b for r in summed.collect()) and summed.where("a is null").count() == 1
    plan = rows.groupBy("g").agg(gold._sum("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(x" not in plan and "decimal(28,6)" not in plan


def test_date_keys_are_the_digits_of_days(spark):
    days = spark.sql("select explode(array(date'0001-01-01', date'1999-12-31', date'2024-02-29', date'9999-12-31', null, date'-0044-03-15')) as d")
    same = days.select(gold._date_key(F.col("d")).eqNullSafe(F.date_format("d", "yyyyMMdd").cast("int")).alias("x"))
    assert {r.x for r in same.collect()} == {True}
