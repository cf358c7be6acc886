"""A month from file to release, its retries, and what must be refused."""

import json
import re
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark import SparkConf
from pyspark.sql import functions as F

from tripmill import queries
from tripmill.functions.identity import row_columns
from tripmill.operators import silver
from tripmill.plans import cli, manifest, release, steps
from tripmill.plans.month import Lake, MonthRequest, backfill_requests
from tripmill.sources.files import Files, SourceFile, file_name
from tripmill.sources.schema import BRONZE_TRIPS, ContractError, TableSpec, check_columns
from tripmill.sources.store import SnapshotTable

BASE = "HV0003 B03404 _ 2024-01-15T08:00:00 _ 2024-01-15T08:05:00 2024-01-15T08:25:00 1 2 4.2 1200 18.5 0 0 0 0 0 3 11.5 N N N N N".split()
ZONES = "LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n3,Bronx,Allerton/Pelham Gardens,Boro Zone\n"
KINDS = dict(BRONZE_TRIPS.columns) | {"cbd_congestion_fee": "double"}


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(ZONES)
    return Lake(spark, f"file://{tmp_path}/lake"), tmp_path, f"file://{tmp_path}/zones.csv"


def land(spark, folder, year=2024, month=1, changes=({}, {}, {"dropoff_datetime": "2024-01-15T07:00:00", "hvfhs_license_num": "HV0005"}, {"PULocationID": "999"}, {"driver_pay": "-1"})):
    names = row_columns(year)
    base = dict(zip(names, (None if v == "_" else v for v in BASE)))
    rows = spark.createDataFrame([tuple((base | c).get(n) for n in names) for c in changes], ", ".join(f"{n} string" for n in names))
    rows.select(*(F.col(n).cast(KINDS[n]).alias(n) for n in names)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/made")
    made = next((folder / "made").glob("part-*"))
    target = folder / file_name(year, month)
    target.write_bytes(made.read_bytes())
    return SourceFile.of(spark, year, month, f"file://{target}")


def test_month_is_released_and_a_rerun_changes_nothing(spark, place):
    lake, folder, zones = place
    source = land(spark, folder)
    first = lake.run(source, zones)
    assert (first["silver_row_count"], first["gold_row_count"]) == (1, 1)
    reasons = {r.reason_code for r in lake.quarantine.read().collect()}
    assert reasons == {"DUPLICATE_ROW_ID", "DROPOFF_BEFORE_PICKUP", "UNKNOWN_PICKUP_ZONE", "NEGATIVE_DRIVER_PAY"}
    body = Files(spark).read(first["publication_uri"])
    found = json.loads(body)
    assert {x: y["row_count"] for x, y in found["layers"].items()} == {"bronze": 5, "silver": 1, "quarantine": 4}
    assert found["gold"]["row_count"] == 1 and body.endswith(b"}\n") and not release.lacking(found)
    assert len(json.loads(Files(spark).read(release.checks_uri(lake, source)))["results"]) == 37
    before = [t.snapshots().count() for t in (lake.bronze, lake.silver, lake.quarantine)]
    again = lake.run(source, zones)
    assert again["publication_uri"] == first["publication_uri"] and Files(spark).read(again["publication_uri"]) == body
    assert [t.snapshots().count() for t in (lake.bronze, lake.silver, lake.quarantine)] == before


def test_changed_source_is_refused_before_anything_is_written(spark, place):
    lake, folder, zones = place
    lake.ingest(land(spark, folder), zones)
    snapshots = lake.bronze.snapshots().count()
    with pytest.raises(ContractError, match="different source"):
        lake.ingest(land(spark, folder, changes=({}, {"tips": "4"})), zones)
    assert lake.bronze.snapshots().count() == snapshots
    wrong = SourceFile(2024, 2, f"file://{folder}/{file_name(2024, 1)}", "a" * 64, 1)
    with pytest.raises(ContractError):
        lake.ingest(wrong, zones)
    assert lake.manifest.row(2024, 2) is None


def test_failed_silver_keeps_bronze_and_can_be_tried_again(spark, place, monkeypatch):
    lake, folder, zones = place
    source = land(spark, folder)
    lake.ingest(source, zones)
    monkeypatch.setattr(lake.silver, "replace", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("it's " + "x" * 3000)))
    with pytest.raises(RuntimeError):
        lake.refine(source)
    row = lake.manifest.row(2024, 1)
    assert (row.run_status, row.failure_stage, row.bronze_row_count, row.bronze_snapshot_id) == ("failed", "silver", 5, "1")
    assert len(row.failure_message) == 2000
    monkeypatch.undo()
    assert lake.refine(source) and lake.manifest.row(2024, 1).run_status == "silver_published"
    assert lake.refine(source) is None


def test_empty_source_and_changed_zones_fail_the_run(spark, place):
    lake, folder, zones = place
    with pytest.raises(ContractError, match="no trips"):
        lake.ingest(land(spark, folder, changes=()), zones)
    assert lake.manifest.row(2024, 1).failure_stage == "bronze"
    (folder / "zones.csv").write_text(ZONES + "4,x,y,z\n")
    with pytest.raises(ContractError, match="lookup has changed"):
        lake.ensure_zones(zones)


def test_schema_change_and_time_travel(spark, place):
    lake, folder, zones = place
    lake.run(land(spark, folder), zones)
    old = lake.bronze.snapshots().first().snapshot_id
    source = land(spark, folder, 2025, 1, ({"request_datetime": "2025-01-15T08:00:00", "pickup_datetime": "2025-01-15T08:05:00", "dropoff_datetime": "2025-01-15T08:25:00", "cbd_congestion_fee": "0.75"},))
    with pytest.raises(ContractError, match="cbd_congestion_fee"):
        lake.ingest(source, zones)
    lake.evolve()
    assert lake.run(source, zones)["gold_row_count"] == 1
    assert lake.bronze.read().count() == 6 and lake.bronze.read(old).count() == 5
    assert "cbd_congestion_fee" not in lake.bronze.read(old).columns
    assert sorted(r[0] or 0 for r in lake.fact.read().select("cbd_congestion_fee").collect()) == [0, 0.75]
    assert release.evolution(lake.bronze, old, "cbd_congestion_fee") == {"snapshot_id": old, "rows_before": 5, "rows": 6, "with_value": 1}
    for before, column in ((lake.bronze.snapshots().orderBy("committed_at").collect()[-1].snapshot_id, "cbd_congestion_fee"), (old, "tips")):
        with pytest.raises(release.ReleaseError):
            release.evolution(lake.bronze, before, column)
    with pytest.raises(ContractError):
        lake.evolve()


def test_fact_rows_that_left_silver_stop_the_release(spark, place):
    lake, folder, zones = place
    source = land(spark, folder)
    lake.run(source, zones)
    extra = lake.fact.read().withColumn("row_id", F.lit("gone"))
    lake.fact.merge(extra, "row_id")
    with pytest.raises(release.ReleaseError, match="add up"):
        release.reconcile(lake, source)


def test_publication_conflict_and_damage(spark, place):
    lake, folder, zones = place
    source = land(spark, folder)
    done = lake.run(source, zones)
    reconciled = release.reconcile(lake, source, datetime(2024, 2, 1))
    published = release.publish(lake, source, reconciled)
    assert published["publication_uri"] == done["publication_uri"]
    with pytest.raises(release.ReleaseError, match="another publication"):
        release.publish(lake, source, reconciled | {"snapshot_ids": {"bronze": "9", "silver": "9", "quarantine": "9"}})
    with pytest.raises(ValueError):
        release.publish(lake, source, reconciled | {"source_month": 2})
    with pytest.raises(release.ReleaseError, match="digest"):
        release.verify(lake, source, published | {"sha256": "0" * 64})
    with pytest.raises(ValueError, match="layers.silver.row_count, reconciliation.silver_equals_gold"):
        release.publish(lake, source, reconciled | {"silver_row_count": -1, "silver_equals_gold": False})
    for bad in (b'{"results": []}', b'{"results": [{"status": "pass"}]}', b'{"metadata": {"invocation_id": "x"}, "results": [{"status": "fail"}]}'):
        with pytest.raises(release.ReleaseError):
            release.check_results(bad)


def test_snapshot_table_contract(spark, tmp_path):
    spec = TableSpec("ns", "t", (("k", "string"), ("v", "int"), ("y", "int")), ("y",))
    table = SnapshotTable(spark, f"file://{tmp_path}", spec).create().create()
    assert table.read().count() == 0
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v int, y int")
    one = table.replace(rows(("a", 1, 1), ("b", 2, 2)))
    two = table.replace(rows(("c", 3, 2)), y=2)
    three = table.replace(rows(), y=2)
    assert [sorted(r.k for r in table.read(s).collect()) for s in (one, two, three)] == [["a", "b"], ["a", "c"], ["a"]]
    with pytest.raises(ContractError, match="outside"):
        table.replace(rows(("z", 1, 3)), y=2)
    with pytest.raises(ContractError, match="no columns"):
        table.replace(rows().selectExpr("*", "1 as w"))
    for bad in ("x1", "99", "1 or 1"):
        with pytest.raises(ContractError):
            table.read(bad)
    table.merge(rows(("a", 9, 1), ("d", 4, 5)), "k")
    assert sorted((r.k, r.v) for r in table.read().collect()) == [("a", 9), ("d", 4)]
    stale = SnapshotTable(spark, f"file://{tmp_path}", spec)
    version, log = stale._log()
    table.replace(rows(), y=1)
    with pytest.raises(ContractError, match="someone else"):
        stale._commit(version + 1, log)


def test_requests_columns_and_evidence(spark):
    assert [m.month for m in backfill_requests(2024, 9)] == [9, 10, 11, 12]
    for bad in (lambda: backfill_requests(2024, 10), lambda: MonthRequest(2018, 1), lambda: MonthRequest(2024, 13), lambda: check_columns(["tips"], 2024), lambda: check_columns([], 2018)):
        with pytest.raises(ContractError):
            bad()
    check_columns([*row_columns(2024), "more"], 2024)
    with pytest.raises(ContractError, match="cbd_congestion_fee"):
        check_columns(row_columns(2024), 2025)
    ids = lambda *x: spark.createDataFrame([(i, r) for i, r in x], "row_id string, reason string")
    first = {"silver": ids(("a", None), ("b", None)), "quarantine": ids(("c", "x"))}
    assert release.rerun_differences(first, {"silver": ids(("b", None), ("a", None)), "quarantine": ids(("c", "x"))}).isEmpty()
    found = release.rerun_differences(first, {"silver": ids(("a", None)), "quarantine": ids(("c", "y"))}).collect()
    assert sorted((r.relation, r.side, json.loads(r.row)["row_id"]) for r in found) == [("quarantine", "first", "c"), ("quarantine", "rerun", "c"), ("silver", "first", "b")]


def test_files_are_whole_and_one_writer_wins(spark, tmp_path):
    files, path = Files(spark), f"file://{tmp_path}/a/v1.json"
    with ThreadPoolExecutor(8) as pool:
        def write(i):
            try:
                files.write_new(path, str(i).encode() * 1000)
                return i
            except FileExistsError:
                return None

        won = [i for i in pool.map(write, range(8)) if i is not None]
    assert len(won) == 1 and files.read(path) == str(won[0]).encode() * 1000 and [n for n in files.names(f"file://{tmp_path}/a") if not n.endswith(".crc")] == ["v1.json"]


def test_command_line(spark, place, capsys):
    lake, folder, zones = place
    land(spark, folder)
    cli.main(["month", "--root", lake.root, "--landing", f"file://{folder}", "--zones", zones])
    cli.main(["snapshot", "--root", lake.root, "--snapshot-id", "1"])
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert said[0]["gold_row_count"] == 1 and said[1] == {"row_count": 5, "snapshot_id": "1"}
    assert manifest.SILVER == lake.manifest.row(2024, 1).run_status


def test_state_of_queries_is_a_uri_however_the_folder_is_set(spark, tmp_path, monkeypatch):
    for folder in (tmp_path, f"{tmp_path}/", f"file://{tmp_path}"):
        monkeypatch.setattr(spark.sparkContext, "getConf", lambda f=folder: SparkConf(False).set("spark.checkpoint.dir", str(f)))
        uri = f"{queries._state(spark)}/landing/{file_name(2024, 5)}"
        assert uri.startswith("file:/") and str(tmp_path) in uri
        SourceFile(2024, 5, uri, "a" * 64, 1).validate()


def test_trips_are_shuffled_whole_for_neither_silver_nor_a_rerun_nor_the_schema_change(spark, place, monkeypatch):
    lake, folder, zones_uri = place
    source = land(spark, folder)
    lake.ingest(source, zones_uri)
    plans, write = {}, SnapshotTable._write

    def watched(self, df, schema):
        plans.setdefault(self.spec.name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, schema)

    monkeypatch.setattr(SnapshotTable, "_write", watched)
    lake.refine(source)
    for name in ("silver_trips", "quarantine_trips"):  # no trip is shuffled, and none is kept beside the tables
        (plan,) = plans[name]
        assert "BroadcastHashJoin" in plan and "hashpartitioning(row_file" not in plan
        assert all("driver_pay" not in line for line in plan.split("\n") if "InMemoryTableScan" in line or "InMemoryRelation" in line or "Exchange" in line)
    lake.build(source)
    first = sorted(map(str, lake.fact.read().collect()))
    lake.build(source)
    assert "LeftAnti" not in plans["fct_trips"][-1]
    assert sorted(map(str, lake.fact.read().collect())) == first
    # the other way of joining copies gives the same
    once = sorted(map(str, lake.silver.read().collect()))
    monkeypatch.setattr(silver, "BROADCAST_COPIES", -1)
    monkeypatch.setattr(type(lake.manifest), "admit_silver", lambda *_: True)
    lake.refine(source)
    assert sorted(map(str, lake.silver.read().collect())) == once
    before = lake.bronze.latest()["id"]
    lake.evolve()
    later = lake.bronze.read().withColumns({"cbd_congestion_fee": F.lit(1.5), "_source_year": F.lit(2025)})
    lake.bronze.replace(later, _source_year=2025, _source_month=source.month)
    monkeypatch.setattr(type(later), "exceptAll", lambda *_: pytest.fail("whole rows are compared"))
    assert release.evolution(lake.bronze, before, "cbd_congestion_fee")["with_value"] == later.count()
    monkeypatch.undo()
    lake.bronze.replace(lake.bronze.read(_source_year=2024, _source_month=source.month).limit(1), _source_year=2024, _source_month=source.month)
    with pytest.raises(release.ReleaseError, match="are lost"):
        release.evolution(lake.bronze, before, "cbd_congestion_fee")


def test_shuffle_files_of_a_step_are_deleted(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    ids = lambda: {int(n) for n in re.findall(r"shuffle_(\d+)_\d+_\d+[.]data", blocks.getAllFiles().toString())}
    old = ids()
    for _ in range(3):
        spark.range(1000).repartition(3, "id").count()
    made = ids() - old
    assert len(made) >= 6
    steps.free_shuffles(spark)
    gone = made - {max(made) - 1, max(made)}  # the last job's may still be held by the scheduler
    end = time.monotonic() + 30
    while gone & ids() and time.monotonic() < end:
        time.sleep(0.2)
    assert not gone & ids()
