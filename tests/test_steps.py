"""Retries, one run at a time, time limits, the code bundle and the model graph."""

import hashlib
import json
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.test_month import land, place  # noqa: F401
from tripmill.operators import gold
from tripmill.plans import bundle, cli, release, steps
from tripmill.sources.files import Files
from tripmill.sources.schema import ConflictError, ContractError


def failing(times, error=OSError):
    calls = []

    def step():
        calls.append(1)
        if len(calls) <= times:
            raise error("x")
        return "done"

    return calls, step


def test_mishaps_are_retried_and_refusals_are_not():
    calls, step = failing(2)
    assert steps.retried(step, pause=0) == "done" and len(calls) == 3
    calls, step = failing(3)
    with pytest.raises(OSError):
        steps.retried(step, pause=0)
    assert len(calls) == 3
    calls, step = failing(1, ContractError)
    with pytest.raises(ContractError):
        steps.retried(step, pause=0)
    assert len(calls) == 1


def test_a_month_survives_a_failed_step(spark, place, monkeypatch):  # noqa: F811
    lake, folder, zones = place
    source, refine = land(spark, folder), lake.refine
    calls, step = failing(1)
    monkeypatch.setattr(lake, "refine", lambda s: (step(), refine(s))[1])
    assert lake.run(source, zones, pause=0)["silver_row_count"] == 1 and len(calls) == 2
    assert not Files(spark).exists(f"{lake.root}/_running.json")


def test_one_run_at_a_time(spark, tmp_path):
    root = f"file://{tmp_path}"
    with steps.alone(spark, root, "a"):
        with pytest.raises(steps.RunningError, match='"run": "a"'), steps.alone(spark, root, "b"):
            pass
        with steps.alone(spark, root, "c", take_over=True):
            pass
    with pytest.raises(ValueError), steps.alone(spark, root, "d"):
        raise ValueError
    assert Files(spark).names(root) == []


def test_the_first_holder_leaves_the_file_of_one_that_took_over(spark, tmp_path):
    root = f"file://{tmp_path}"
    first, second = steps.alone(spark, root, "a"), steps.alone(spark, root, "b", take_over=True)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert json.loads(Files(spark).read(f"{root}/_running.json"))["run"] == "b"
    second.__exit__(None, None, None)


def test_statements_end_in_time(spark):
    assert steps.rows_of(spark.sql("SELECT :x + 1 AS y", args={"x": 1}))[0].y == 2
    endless = spark.range(1 << 45).agg(F.sum(F.hash("id")))
    began = time.monotonic()
    with pytest.raises(steps.StatementError, match="more than 1 s"):
        steps.rows_of(endless, 1)
    assert time.monotonic() - began < steps.GRACE
    with pytest.raises(steps.StatementError, match="failed"):
        steps.rows_of(spark.sql("SELECT raise_error('no')"))
    assert steps.rows_of(spark.range(1))


def test_the_bundle_depends_on_the_code_alone(tmp_path, capsys):
    first = bundle.build(tmp_path / "a" / "x.zip")
    time.sleep(2.1)  # entries have times of two seconds
    cli.main(["bundle", "--output", str(tmp_path / "y.zip")])
    assert json.loads(capsys.readouterr().out) == first
    data = (tmp_path / "y.zip").read_bytes()
    assert data == (tmp_path / "a" / "x.zip").read_bytes() and hashlib.sha256(data).hexdigest() == first["sha256"]
    with zipfile.ZipFile(tmp_path / "y.zip") as z:
        assert z.namelist() == sorted(z.namelist()) and {i.date_time for i in z.infolist()} == {bundle.EPOCH}
        inside = json.loads(z.read(bundle.MANIFEST))
        assert all(hashlib.sha256(z.read(n)).hexdigest() == h for n, h in inside["files"].items()) and "tripmill/plans/month.py" in inside["files"]


def test_models_read_what_the_graph_says(spark, place):  # noqa: F811
    lake, folder, zones = place
    lake.run(land(spark, folder), zones)
    folders = {"silver_trips": lake.silver.root, "fct_trips": lake.fact.root, "bronze_taxi_zones": lake.zones.root}
    folders = {k: v.removeprefix("file://") for k, v in folders.items()}
    relations = gold.build(lake.silver.read(), lake.zones.read(), lake.fact.read()) | {"fct_trips": gold.fct_trips(lake.silver.read())}
    gold.check_graph(relations, folders)
    with pytest.raises(ValueError, match="mart_operator_metrics"):
        gold.check_graph(relations | {"mart_operator_metrics": gold.mart_operator_metrics(gold.fct_trips(lake.silver.read()))}, folders)


def test_a_run_goes_on_at_the_step_that_failed(spark, place, monkeypatch):  # noqa: F811
    lake, folder, zones = place
    source, done = land(spark, folder), []
    for name in ("ingest", "refine", "build"):
        real = getattr(lake, name)
        monkeypatch.setattr(lake, name, lambda *a, name=name, real=real: (done.append(name), real(*a))[1])
    calls, step = failing(1)
    real_verify = release.verify
    monkeypatch.setattr(release, "verify", lambda *a: (step(), real_verify(*a))[1])
    with pytest.raises(OSError):
        lake.run(source, zones, retries=0)
    journal = steps.Journal(spark, lake.root, source.run_id)
    assert journal.done() == ["build", "ingest", "publish", "reconcile", "refine"]
    # an entry that is cut short counts as none
    path = next((folder / "lake" / "_journal" / source.run_id).glob("publish.json"))
    path.write_bytes(path.read_bytes()[:-20])
    for crc in path.parent.glob(".*.crc"):
        crc.unlink()
    assert lake.run(source, zones, retries=0)["gold_row_count"] == 1
    assert done == ["ingest", "refine", "build"] and journal.done() == []


def test_a_refused_run_begins_anew(spark, place, monkeypatch):  # noqa: F811
    lake, folder, zones = place
    source = land(spark, folder)
    monkeypatch.setattr(release, "reconcile", lambda *a: (_ for _ in ()).throw(release.ReleaseError("no")))
    with pytest.raises(release.ReleaseError):
        lake.run(source, zones, pause=0)
    assert steps.Journal(spark, lake.root, source.run_id).done() == []


def test_a_lost_race_is_tried_again():
    calls, step = failing(2, ConflictError)
    assert steps.retried(step, pause=0) == "done" and len(calls) == 3


def test_sealed_files_prove_themselves():
    payload = steps.seal({"a": [1, "é"]})
    assert steps.sealed(payload) == {"a": [1, "é"]}
    for bad in (payload[:-5], payload.replace(b"1", b"2"), b"", b"[]", b'{"a": 1}'):
        assert steps.sealed(bad) is None


def test_archived_tests_are_one_file(spark, place, monkeypatch):  # noqa: F811
    """A writer that stops before its one write leaves nothing behind; a changed file is refused."""
    lake, folder, zones = place
    source = land(spark, folder)
    lake.ingest(source, zones)
    lake.refine(source)
    tested = lake.build(source)
    with monkeypatch.context() as m:
        m.setattr(Files, "write_new", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            release.archive_checks(lake, source, tested)
    uri = release.archive_checks(lake, source, tested)
    assert release.archive_checks(lake, source, tested) == uri == release.required_checks(lake, source)[0]
    path = folder / uri.removeprefix(f"file://{folder}/")
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == [path.name]
    path.write_bytes(path.read_bytes().replace(b'"failures":0', b'"failures":7', 1))
    for crc in path.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(release.ReleaseError, match="damaged"):
        release.archive_checks(lake, source, tested)


def test_an_interrupted_build_leaves_the_old_gold(spark, place, monkeypatch):  # noqa: F811
    lake, folder, zones = place
    lake.run(land(spark, folder), zones)
    mart, hourly = lake.gold["mart_operator_metrics"], lake.gold["mart_hourly_zone_demand"]
    old = mart.read().collect()
    second = land(spark, folder, month=2, changes=({"hvfhs_license_num": "HV0009"}, {"tips": "5"}))
    lake.ingest(second, zones)
    lake.refine(second)
    with monkeypatch.context() as m:
        m.setattr(mart, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            lake.build(second)
        assert mart.read().collect() == old and hourly.latest()["note"] == {"source": lake.fact.latest()["id"]}
    before = {p["path"] for p in mart._log()[1]["parts"]}
    lake.build(second)
    assert before < {p["path"] for p in mart._log()[1]["parts"]}  # the first month's part is as it was
    want = gold.mart_operator_metrics(lake.fact.read())
    assert mart.read().exceptAll(want.select(*mart.read().columns)).isEmpty() and mart.read().count() == want.count() == 3
    assert sorted(r[0] for r in lake.gold["dim_operator"].read().collect()) == ["HV0003", "HV0009"]
    snapshots = mart.snapshots().count()
    lake.build(second)
    assert mart.snapshots().count() in (snapshots, snapshots + 1) and mart.read().count() == 3


def test_an_empty_source_leaves_the_month_as_it_was(spark, place):  # noqa: F811
    lake, folder, zones = place
    with pytest.raises(ContractError, match="no trips"):
        lake.ingest(land(spark, folder, changes=()), zones)
    assert lake.bronze.latest() is None


def test_equal_reruns_are_told_by_digests(spark):
    rows = spark.range(200).selectExpr("sha2(string(id), 256) as row_id", "if(id % 3 = 0, null, id) as v", "2024 as source_year", "int(id % 4 + 1) as source_month")
    shuffled = rows.orderBy(F.desc("row_id"))
    assert release.differing({"a": rows, "b": rows}, {"a": shuffled, "b": rows}) == []
    assert release.rerun_differences({"a": rows}, {"a": shuffled}).collect() == [] and release.other_row_ids(rows, shuffled).collect() == []
    changed = rows.withColumn("v", F.when(F.col("v") == 1, None).otherwise(F.col("v")))
    assert release.differing({"a": rows}, {"a": changed}) == [("a", 2024, 2)]
    found = release.rerun_differences({"a": rows}, {"a": changed})
    assert found.count() == 2 and {r.side for r in found.collect()} == {"first", "rerun"}
    # nulls have a place: the same values in other columns are another row
    a = spark.createDataFrame([(1, None)], "x int, y int")
    assert release.differing({"a": a}, {"a": a.selectExpr("y as x", "x as y")}) == [("a", None, None)]
    assert release.other_row_ids(rows.where("v <> 5"), rows).count() == 1 + rows.where("v is null").count()


def test_sides_of_a_rerun_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(release, "REPEATED", 2)
    texts = lambda *x: spark.createDataFrame([(t, 2024, 1) for t in x], "row_id string, source_year int, source_month int")
    one, two = texts("00ab", "00ab", "00ab", "00ab", "00AB", "xy", "same", None, None, ""), texts("00ab", "ab", "same", "same", "same", None, "0ab")
    found = release.other_row_ids(one, two)
    assert sorted((r.side, str(r.row_id)) for r in found.collect()) == sorted(
        [("first", x) for x in ("00ab", "00ab", "00ab", "00AB", "xy", "None", "")] + [("rerun", x) for x in ("ab", "same", "same", "0ab")]
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "unhex" in plan
