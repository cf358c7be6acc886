"""The snapshot table: what a commit writes, what a merge opens, writers at the same time, counts as rows are written."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tripmill.sources.files import Files, checksums
from tripmill.sources.schema import ConflictError, ContractError, TableSpec
from tripmill.sources.store import CHECKPOINT, SnapshotTable

MONTHS = ("y", "m")
COLUMNS = (("k", "string"), ("at", "timestamp"), ("v", "int"), ("y", "int"), ("m", "int"))
PLAIN = TableSpec("ns", "plain", COLUMNS, MONTHS)
HASHED = TableSpec("ns", "hashed", COLUMNS, MONTHS, key="k")
RANGED = TableSpec("ns", "ranged", COLUMNS, MONTHS, ranges=("at",))


def rows_of(spark, months, each=40, value=0):
    """Rows of months 0.., with keys that tell nothing of the month and times that do."""
    ids = spark.range(each).crossJoin(spark.createDataFrame([(m,) for m in months], "n int"))
    made = ids.withColumn("k", F.sha2(F.concat_ws("-", "n", "id"), 256))
    at = F.make_timestamp(F.lit(2024) + F.floor(F.col("n") / 12), F.col("n") % 12 + 1, F.lit(15), F.lit(0), F.lit(0), F.lit(0))
    return made.select("k", at.alias("at"), F.lit(value).alias("v"), (F.lit(2024) + F.floor(F.col("n") / 12)).cast("int").alias("y"), (F.col("n") % 12 + 1).cast("int").alias("m"))


def folders(df):
    return {"/".join(f.split("/")[-3:-1]) for f in df.inputFiles()}


@pytest.mark.parametrize("spec", [HASHED, RANGED, PLAIN])
def test_a_merge_opens_the_partitions_of_matched_rows_only(spark, tmp_path, spec):
    table = SnapshotTable(spark, f"file://{tmp_path}", spec).create()
    table.replace(rows_of(spark, range(24)))
    before = {p["path"]: p for p in table._log()[1]["parts"]}
    update = rows_of(spark, [7], 60, 1)  # 40 known rows and 20 new ones
    opened = table.matches(update, "k")
    assert folders(table._read(opened, table.schema())) == {"y=2024/m=8"}
    table.merge(update, "k")
    after = {p["path"]: p for p in table._log()[1]["parts"]}
    assert len(before.keys() & after.keys()) == 23
    assert table.read().count() == 24 * 40 + 20 and table.read().where("v = 1").count() == 60
    assert table.latest()["rows"] == 24 * 40 + 20
    assert table.changed_since("1") == [{"y": 2024, "m": 8}]
    # rows that nobody has: nothing is opened
    assert table.matches(rows_of(spark, [24]), "k") == []


def test_ranges_keep_rows_without_a_value(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", RANGED).create()
    lost = rows_of(spark, [1], 3).withColumn("at", F.lit(None).cast("timestamp"))
    table.replace(rows_of(spark, [5]).unionByName(lost))
    table.merge(lost.withColumn("v", F.lit(9)), "k")
    assert table.read().count() == 43 and table.read().where("v = 9").count() == 3
    table.merge(rows_of(spark, [5], 2).limit(0), "k")
    assert table.read().count() == 43


def test_log_bytes_of_a_commit_do_not_grow(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", PLAIN).create()
    part = lambda i: {"path": f"w={i:032d}/y=2024/m={i % 12 + 1}", "at": {"y": 2024, "m": i % 12 + 1}, "rows": 1}
    for i in range(1, 1001):
        old = [part(i - 12)["path"]] if i > 12 else []
        snapshot = {"id": str(i), "parent": None, "committed_at": "2024-01-01T00:00:00+00:00", "operation": "replace", "schema": 0, "rows": 12, "note": {}}
        table._commit(i, {"snapshot": snapshot, "add": [part(i)], "drop": old})
    sizes = {k: [(tmp_path / "ns/plain/metadata" / f"{k}{v:08d}.json").stat().st_size for v in table._numbers(k)] for k in "vc"}
    assert max(sizes["v"][20:]) - min(sizes["v"][20:]) < 20 and len(sizes["v"]) == 1001
    assert len(sizes["c"]) == 1000 // CHECKPOINT and max(sizes["c"]) - min(sizes["c"]) < 40
    for at in (5, 31, 32, 33, 500, 1000):
        live = {p["path"] for p in table._log(at)[1]["parts"]}
        assert live == {part(i)["path"] for i in range(max(1, at - 11), at + 1)}
    assert table.snapshots().count() == 1000 and table.latest()["id"] == "1000"


def jobs(spark, do):
    spark.sparkContext.setJobGroup("counted", "")
    try:
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        do()
        return len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_a_write_is_one_job_and_knows_its_rows(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", PLAIN).create()
    path = f"file://{tmp_path}/rows"
    rows_of(spark, range(24), 11).write.parquet(path)
    rows = spark.read.parquet(path)
    assert jobs(spark, lambda: table.replace(rows)) == 1
    assert {p["rows"] for p in table._log()[1]["parts"]} == {11}
    assert jobs(spark, lambda: table.replace(rows.where("y = 2024 and m = 3 and k < '8'"), y=2024, m=3)) == 1
    assert [r.row_count for r in table.snapshots().collect()] == [264, table.read().count()]


def test_more_partitions_than_are_counted_on_the_way(spark, tmp_path, monkeypatch):
    from tripmill.sources import store

    monkeypatch.setattr(store, "COUNTED", 5)
    table = SnapshotTable(spark, f"file://{tmp_path}", PLAIN).create()
    table.replace(rows_of(spark, range(24), 3))
    assert {p["rows"] for p in table._log()[1]["parts"]} == {3}


def test_a_check_that_fails_leaves_the_old_rows(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", PLAIN).create()
    table.replace(rows_of(spark, [0]))

    def check(n):
        assert n == 0
        raise ContractError("empty")

    with pytest.raises(ContractError, match="empty"):
        table.replace(rows_of(spark, [0]).limit(0), check=check, y=2024, m=1)
    assert table.read().count() == 40 and table.snapshots().count() == 1


def test_writers_of_other_months_go_behind_each_other(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", PLAIN).create()
    table.replace(rows_of(spark, range(3)))
    other = SnapshotTable(spark, f"file://{tmp_path}", PLAIN)
    # the other writer commits while this one's rows are on disk already
    table.replace(rows_of(spark, [0], 5), check=lambda n: other.replace(rows_of(spark, [1], 7), y=2024, m=2), y=2024, m=1)
    assert {r.m: r["count"] for r in table.read().groupBy("m").count().collect()} == {1: 5, 2: 7, 3: 40}
    assert table.latest()["rows"] == 52 and [s.snapshot_id for s in table.snapshots().collect()] == ["1", "2", "3"]
    with pytest.raises(ConflictError):
        table.replace(rows_of(spark, [0], 6), check=lambda n: other.replace(rows_of(spark, [0], 9), y=2024, m=1), y=2024, m=1)
    with pytest.raises(ConflictError):
        table.replace(rows_of(spark, [0], 6), check=lambda n: other.add_column("w", "int"), y=2024, m=1)
    assert table.read(y=2024, m=1).count() == 9


def test_places_name_rows_for_good(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", PLAIN).create()
    assert table.read(places=True).count() == 0
    table.replace(rows_of(spark, range(3)))
    rows = table.read(places=True)
    assert rows.select("row_file", "row_index").distinct().count() == 120
    assert rows.exceptAll(table.read(places=True)).isEmpty()


@pytest.mark.parametrize("way", ["link", "rename", "put"])
def test_ways_to_commit(spark, tmp_path, way):
    files, path = Files(spark), f"file://{tmp_path}/x/v.json"
    spark.conf.set("tripmill.commit.file", way)
    try:
        files.write_new(path, b"one")
        with pytest.raises(FileExistsError):
            files.write_new(path, b"two")
        assert files.read(path) == b"one" and [n for n in files.names(f"file://{tmp_path}/x") if not n.endswith(".crc")] == ["v.json"]
    finally:
        spark.conf.unset("tripmill.commit.file")


def test_a_store_without_a_safe_way_is_refused(spark, tmp_path):
    files, path = Files(spark), f"file://{tmp_path}/v.json"
    for way, error in (("copy", ContractError), ("conditional", Exception)):  # a local disk has no conditional put
        spark.conf.set("tripmill.commit.file", way)
        try:
            with pytest.raises(error):
                files.write_new(path, b"x")
        finally:
            spark.conf.unset("tripmill.commit.file")
    assert not files.exists(path)


def test_checksums_are_made_by_tasks(spark, tmp_path, monkeypatch):
    made = {}
    for i, data in enumerate((b"", b"a", bytes(range(256)) * 5000)):
        (tmp_path / f"f{i}.parquet").write_bytes(data)
        made[f"file://{tmp_path}/f{i}.parquet"] = (hashlib.sha256(data).hexdigest(), len(data))
    monkeypatch.setattr(Files, "read", lambda *a: pytest.fail("the driver read a file"))
    assert checksums(spark, list(made)) == made


def test_a_commit_names_what_it_adds_and_drops(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}", RANGED).create()
    table.replace(rows_of(spark, [0, 1]))
    table.replace(rows_of(spark, [1], 2), y=2024, m=2)
    entry = json.loads((tmp_path / "ns/ranged/metadata/v00000002.json").read_text())
    assert len(entry["add"]) == len(entry["drop"]) == 1 and entry["snapshot"]["rows"] == 42
    low, high, null = entry["add"][0]["ranges"]["at"]
    assert low == high and null is False
