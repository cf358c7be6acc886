"""Archives: round trips, revisits and the format itself."""

import base64
import glob
import hashlib
import struct

import zstandard

from tripmill.llm import warc

PAGES = "page_id long, url string, html string, sha1 string, first string, size string"


def pages(spark):
    rows = [(i, f"http://e.com/{i}", f"<p>page {i % 7} é</p>" * (i % 7 + 1)) for i in range(60)]
    rows += [(100, None, None), (90, "http://x", ""), (101, "a\r\nb", "solo"), (102, "u", "long " * 100_000), (None, "n", "<p>page 3 é</p>" * 4), (None, "m", "only here"), (101, "again", "solo")]
    return rows, spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def test_round_trip_and_revisits(spark, monkeypatch):
    rows, df = pages(spark)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    got = warc.round_trip(df, payloads=True).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    seen = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        to = first.get(h or "")
        again = to is not None and to != i
        want.append((str(i), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", str(to if again else None)))
    assert seen == sorted(want)
    bodies = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert bodies[102] == b"long " * 100_000 and bodies[90] == b""
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")


def test_least_payload_for_a_revisit(spark, tmp_path):
    _, df = pages(spark)
    path = f"file://{tmp_path}"
    manifest = warc.write_archives(df, path, least=60)
    got = {r["page_id"]: r for r in warc.read_archives(manifest, path).collect()}
    assert got[14]["record_type"] == "response" and got[12]["refers_to"] == 5 and got[100]["record_type"] == "response"
    assert sum(r["records"] for r in manifest.collect()) == 67


def test_archive_format(spark, tmp_path):
    records = [warc.build_record(i, f"http://e/{i}", (f"<html><body>shared words {i}" * 20).encode(), "D" * 32, None, None, "2024-01-01T00:00:00Z") for i in range(300)]
    data = warc.build_archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and data[8:12] == struct.pack("<I", 0xEC30A437)
    assert list(warc.read_archive(data)) == records
    assert len(data) - size < sum(len(zstandard.compress(r)) for r in records) / 2
    few = warc.build_archive(records[:1])
    assert list(warc.read_archive(few)) == records[:1]
    fields, payload, length = warc.parse_record(records[3])
    assert fields["WARC-Type"] == "response" and len(payload) == length and warc.page_of(fields["WARC-Record-ID"]) == 3


def test_archives_are_read_by_many_tasks_and_leftovers_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    path = f"file://{tmp_path}"
    rows = [(i, f"http://e.com/{i}", f"page {i // 2}") for i in range(64)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    manifest = warc.write_archives(df, path)
    archives = manifest.collect()
    assert len(archives) == 64
    used = {r["t"] for r in warc.read_archives(manifest, path).selectExpr("spark_partition_id() as t").collect()}
    assert len(used) >= 8
    orphan = tmp_path / archives[0]["part"] / ".pages-of-a-failed-task.warc.zst"
    orphan.write_bytes(b"cut short")
    assert warc.clean_up(manifest, path) == 1 and not orphan.exists() and warc.read_archives(manifest, path).count() == 64
    records = [r for a in archives for r in warc.read_archive((tmp_path / a["part"] / a["archive"]).read_bytes())]
    again = [warc.parse_record(r)[0] for r in records if b"WARC-Type: revisit" in r]
    assert len(again) == 32 and all(f["WARC-Refers-To-Target-URI"].startswith("http://e.com/") and f["WARC-Refers-To-Date"] for f in again)


def test_empty_table(spark):
    _, df = pages(spark)
    assert warc.round_trip(df.limit(0)).count() == 0
    assert not glob.glob("warc-*")
