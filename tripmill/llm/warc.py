"""WARC archives in Zstandard with a dictionary of their own.

An archive is a skippable frame that holds a dictionary, built from records of
that archive, and then one Zstandard frame for each record, so each record can
be read by itself. Records whose payload another record has are revisits: they
refer to the record with the smallest page id and carry no payload.

Payload digests are made and compared in the JVM, on narrow rows. The marks of
revisits are sent to all executors where Spark finds their table small enough;
else the pages are shuffled to them once. Pages are written where they are, in
archives of bounded size. A task writes to a name nobody else has and moves it
into place, and only the manifest says which archives count; what failed tasks
left is deleted afterwards. Archives are read back by many tasks, whose number
follows from the manifest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Tables, shared_dir, small_batches

#: Payload bytes of one archive, dictionary bytes, and records it is built from.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLES = 16 << 20, 64 << 10, 200
#: A sampled record counts with this many bytes at most: the dictionary holds what records share.
SAMPLE_BYTES = 8 << 10
LEVEL = 6
#: Fixed values of the formats: the magic number of the dictionary's skippable
#: frame and the profile of a revisit with an identical payload.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of archives that one task reads at most, about.
READ_BYTES = 256 << 20
#: Compressed bytes that are given to the decompressor at a time.
STEP = 4096


def record_id(page_id: int | None, digest: str, serial: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest if page_id is not None else serial}>"


def page_of(uri: str | None) -> int | None:
    part = uri.split(":")[2] if uri else ""
    return int(part) if part else None


def uri_of(url: str) -> str:
    """A URL as a field's value: a line end would end the field."""
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else url


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, first_url: str | None, date: str) -> bytes:
    """One record; a revisit of page ``first`` (of that URL and the same date) where that is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    fields = [
        ("WARC-Type", "revisit" if first is not None else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, uuid.uuid4().hex)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(1, ("WARC-Target-URI", uri_of(url)))
    if first is not None:
        fields += [("WARC-Refers-To", record_id(first, digest, "")), ("WARC-Refers-To-Date", date), ("WARC-Profile", REVISIT_PROFILE)]
        if first_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", uri_of(first_url)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Fields, payload (empty for a revisit) and length of the full payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, payload, length


def build_archive(records: list[bytes]) -> bytes:
    """Dictionary frame and record frames. Records too few or small for a trained dictionary serve as one themselves."""
    picked = [r[:SAMPLE_BYTES] for r in records[:: max(1, len(records) // SAMPLES)]]
    try:
        words = zstandard.train_dictionary(DICTIONARY_BYTES, picked, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        words = b"".join(picked)[:DICTIONARY_BYTES]
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words), write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(words)), words, *(press.compress(r) for r in records)])


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start")
    expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    view, at = memoryview(data), 8 + size
    while at < len(data):
        frame, parts = expand.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("a record's frame is cut short")
            step = view[at : at + STEP]
            parts.append(frame.decompress(step))
            at += len(step)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def decisions(pages: DataFrame, tables: Tables, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """key, sha1, first, first_url of the rows that are revisits: their payload's smallest key, where it is not their own.

    Payloads of fewer than ``least`` bytes are never revisited. Rows equal in
    key and payload all count as the first; a null key is never referred to.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    seen = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.sha1(body).alias("sha1"), F.octet_length(body).alias("size")).where(F.col("size") >= least)
    least_row = F.min(F.when(F.col("key").isNotNull(), F.struct("key", "url"))).alias("f")
    firsts = seen.groupBy("sha1", "size").agg(least_row, F.count(F.lit(1)).alias("n")).where("n > 1 and f is not null")
    firsts = tables.write(firsts.select("sha1", "size", F.col("f.key").alias("first"), F.col("f.url").alias("first_url")), "firsts")
    revisits = seen.join(firsts, ["sha1", "size"]).where(~F.col("key").eqNullSafe(F.col("first")))
    return revisits.select("key", "sha1", "first", "first_url").distinct()


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z", tables: Tables | None = None) -> DataFrame:
    """Write a record for each row into archives under ``path`` (a URI all machines reach).

    Null payloads count as empty. Returns the manifest: part, archive, records,
    bytes; an archive's file is ``path/part/archive``.
    """
    small_batches(pages.sparkSession)
    tables = tables or Tables(pages.sparkSession)
    marks = tables.write(decisions(pages, tables, key, url, payload, least), "revisits")
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("digest", F.sha1("body"))
    full = rows.join(marks, F.col("id").eqNullSafe(F.col("key")) & (F.col("digest") == F.col("sha1")), "left").select("id", "url", "body", "digest", "first", "first_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pyarrow.fs.FileSystem.from_uri(path)
        part = f"part-{TaskContext.get().partitionId():06d}"
        folder = f"{folder}/{part}"
        store.create_dir(folder, recursive=True)

        def flush(records: list[bytes]) -> pa.RecordBatch:  # the name must not make pyarrow compress the file as a whole
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            data = build_archive(records)
            with store.open_output_stream(f"{folder}/.{name}", compression=None) as f:
                f.write(data)
            store.move(f"{folder}/.{name}", f"{folder}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([name]), pa.array([len(records)]), pa.array([len(data)])], ["part", "archive", "records", "bytes"])

        held: list[bytes] = []
        size = 0
        for batch in batches:
            for page, link, body, digest, first, first_url in zip(*(batch.column(i).to_pylist() for i in range(6))):
                held.append(build_record(page, link, body, base64.b32encode(bytes.fromhex(digest)).decode(), first, first_url, date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    manifest = tables.write(full.mapInArrow(run, "part string, archive string, records long, bytes long"), "manifest")
    clean_up(manifest, path)
    return manifest


def _tasks(manifest: DataFrame) -> int:
    """Tasks for the archives of a manifest: as many as run at once, more where there are more bytes."""
    seen = manifest.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    at_once = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return max(1, min(seen["n"], max(at_once, -(-seen["bytes"] // READ_BYTES))))


def clean_up(manifest: DataFrame, path: str) -> int:
    """Delete what is in the manifest's parts but not in the manifest: what failed tasks wrote. Returns how many files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            gone = 0
            for part, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in store.get_file_info(pyarrow.fs.FileSelector(f"{folder}/{part}", allow_not_found=True)):
                    if f.base_name not in names and f.is_file:
                        store.delete_file(f.path)
                        gone += 1
            yield pa.RecordBatch.from_arrays([pa.array([gone])], ["gone"])

    parts = manifest.groupBy("part").agg(F.collect_list("archive").alias("names"))
    return parts.mapInArrow(run, "gone long").agg(F.coalesce(F.sum("gone"), F.lit(0)).alias("n")).first()["n"]


def read_archives(manifest: DataFrame, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives of a manifest; digests and lengths are checked.

    page_id, url, payload_bytes and payload_digest (both of the full payload),
    record_type, refers_to, and with ``payloads`` the payload (null for
    revisits).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pyarrow.fs.FileSystem.from_uri(path)

        def rows(part: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 6 + payloads]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], names[: len(kinds)])

        for batch in batches:
            for part_, name, expected in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with store.open_input_stream(f"{folder}/{part_}/{name}", compression=None) as f:
                    data = f.read()
                part, seen = [], 0
                for record in read_archive(data):
                    fields, body, length = parse_record(record)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and (len(body) != length or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
                        raise ValueError(f"the payload of {fields['WARC-Record-ID']} in {name} does not match its digest")
                    row = (page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), length, digest, kind, page_of(fields.get("WARC-Refers-To")))
                    part.append((*row, body if kind == "response" else None) if payloads else row)
                    seen += 1
                    if len(part) == 500:
                        yield rows(part)
                        part = []
                if part:
                    yield rows(part)
                if seen != expected:
                    raise ValueError(f"{name} has {seen} records, not {expected}")

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    return manifest.select("part", "archive", "records").repartition(_tasks(manifest), "archive").mapInArrow(run, schema)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", payloads: bool = False) -> DataFrame:
    """Write the pages into archives in the shared folder and read those back."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(pages, path, key, url, payload)
    return read_archives(manifest, path, payloads)
