"""Small files through Hadoop's file systems, so any store Spark reads will do."""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.identity import run_id
from tripmill.sources.schema import ContractError, check_month


class Files:
    """Whole-file reads and exclusive writes on the driver; for metadata, not data."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.conf)

    def qualified(self, path: str) -> str:
        """The path as a URI: with the scheme of its file system, the default one if it names none."""
        at, fs = self._at(path)
        return fs.makeQualified(at).toString()

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def size(self, path: str) -> int:
        at, fs = self._at(path)
        return fs.getFileStatus(at).getLen()

    def names(self, path: str) -> list[str]:
        at, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def remove(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, False)

    def rename(self, path: str, to: str) -> None:
        at, fs = self._at(path)
        fs.rename(at, self.jvm.org.apache.hadoop.fs.Path(to))

    def remove_folder(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)

    def read(self, path: str) -> bytes:
        at, fs = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write_new(self, path: str, data: bytes) -> None:
        """Create the file with all of its content, or raise FileExistsError.

        Nobody sees a file that is cut short, and of several writers one wins. How
        depends on the store (``COMMITS``): a draft that is linked or renamed where
        that is one step and replaces nothing, a conditional put where a file
        appears as it is closed. A store of another kind is refused, unless
        ``tripmill.commit.<scheme>`` names one of these ways for it.
        """
        at, fs = self._at(path)
        scheme = fs.getScheme()
        way = self.spark.conf.get(f"tripmill.commit.{scheme}", COMMITS.get(scheme))
        if way not in WAYS:
            raise ContractError(f"no safe way to commit a file is known for {scheme}:; name one in tripmill.commit.{scheme}")
        if fs.exists(at):
            raise FileExistsError(path)
        try:
            getattr(self, f"_by_{way}")(at, fs, data)
        except Exception as error:  # of the JVM, in whose stores a lost race has many names
            if "AlreadyExists" in str(error) or fs.exists(at):
                raise FileExistsError(path) from error
            raise

    @staticmethod
    def _fill(stream, data: bytes) -> None:
        try:
            stream.write(data)
        finally:
            stream.close()

    def _draft(self, at, fs, data: bytes):
        draft = self.jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
        self._fill(fs.create(draft, False), data)
        return draft

    def _by_link(self, at, fs, data: bytes) -> None:
        draft = self._draft(at, fs, data)
        try:
            here = [self.jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (at, draft)]
            self.jvm.java.nio.file.Files.createLink(*here)
        finally:
            fs.delete(draft, False)

    def _by_rename(self, at, fs, data: bytes) -> None:
        draft = self._draft(at, fs, data)
        kinds = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.gateway.new_array(kinds, 1)
        none[0] = kinds.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(draft, at, none)
        finally:
            fs.delete(draft, False)

    def _by_put(self, at, fs, data: bytes) -> None:
        """The store itself refuses to replace a file when this one is closed."""
        self._fill(fs.create(at, False), data)

    def _by_conditional(self, at, fs, data: bytes) -> None:
        """The same, asked for by an option that the store has to know."""
        builder = fs.createFile(at).overwrite(False).recursive().must("fs.option.create.conditional.overwrite", True)
        self._fill(builder.build(), data)


#: How a file is committed in stores of each scheme; see ``Files.write_new``.
COMMITS = {"file": "link", "hdfs": "rename", "viewfs": "rename", "s3a": "conditional", "gs": "put", "abfs": "put", "abfss": "put"}
WAYS = ("link", "rename", "put", "conditional")


def checksums(spark: SparkSession, uris: list[str]) -> dict[str, tuple[str, int]]:
    """SHA-256 and size of whole files, made where Spark's tasks run: a task for each, several at once.

    No byte of them passes the driver. A task holds its file in memory, which Spark
    allows up to 2 GB; a larger file is refused by its reader.
    """
    found = {u: (hashlib.sha256().hexdigest(), 0) for u in uris}  # the reader gives no row for an empty file
    for r in _one_task_each(spark, spark.read.format("binaryFile"), list(found)).collect():
        if found[r["uri"]][1]:
            raise ContractError(f"{r['uri']} is more than one file")
        found[r["uri"]] = (r["sha256"], r["length"])
    return found


def _one_task_each(spark: SparkSession, reader, uris: list[str]) -> DataFrame:
    """uri, sha256 and length of each file; the plan is a union, so files of any size are tasks of their own."""
    each = [reader.load(u).select(F.lit(u).alias("uri"), F.sha2("content", 256).alias("sha256"), "length") for u in uris]
    return functools.reduce(DataFrame.unionByName, each)


def file_name(year: int, month: int) -> str:
    check_month(year, month)
    return f"fhvhv_tripdata_{year}-{month:02d}.parquet"


@dataclass(frozen=True)
class SourceFile:
    """One immutable monthly file: where it is and what it must contain."""

    year: int
    month: int
    uri: str
    checksum: str
    size: int

    @property
    def run_id(self) -> str:
        return run_id(self.uri, self.checksum, self.size, self.year, self.month)

    def validate(self) -> None:
        expected = file_name(self.year, self.month)
        scheme, _, rest = self.uri.partition(":")
        if not re.fullmatch("[a-z][a-z0-9+.-]*", scheme) or rest.rsplit("/", 1)[-1] != expected:
            raise ContractError(f"a landed source must be a URI ending in {expected}")
        if not re.fullmatch("[0-9a-f]{64}", self.checksum):
            raise ContractError("a source checksum must be a lower-case SHA-256 digest")
        if self.size <= 0:
            raise ContractError("a source must not be empty")

    def verify(self, spark: SparkSession) -> None:
        """Refuse a landed file that is not the one it is said to be."""
        if Files(spark).size(self.uri) != self.size:
            raise ContractError(f"{self.uri} does not have {self.size} bytes")
        if checksums(spark, [self.uri])[self.uri][0] != self.checksum:
            raise ContractError(f"{self.uri} does not match its checksum")

    @classmethod
    def of(cls, spark: SparkSession, year: int, month: int, uri: str) -> SourceFile:
        return cls.all_of(spark, [(year, month, uri)])[0]

    @classmethod
    def all_of(cls, spark: SparkSession, months: list[tuple[int, int, str]]) -> list[SourceFile]:
        """The files of several months, their checksums made in one job."""
        made = checksums(spark, [uri for _, _, uri in months])
        return [cls(year, month, uri, *made[uri]) for year, month, uri in months]
