"""Helpers shared by the training-data operators.

Everything that outlives a task is written under ``spark.checkpoint.dir``, the
folder all machines share.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows in one Arrow batch of documents or pages. A row can be hundreds of
#: kilobytes, so the default of 10,000 rows would not bound a worker's memory.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, lengthened until no column has them (names count without case, as Spark has it)."""
    lower = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name += "_"
        lower.add(name.lower())
        out.append(name)
    return out


#: What Python workers remember between tasks; they serve the tasks of all operators.
CACHES: list[dict] = []


def free_memory() -> None:
    """In a Python worker, at the start of a task: forget what other operators' tasks remembered."""
    if any(CACHES):
        for x in CACHES:
            x.clear()
        give_back()


def give_back() -> None:
    """In a Python worker, at the end of a task: workers stay, and what they hold but do not use is missing elsewhere in the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that begins without other operators' memory and gives back its own."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, wherever it is started from."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tripmill-")) / "tripmill.zip"  # the driver's copy; Spark hands it on
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.writestr(zipfile.ZipInfo(str(f.relative_to(package.parent))), f.read_bytes())
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(spark.sparkContext.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Prepare a session for Python operators: bounded Arrow batches, and the package on the executors.

    The bound is read when a plan runs, so it is the same for all operators;
    those that want more rows at once put batches together themselves.
    """
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where the session names none: a temporary folder if all runs on this
    machine, as in tests, else one in the warehouse.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("tripmill.shared.dir", None)
    if not found:
        here = re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master)
        found = f"file://{tempfile.mkdtemp(prefix='tripmill-')}" if here else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tripmill"
        spark.conf.set("tripmill.shared.dir", found)
    return found.rstrip("/")


class Tables:
    """The tables that one run of an operator writes in the shared folder.

    What a result still reads is left when the operator returns; whoever has
    the object can drop it when the result is written.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.held: list[DataFrame] = []  # so that no id is used twice

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        """Write df as Parquet and read it back.

        Cuts the lineage: a lost executor costs the tasks that read its files,
        not the work that made them.
        """
        path = f"{shared_dir(self.spark)}/{tag}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        self.held.append(back)
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no plan refers to any more."""
        for t in tables:
            path = self.paths.pop(id(t), None)
            if path:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def sweep(self, *keep: DataFrame) -> None:
        """Delete all but what a result still reads; let shuffle files go, too."""
        names = {id(t) for t in keep}
        self.drop(*[t for t in self.held if id(t) not in names])
        self.let_go()

    def let_go(self) -> None:
        """Let Spark delete the shuffle files of finished steps.

        Its cleaner does so once the driver has collected what referred to
        them, which it otherwise does when its memory runs low; and it holds on
        to those of its latest action.
        """
        self.spark.range(1).collect()
        gc.collect()
        self.spark._jvm.System.gc()
