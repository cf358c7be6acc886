"""What surrounds the steps of a month: retries, a journal, one run at a time, statements with a time limit."""

from __future__ import annotations

import contextlib
import gc
import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor, wait
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession

from tripmill.sources.files import Files
from tripmill.sources.schema import ConflictError, ContractError

T = TypeVar("T")

#: Further attempts of a step, and the seconds before each of them.
RETRIES, PAUSE = 2, 300.0
#: Seconds that a statement may take; the session's setting goes first.
LIMIT, LIMIT_SETTING = 60.0, "tripmill.statement.seconds"
#: Seconds within which a cancelled statement has to end.
GRACE = 30.0


class StatementError(RuntimeError):
    """A statement failed or took too long."""


class RunningError(RuntimeError):
    """Another run holds the tables."""


def retried(step: Callable[[], T], final: tuple[type[Exception], ...] = (ContractError,), retries: int = RETRIES, pause: float = PAUSE) -> T:
    """The step's result. A failure is tried again, but for the kinds that another attempt can't change; a lost race is none of those."""
    for left in range(retries, -1, -1):
        try:
            return step()
        except Exception as error:
            if not left or (isinstance(error, final) and not isinstance(error, ConflictError)):
                raise
            time.sleep(pause)
    raise ValueError("retries must not be negative")


class Journal:
    """What the steps of one run gave, so that a run that stopped goes on at the step that failed.

    An entry is a file that is written once, when its step has ended, and holds the
    step's result and the digest of both; one that does not match its digest counts
    as none. A run that is complete has no journal any more: the next one begins
    with the first step, whose guard knows what is published.
    """

    def __init__(self, spark: SparkSession, root: str, run: str) -> None:
        self.files, self.folder = Files(spark), f"{root}/_journal/{run}"

    def done(self) -> list[str]:
        return [n[:-5] for n in self.files.names(self.folder) if n.endswith(".json") and not n.startswith(".")]

    def step(self, name: str, do: Callable[[], T]) -> T:
        """The step's result, kept or made now. It has to be plain JSON."""
        path = f"{self.folder}/{name}.json"
        if self.files.exists(path):
            kept = sealed(self.files.read(path))
            if kept is not None:
                return kept["result"]
            self.files.remove(path)
        result = do()
        with contextlib.suppress(FileExistsError):
            self.files.write_new(path, seal({"step": name, "result": result, "ended": datetime.now(timezone.utc).isoformat()}))
        return result

    def clear(self) -> None:
        self.files.remove_folder(self.folder)


def seal(content: Mapping) -> bytes:
    """A file that proves itself: its content with that content's digest, as canonical JSON."""
    return canonical_json({**content, "sha256": hashlib.sha256(canonical_json(content)).hexdigest()})


def sealed(payload: bytes) -> dict | None:
    """The content of such a file, none if it is not what was sealed."""
    try:
        content = json.loads(payload)
        digest = content.pop("sha256")
    except (ValueError, KeyError, TypeError, AttributeError):
        return None
    return content if hashlib.sha256(canonical_json(content)).hexdigest() == digest else None


def canonical_json(document: Mapping) -> bytes:
    return (json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=True) + "\n").encode()


@contextlib.contextmanager
def alone(spark: SparkSession, root: str, run: str, take_over: bool = False) -> Iterator[None]:
    """Holds the tables under root for one run. What a crashed run left is removed by ``take_over``."""
    files, path = Files(spark), f"{root}/_running.json"
    if take_over:
        files.remove(path)
    mine = json.dumps({"run": run, "token": uuid.uuid4().hex, "since": datetime.now(timezone.utc).isoformat()}).encode()
    try:
        files.write_new(path, mine)
    except FileExistsError:
        holder = files.read(path).decode() if files.exists(path) else "a run that ended just now"
        raise RunningError(f"{path} is held by {holder}") from None
    try:
        yield
    finally:
        if files.exists(path) and files.read(path) == mine:  # not one that took over
            files.remove(path)


def rows_of(statement: DataFrame, seconds: float | None = None) -> list[Row]:
    """The few rows of a statement. Its jobs are cancelled if it takes longer than its limit."""
    spark, tag = statement.sparkSession, f"tripmill-{uuid.uuid4().hex}"
    seconds = float(spark.conf.get(LIMIT_SETTING, str(LIMIT))) if seconds is None else seconds

    def work() -> list[Row]:
        spark.sparkContext.addJobTag(tag)  # of this thread's jobs
        return statement.collect()

    pool = ThreadPoolExecutor(1)
    try:
        found = pool.submit(work)
        if wait([found], seconds).not_done:
            end = time.monotonic() + GRACE
            while time.monotonic() < end and not found.done():  # a job may begin after the first call
                spark.sparkContext.cancelJobsWithTag(tag)
                wait([found], 0.5)
            raise StatementError(f"a statement took more than {seconds:g} s")
        if error := found.exception():
            raise StatementError(f"a statement failed: {error}") from error
        return found.result()
    finally:
        pool.shutdown(wait=False)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more, which it finds out when the driver collects garbage."""
    gc.collect()  # references from Python
    spark._jvm.java.lang.System.gc()
