"""What Python workers hold while they work and afterwards."""

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

from tripmill.llm import nearcopies, suffixdedup
from tripmill.llm.common import tidy


class Captured:
    """In place of a frame: gives the function that it was to run."""

    def repartition(self, *by):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, run, schema):
        return run


def test_suffixes_are_sorted_in_small_buffers():
    rng = np.random.default_rng(5)
    n, each, size = 4000, 10, 368  # 1.5 MB of contexts, ten of each minimizer, the first two of them alike but for a byte
    texts = rng.integers(97, 123, (n, size), "u1")
    texts[1::each] = texts[::each]
    texts[1::each, 0] ^= 1
    ids = np.arange(n)
    kinds = [*[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]
    columns = [ids // each, ids, ids, np.ones(n, "i8"), ids, np.full(n, 168), np.full(n, 168), [t.tobytes() for t in texts]]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["h", "ctx", "ctx2", "n", "rid", "pos", "lead", "bytes"])
    run = suffixdedup._sorted_suffixes(Captured(), 200)
    tracemalloc.start()
    try:
        found = list(run(iter([batch.slice(i, 512) for i in range(0, n, 512)])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6, peak
    rows = {x["ctx"]: (x["dups"], x["later"]) for b in found for x in b.to_pylist()}
    assert rows == {i + j: ([1 - 168, 0], [1 - 168, 0] if j else []) for i in range(0, n, each) for j in (0, 1)}


def held_mb():
    return int(re.search(r"\nRss(?:Anon)?:\s+(\d+)", Path("/proc/self/status").read_text().replace("VmRSS", "Rss"))[1]) / 1024


def test_a_task_gives_back_what_it_no_longer_uses():
    pins, before = [], held_mb()

    def run(batches):
        held = [b"x" * 1000 + b"%d" % i for i in range(100_000)]
        pins.append(b"x" * 1000 + b"last")  # above them, so that the heap can't just shrink
        assert held_mb() - before > 80
        yield from batches
        del held

    assert list(tidy(run)(iter([1, 2]))) == [1, 2]
    assert held_mb() - before < 40


def test_no_python_worker_for_frames_without_rows(spark):
    made = nearcopies._no_pairs(spark, "a", "b")
    assert made.dtypes == [("a", "bigint"), ("b", "bigint")] and not made.count()
    assert "ExistingRDD" not in made._jdf.queryExecution().toString()
