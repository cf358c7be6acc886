"""Fill-in-middle texts, made by SQL inside ``mapInArrow``.

Each Arrow batch is registered in an in-memory DuckDB of the worker. Its SQL cuts
texts into code points, takes prefix, suffix and middle as list slices, joins them
with the sentinels, rebuilds the text from the output alone, and hashes both. No
row passes through Python. Batches are cut by bytes, as a list of code points takes
some 16 times the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tripmill.llm.common import CACHES, free_names, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, as many are left plain, and of a hundred others as many go suffix first.
PLAIN, SPM = 10, 20
#: Bytes of texts in one query; a longer text is one of its own.
SLAB = 2_000_000

_SQL = f"""
WITH cut AS (
    SELECT place, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '(?s).') AS units, sha256('1:' || coalesce(name, '')) AS h FROM slab),
drawn AS (
    SELECT place, whole, units, CAST(len(units) AS BIGINT) AS n,
           list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS r FROM cut),
placed AS (
    SELECT place, whole, units, n, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(whole, '{PREFIX}') OR contains(whole, '{SUFFIX}') OR contains(whole, '{MIDDLE}') OR r[3] % 100 >= {100 - PLAIN} THEN 'plain'
                WHEN r[4] % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
    SELECT place, whole, n, a, b, form, array_to_string(list_slice(units, 1, a), '') AS prefix,
           array_to_string(list_slice(units, a + 1, b), '') AS middle, array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM placed),
made AS (
    SELECT place, n, a, b, form, CASE form WHEN 'plain' THEN whole
        WHEN 'psm' THEN array_to_string(['{PREFIX}', prefix, '{SUFFIX}', suffix, '{MIDDLE}', middle], '')
        ELSE array_to_string(['{SUFFIX}', suffix, '{PREFIX}', prefix, '{MIDDLE}', middle], '') END AS output FROM parts),
sought AS (
    -- no part has a sentinel, so each is where it stands first
    SELECT *, instr(output, '{PREFIX}') AS p, instr(output, '{SUFFIX}') AS s, instr(output, '{MIDDLE}') AS m FROM made),
rebuilt AS (
    SELECT *, CASE form WHEN 'plain' THEN output
        WHEN 'psm' THEN array_to_string([substr(output, p + 3, s - p - 3), substr(output, m + 3), substr(output, s + 3, m - s - 3)], '')
        ELSE array_to_string([substr(output, p + 3, m - p - 3), substr(output, m + 3), substr(output, s + 3, p - s - 3)], '') END AS restored FROM sought)
SELECT n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(output) AS output_sha256, sha256(restored) AS restored_sha256, output, restored
FROM rebuilt ORDER BY place
"""
_COLUMNS = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output_sha256": "string", "restored_sha256": "string"}
_TEXTS = {"output": "string", "restored": "string"}
_KINDS = {"long": pa.int64(), "string": pa.string()}

_OPEN: dict[str, object] = {}
CACHES.append(_OPEN)


def _database():
    """One in-memory database for each Python worker, with one thread, as Spark has a worker for each core."""
    if "db" not in _OPEN:
        import duckdb

        _OPEN["db"] = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "preserve_insertion_order": True})
        _OPEN["db"].execute("SET enable_progress_bar = false")
    return _OPEN["db"]


def _slabs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    end = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype="i8")
    first = 0
    while first < len(texts):
        upto = (end[first - 1] if first else 0) + SLAB
        last = max(int(np.searchsorted(end, upto, "right")), first + 1)
        yield first, last
        first = last


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", outputs: bool = False) -> DataFrame:
    """Fill-in-middle of every text: key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    With ``outputs`` also output and restored. Where texts are cut and in which
    form they come follows from the key alone, so rows of equal key and text are
    equal; a null key draws like an empty name. Null texts count as empty, and
    those are plain. Other columns are left out, so their names do not matter (a
    key named like an output column is an error). One narrow pass, no shuffle.
    """
    small_batches(docs.sparkSession)
    columns = _COLUMNS | (_TEXTS if outputs else {})
    if free_names(list(columns), key) != [key]:
        raise ValueError(f"the key column must not be called {key}")
    schema = f"`{key}` {dict(docs.dtypes)[key]}, " + ", ".join(f"{c} {t}" for c, t in columns.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = _database()
        for batch in batches:
            for first, last in _slabs(batch.column(2)):
                part = batch.slice(first, last - first)
                slab = pa.table({"place": np.arange(len(part)), "name": part.column(1), "text": part.column(2)})
                db.register("slab", slab)
                found = db.sql(_SQL).to_arrow_table().combine_chunks()
                db.unregister("slab")
                made = [found.column(c).cast(_KINDS[t]).combine_chunks() for c, t in columns.items()]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], [key, *columns])

    return docs.select(key, docs[key].cast("string").alias("name"), text).mapInArrow(run, schema)
