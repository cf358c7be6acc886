"""SimHash near-duplicates found through Golay-code fuzzy keys.

A fingerprint has one bit for each of 64 hash bits, set where over half of a
document's shingle hashes set it. Two fingerprints link at ``RADIUS`` = 2 or
fewer differing bits. The fingerprint is cut into three segments; two errors
leave one of them without any, so a key is one segment as it is and the Golay
indices of another, which tolerates both errors. Fingerprints that share a key
are joined and verified, so no link is lost and none is made up.

A key that very many different fingerprints share is not joined with itself.
Its fingerprints are linked through midpoints instead: two fingerprints differ
in at most two bits exactly if some value is within one bit of both, so 65 rows
for each fingerprint give the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import golay
from tripmill.llm.common import Tables, small_batches, tidy
from tripmill.llm.components import components

RADIUS = 2
#: Fingerprints of one key that are compared in pairs; more are linked through midpoints.
BUCKET = 256
#: (lowest bit, width) of the segments, and which pairs make keys: (as it is, fuzzy).
SEGMENTS = ((0, 23), (23, 23), (46, 18))
KEYS = ((0, 1), (1, 0), (2, 0))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z as small letters; none of a null text."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(parts: list[bytes], words: int) -> np.ndarray:
    """XXH64 (seed 42) of all shingles of a text's words, repeats included.

    Fewer words are one shingle, no words are none.
    """
    if not parts:
        return np.zeros(0, "u8")
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], "u8")
    ends = np.cumsum(np.fromiter(map(len, parts), "i8", len(parts)) + 1)
    starts = [0, *ends[: len(parts) - words].tolist()]
    h = xxhash.xxh64_intdigest
    return np.fromiter([h(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], "u8", len(parts) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes; 0 where there are none."""
    if not len(hashes):
        return 0
    count = np.zeros(64, "i8")
    for at in range(0, len(hashes), 65536):  # bounds the unpacked bits of a very long text
        part = hashes[at : at + 65536]
        count += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i4")
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, fp (the fingerprint as a long) of every row."""
    small_batches(docs.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([majority(shingle_hashes(words_of(t), words)) for t in batch.column(1).to_pylist()], "u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view("i8"))], [key, "fp"])

    return docs.select(key, text).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, fp long")


def fuzzy_keys(classes: DataFrame) -> DataFrame:
    """key, fp, rep: every fingerprint under each of its keys (3 to 18)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            segment = [(fp.view("u8") >> np.uint64(at)).astype("i8") & ((1 << width) - 1) for at, width in SEGMENTS]
            keys, rows = [], []
            for t, (exact, fuzzy) in enumerate(KEYS):
                index, counts = golay.indices(segment[fuzzy])
                at = np.nonzero(counts)
                keys.append((t << 60) | (segment[exact][at[0]] << golay.MESSAGE) | index[at])
                rows.append(at[0])
            rows = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype("i8")), pa.array(fp[rows]), batch.column(1).take(pa.array(rows))], ["key", "fp", "rep"])

    return classes.select("fp", "rep").mapInArrow(run, f"key long, fp long, rep {dict(classes.dtypes)['rep']}")


def links(classes: DataFrame, tables: Tables, bucket: int = BUCKET) -> DataFrame:
    """a, b: representatives whose fingerprints are connected by links of at most RADIUS bits.

    Every link of a key with at most ``bucket`` fingerprints is there; the
    others are there as paths through midpoints' smallest members.
    """
    keys = tables.write(fuzzy_keys(classes), "keys")
    hot = tables.write(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).select("key"), "hot")
    some = not hot.isEmpty()
    cool = keys.join(hot, "key", "left_anti") if some else keys
    x, y = cool.alias("x"), cool.alias("y")
    near = (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= RADIUS)
    found = x.join(y, (F.col("x.key") == F.col("y.key")) & near).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    if not some:
        return found
    members = keys.join(hot, "key", "left_semi").select("fp", "rep").distinct()
    around = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    middles = tables.write(members.select("rep", F.explode(around).alias("mid")), "middles")
    hubs = middles.groupBy("mid").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = tables.write(hubs.select("mid", "hub"), "hubs")
    return found.unionByName(middles.join(hubs, "mid").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")))


def groups(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id", bucket: int = BUCKET, tables: Tables | None = None) -> DataFrame:
    """key, fp, component_id of every row; component_id is the smallest key reachable.

    Rows with equal fingerprints are one class from the start, so groups of
    exact copies cost one row each. Null and blank texts have fingerprint 0 and
    are linked like any other. Rows with equal keys stay separate rows. A null
    key is no candidate for component_id; a group of null keys alone has null.
    """
    tables = tables or Tables(docs.sparkSession)
    prints = tables.write(fingerprints(docs, words, text, key), "prints")
    classes = tables.write(prints.groupBy("fp").agg(F.min(key).alias("rep")), "classes")
    named = components(links(classes.where(F.col("rep").isNotNull()), tables, bucket), tables=tables)
    wide = classes.join(named, classes["rep"] == named["node"], "left").select(F.col("fp").alias("class"), F.coalesce("component", "rep").alias("component_id"))
    wide = tables.write(wide, "classes")
    tables.sweep(prints, wide)
    return prints.join(wide, prints["fp"] == wide["class"]).select(key, "fp", "component_id")
