"""Near-duplicate embeddings by cross-polytope hashing.

A hash rotates a vector at random (three rounds of random signs and a fast
Hadamard transform) and takes the nearest vertex of the cross-polytope: the
largest component and its sign. A table's code joins ``depth`` hashes; further
probes replace the hash whose runner-up is closest by that runner-up. A vector
stands in the bucket of each of its probes.

What stands there is an id and a sketch of 128 random signs, not the vector.
Vectors with the wanted cosine differ in few signs (in more than ``SIGNS`` less
than once in 10^9 pairs), unrelated ones in half of them, so the members of a
bucket are compared by sketches, and each sends on a link to the smallest member
of its part: of what is close to it, to that, and so on. The connected parts of
these links are groups of candidates: all that any bucket brought together is in
one group.

Each vector is then sent to its group, once, and all pairs of a group are
verified on the vectors in double precision. A pair is in one group only, so
links are counted once. Equal vectors with one label are one class from the
start.

Buckets and groups of any size are cut into blocks, and each pair of blocks is a
task's work, so a hot one is spread over many.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.ann import unit_rows, usable
from tripmill.llm.common import Tables, small_batches
from tripmill.llm.components import components

#: Cosine from which two vectors link.
COSINE = 0.98
#: Members of a group, and sketches of a bucket, that are compared at a time.
BLOCK, SKETCHES = 1024, 4096
#: Tables by depth: at cosine 0.98 a pair that nothing else connects is missed less than once in 100,000.
TABLES = {1: 9, 2: 13, 3: 18}
PROBES = 3
#: Members that a bucket should have at most, by chance.
CROWD = 512
#: Signs of 128 in which the sketches of a pair with cosine 0.98 differ at most; 8 are expected.
SIGNS = 28


def width_of(d: int) -> int:
    """The power of two that vectors of d components are padded to."""
    return 1 << max(1, (max(2, d) - 1).bit_length())


def depth_for(classes: int, width: int = 64) -> int:
    """Hashes of one code: as many as keep buckets under CROWD members."""
    return min(3, max(1, math.ceil(math.log(max(1, classes / CROWD)) / math.log(2 * width))))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The unnormalised fast Hadamard transform of each row; the width is a power of two."""
    n, step = x.shape[1], 1
    x = x.copy()
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        low, high = y[:, :, 0], y[:, :, 1]
        less = low - high
        low += high
        high[...] = less
        step *= 2
    return x


def padded(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width_of(x.shape[1]) - x.shape[1]))).astype("f4")


def codes(x: np.ndarray, tables: int, depth: int) -> np.ndarray:
    """Bucket codes (vectors x tables x PROBES), base code first."""
    x = padded(x)
    width = x.shape[1]
    rng = np.random.default_rng(width * 100 + depth)
    out = np.zeros((len(x), tables, PROBES), "i8")
    rows = np.arange(len(x))[:, None]
    for t in range(tables):
        tops, gaps = [], []
        for _ in range(depth):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice(np.array([-1, 1], "f4"), width)) / np.float32(math.sqrt(width))
            # the nearest vertices are those of the largest components, by size
            size = np.abs(y)
            top = np.argpartition(-size, min(PROBES, width) - 1, axis=1)[:, :PROBES]
            top = np.take_along_axis(top, np.argsort(-size[rows, top], axis=1, kind="stable"), 1)
            top = np.concatenate([top, np.repeat(top[:, -1:], max(0, PROBES - width), 1)], 1)
            near = size[rows, top]
            tops.append(2 * top + (y[rows, top] < 0))
            gaps.append(near[:, :1] - near[:, 1:])
        scale = (2 * width) ** np.arange(depth)
        base = sum(top[:, 0] * s for top, s in zip(tops, scale))
        # the likeliest changes: one hash takes its second or third vertex
        change = np.concatenate([(top[:, 1:] - top[:, :1]) * s for top, s in zip(tops, scale)], 1)
        likely = np.argsort(np.concatenate(gaps, 1), axis=1, kind="stable")[:, : PROBES - 1]
        out[:, t, 0] = base
        out[:, t, 1:] = base[:, None] + np.take_along_axis(change, likely, 1)
    return out


def sketches(x: np.ndarray) -> np.ndarray:
    """128 random signs of each vector, as two numbers."""
    x = padded(x)
    a = np.random.default_rng(x.shape[1] * 100).standard_normal((x.shape[1], 128)).astype("f4")
    return np.packbits(x @ a > 0, axis=1).view("u8")


def close(sketch: np.ndarray, cid: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For each member, the smallest one of its part, itself included; members whose sketches are close are in one part.

    side: 0 and 1 for the two blocks that are compared, or all 0 for one block
    with itself. A member that sent on only the smallest one close to it would part
    pairs: the smallest of either may be close to nothing else.
    """
    order = np.argsort(cid, kind="stable")
    place = np.empty(len(cid), "i8")
    place[order] = np.arange(len(cid))
    root = np.arange(len(cid))  # by place; always the smallest place of a part
    a_all, b_all = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(cid)),) * 2
    for at in range(0, len(a_all), 256):
        part = a_all[at : at + 256]
        apart = np.bitwise_count(sketch[part, None, 0] ^ sketch[None, b_all, 0]) + np.bitwise_count(sketch[part, None, 1] ^ sketch[None, b_all, 1])
        a, b = np.nonzero(apart <= SIGNS)
        _join(root, place[part[a]], place[b_all[b]])
    return cid[order][root[place]]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Makes one part of those of a[i] and b[i], for each i."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def linked(cid: np.ndarray, size: np.ndarray, x: np.ndarray, side: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each member, and the smallest one of its part, itself included; x has rows of length 1, side is as above.

    Members that are linked are in one part, as in ``close``: the smallest one linked to each would not keep all links.
    """
    order = np.argsort(cid, kind="stable")
    place = np.empty(len(cid), "i8")
    place[order] = np.arange(len(cid))
    links, root = np.zeros(len(cid), "i8"), np.arange(len(cid))
    both = bool(side.any())
    a_all, b_all = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if both else (np.arange(len(cid)),) * 2
    for at in range(0, len(a_all), 512):
        part = a_all[at : at + 512]
        a, b = np.nonzero(x[part] @ x[b_all].T >= cosine)
        a, b = part[a], b_all[b]
        if not both:
            a, b = a[a < b], b[a < b]
        _join(root, place[a], place[b])
        links += np.bincount(a, size[b], len(cid)).astype("i8") + np.bincount(b, size[a], len(cid)).astype("i8")
    return links, cid[order][root[place]]


def _cells(df: DataFrame, group: str, block: int) -> DataFrame:
    """df (cid, its group, n: the group's size) with the pairs of blocks of its group that a row takes part in: i, j, side."""
    df = df.withColumn("g", F.ceil(F.col("n") / F.lit(block)).cast("int")).withColumn("own", F.pmod(F.xxhash64("cid", F.lit("block")), F.col("g")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    df = df.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int"))
    return df.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j").drop("g", "own", "other", "n")


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows that agree in their first three columns (group, i, j)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and (a or (keys[:, 0] != last).any()):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = keys[:, -1]
    if held:
        yield pa.Table.from_batches(held)


def _meets(run: pa.Table, side: np.ndarray) -> bool:
    """Whether a run has anything to compare: a block with itself, or two blocks that both have members."""
    return len(side) > 1 and (run.column("i")[0] == run.column("j")[0] or (side.any() and not side.all()))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK, tables: Tables | None = None) -> DataFrame:
    """key, n_links, component_id, kept of every row.

    Links join vectors of one label with at least ``cosine``. Null, zero and
    non-finite vectors and rows with a null label or key link with nothing
    (component_id is their own key); components may have any finite magnitude.
    Vectors of different lengths do not link. Rows with equal keys stay separate
    rows and count as separate vectors. Other columns are left out.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    tables = tables or Tables(spark)
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("l"))
    takes = usable("v") & F.col("l").isNotNull() & F.col("id").isNotNull()
    classes = rows.where(takes).groupBy("l", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = tables.write(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    seen = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    depth = depth_for(seen["n"], width_of(seen["d"] or 2))
    many = TABLES[depth]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vs = [np.asarray(v) for v in batch.column(0).to_pylist()]
            lengths = np.array([len(v) for v in vs])
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x, _ = unit_rows(np.stack([vs[i] for i in at]))
                take = pa.array(np.repeat(at, many * PROBES))
                sketch = np.repeat(sketches(x).view("i8"), many * PROBES, axis=0)
                table = np.tile(np.repeat(np.arange(many, dtype="i4"), PROBES), len(at))
                columns = [batch.column(1).take(take), pa.array(np.full(len(take), d, "i4")), pa.array(table), pa.array(codes(x, many, depth).ravel()), batch.column(2).take(take), *map(pa.array, sketch.T)]
                yield pa.RecordBatch.from_arrays(columns, ["l", "d", "t", "code", "cid", "s0", "s1"])

    kind = dict(classes.dtypes)["l"]
    placed = classes.select("v", "l", "cid").mapInArrow(place, f"l {kind}, d int, t int, code long, cid long, s0 long, s1 long")
    # buckets by a hash: if two are one by chance, sketches and then vectors and labels tell their members apart
    placed = tables.write(placed.select(F.xxhash64("l", "d", "t", "code").alias("bucket"), "cid", "s0", "s1"), "placed")
    sizes = tables.write(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = _cells(placed.join(sizes, "bucket"), "bucket", SKETCHES)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _by_cell(batches):
            side, cid, s0, s1 = (run.column(c).to_numpy() for c in ("side", "cid", "s0", "s1"))
            if not _meets(run, side):
                continue
            least = close(np.stack([s0, s1], 1).view("u8"), cid, side)
            some = np.flatnonzero(least != cid)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(least[some])], ["cid", "to"])

    edges = met.select("bucket", "i", "j", "side", "cid", "s0", "s1").mapInArrow(compare, "cid long, to long").distinct()
    edges = tables.write(edges, "edges")
    tables.drop(placed, sizes)
    grouped = components(edges, "cid", "to", tables).toDF("cid", "grp")
    sizes = tables.write(grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "groups")
    members = grouped.join(sizes, "grp").join(classes, "cid").select("grp", "cid", "l", "v", "size", "n")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _by_cell(batches):
            side, cid, size = (run.column(c).to_numpy() for c in ("side", "cid", "size"))
            if not _meets(run, side):
                continue
            vs = [np.asarray(v) for v in run.column("v").to_pylist()]
            kinds: dict[tuple, list[int]] = {}
            for i, (v, l) in enumerate(zip(vs, run.column("l").to_pylist())):
                kinds.setdefault((len(v), l), []).append(i)
            for at in map(np.array, kinds.values()):
                if not _meets(run, side[at]):
                    continue
                x, _ = unit_rows(np.stack([vs[i] for i in at]))
                links, least = linked(cid[at], size[at], x, side[at], cosine)
                some = np.flatnonzero(links > 0)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(cid[at][some]), pa.array(links[some]), pa.array(least[some])], ["cid", "links", "to"])

    cells = _cells(members, "grp", block).select("grp", "i", "j", "side", "cid", "l", "v", "size")
    found = tables.write(cells.mapInArrow(verify, "cid long, links long, to long"), "found")
    counted = found.groupBy(F.col("cid").alias("of")).agg(F.sum("links").alias("links"))
    named = components(found, "cid", "to", tables)
    joined = classes.join(named, classes["cid"] == named["node"], "left").join(counted, classes["cid"] == counted["of"], "left")
    joined = tables.write(joined.select("l", "v", "rep", F.coalesce("component", "cid").alias("grp"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links")), "joined")
    smallest = joined.groupBy(F.col("grp").alias("of")).agg(F.min("rep").alias("component"))
    of = joined.join(smallest, joined["grp"] == smallest["of"]).select(F.col("l").alias("cl"), F.col("v").alias("cv"), "links", "component")
    of = tables.write(of, "classes")
    tables.sweep(of)
    out = rows.join(of, takes & (F.col("l") == F.col("cl")) & (F.col("v") == F.col("cv")), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
