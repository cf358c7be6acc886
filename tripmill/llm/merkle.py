"""Merkle manifest of a dataset: a tree of digests for each source, and one over the sources.

The leaves of a source, in the order of their ids, and later the subroots, are
numbered after sorting all rows by range, so a source of any size is spread. A node's
parent has the key (tree, level, index), and from a tree's size follows how many
children it waits for.

Digests are combined by that key, driven by the events of their arrival. A task
keeps a partial parent for each key it has seen a child of; the child that completes
it makes its digest, which is at once an event for the parent's parent, and the run of
children leaves the task. What is unfinished when a task's rows end is the frontier:
it is shuffled by the node ``STRIDE`` levels above into the next round, where the same
is done. A tree of 10^10 leaves has nine levels and so three rounds after the first,
of a few rows from each task.

Proofs come from the reverse links, from the roots down: a run of children is joined
to the run its node is in, and so has the path of runs above it. A run is one row with
the ids of its leaves, so the widest of these joins has a sixteenth of the documents
as rows, and no key has more than sixteen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripmill.llm.common import Tables, small_batches

#: Children of a node, as a power of two.
BITS = 4
ARITY = 1 << BITS
#: Levels that a round of combining finishes.
STRIDE = 3
#: Rows in an output batch.
OUT_ROWS = 256
#: Hex digits of a digest.
WIDTH = 64
_PATH = "array<struct<place:int,run:string>>"


def digest_of(*columns: Column) -> Column:
    """The digest of a row: each value after its length in bytes and a colon, or ``-`` for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


def _numbered(tables: Tables, rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with ``place`` in their tree, from 0 on, and ``size`` of the tree.

    ``uid`` parts rows that are equal otherwise, so repeated rows are spread too.
    Only counts of (task, tree) are shuffled besides the rows, which are read twice,
    once for the ranges.
    """
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, "tree", *order, "uid").sortWithinPartitions("tree", *order, "uid")
    ranged = tables.write(ranged.drop("uid").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle-sorted")
    counted = ranged.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("begin"))
    tree = Window.partitionBy("tree")  # has a row for each task at most
    before = F.sum("here").over(tree.orderBy("part")) - F.col("here")
    starts = counted.select(F.col("tree").alias("of"), F.col("part").alias("of_part"), (before - F.col("begin")).alias("shift"), F.sum("here").over(tree).alias("size"))
    joined = ranged.join(starts, (F.col("part") == F.col("of_part")) & F.col("tree").eqNullSafe(F.col("of")))
    return joined.select("id", "tree", "digest", "changed", (F.col("at") + F.col("shift")).alias("place"), "size")


def _combine(batches: Iterator[pa.RecordBatch], names: list[str], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Children in; finished runs of children and, last, the frontier out."""
    partial: dict[tuple, dict[int, tuple]] = {}
    out: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    for batch in batches:
        for tree, size, level, index, digest, name, changed in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
            if size == 1:
                out.append((tree, size, -1, 0, None, None, None, digest, [name], [changed]))
                continue
            while (nodes := -(-size >> BITS * level)) > 1:  # nodes of this level, rounded up
                key = (tree, size, level, index >> BITS)
                children = partial.setdefault(key, {})
                children[index & ARITY - 1] = (digest, name, changed)
                if len(children) < min(ARITY, nodes - (key[3] << BITS)):
                    break
                of = [x for _, x in sorted(partial.pop(key).items())]
                run = "".join(x[0] for x in of)
                out.append((tree, size, level, key[3], None, None, None, run, [x[1] for x in of], [x[2] for x in of]))
                # the event for the node above
                digest, name, changed = hashlib.sha256(run.encode()).hexdigest(), None, None
                level, index = level + 1, key[3]
            if len(out) >= OUT_ROWS:
                yield batch_of(out)
                out.clear()
    for (tree, size, level, above), children in partial.items():
        for place, (digest, name, changed) in children.items():
            out.append((tree, size, level, above << BITS | place, digest, name, changed, None, None, None))
            if len(out) >= OUT_ROWS:
                yield batch_of(out)
                out.clear()
    if out:
        yield batch_of(out)


def _runs(tables: Tables, numbered: DataFrame) -> DataFrame:
    """The finished runs of all trees: tree, size, level of the children, index of their node, run, ids, changes.

    A tree of one leaf has that leaf as a run of level -1.
    """
    kind = dict(numbered.dtypes)["id"]
    names = ["tree", "size", "level", "index", "digest", "id", "changed"]
    schema = f"tree string, size long, level int, index long, digest string, id {kind}, changed string, run string, ids array<{kind}>, changes array<string>"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _combine(batches, names, kinds)

    children = numbered.select("tree", "size", F.lit(0).alias("level"), F.col("place").alias("index"), "digest", "id", "changed")
    found, rounds = [], 0
    while True:
        made = tables.write(children.mapInArrow(combine, schema), f"merkle-round{rounds}")
        found.append(made.where("run is not null"))
        frontier = made.where("run is null")
        if frontier.isEmpty():
            break
        rounds += 1
        first_leaf = F.expr(f"shiftleft(index, {BITS} * level)")
        children = frontier.select(*names).repartition("tree", F.shiftright(first_leaf, BITS * STRIDE * rounds))
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionByName(more)
    return runs.select("tree", "size", "level", "index", "run", "ids", "changes")


def _is_top() -> Column:
    """Whether a run is that of its tree's root (or a lone leaf)."""
    return (F.col("level") < 0) | (F.col("index") == 0) & (F.col("size") <= F.expr(f"shiftleft(1L, {BITS} * (level + 1))"))


def _node() -> Column:
    """The digest of a run's node."""
    return F.when(F.col("level") < 0, F.col("run")).otherwise(F.sha2("run", 256))


def _leaves(runs: DataFrame, tops: DataFrame) -> DataFrame:
    """id, tree, leaf, changed, path and root of every leaf; tops: tree, above and root of each tree."""
    deepest = runs.agg(F.max("level")).first()[0]
    tops = tops.withColumnRenamed("tree", "of")
    own = ["tree", "level", "index", "run", "ids", "changes"]
    begun = runs.where(_is_top()).join(tops, F.col("tree").eqNullSafe(F.col("of"))).select(*own, _node().alias("subroot"), "above", "root")
    lone = begun.where("level = -1")
    upper = None
    for level in range(deepest if deepest is not None else -1, -1, -1):
        now = begun.where(F.col("level") == level)
        if upper is not None:
            p = upper.select(F.col("tree").alias("p_tree"), F.col("index").alias("p_index"), F.col("run").alias("p_run"), "subroot", "above", "root")
            rest = runs.where((F.col("level") == level) & ~_is_top())
            linked = rest.join(p, F.col("tree").eqNullSafe(F.col("p_tree")) & (F.shiftright("index", BITS) == F.col("p_index")))
            step = F.array(F.struct((F.col("index") % ARITY).cast("int").alias("place"), F.col("p_run").alias("run")))
            now = now.unionByName(linked.select(*own, "subroot", F.concat(step, "above").alias("above"), "root"))
        upper = now
    rows = lone if upper is None else upper.unionByName(lone)
    each = rows.select("tree", "level", "run", "above", "subroot", "root", F.posexplode(F.arrays_zip("ids", "changes")).alias("place", "x"))
    own_step = F.array(F.struct(F.col("place").alias("place"), F.col("run").alias("run"))).cast(_PATH)
    path = F.when(F.col("level") < 0, F.col("above")).otherwise(F.concat(own_step, "above"))
    leaf = F.substr("run", F.col("place") * WIDTH + 1, F.lit(WIDTH))
    return each.select(F.col("x.ids").alias("id"), "tree", leaf.alias("leaf"), F.col("x.changes").alias("changed"), path.alias("path"), "subroot", "root")


def manifest(docs: DataFrame, leaf: Column, key: str = "doc_id", group: str = "source", changed: Column | None = None, tables: Tables | None = None) -> DataFrame:
    """The manifest of docs, a row for each: key, leaf, subroot, root, path and changed.

    leaf: the digest of a row (``digest_of``). path: from the leaf to the root, the
    place of its node among the digests of a run, and those digests joined (``proof``,
    ``fold``). changed: what a row's digest is found to be later, null if that is not
    asked for. Leaves ascend by key within a group, nulls first; rows of equal key by
    leaf, so equal rows are interchangeable; a null group is a group, before all others.
    An empty table has no rows. Other columns are not carried.
    """
    small_batches(docs.sparkSession)
    tables = tables or Tables(docs.sparkSession)
    changed = F.lit(None).cast("string") if changed is None else changed
    leaves = docs.select(docs[key].alias("id"), docs[group].cast("string").alias("tree"), leaf.alias("digest"), changed.alias("changed"))
    leaves = tables.write(leaves, "merkle-leaves")  # texts are read once
    runs = _runs(tables, _numbered(tables, leaves, ["id", "digest"]))
    subroots = runs.where(_is_top()).select(F.col("tree").alias("id"), F.lit("").alias("tree"), _node().alias("digest"), F.lit(None).cast("string").alias("changed"))
    top_runs = _runs(tables, _numbered(tables, subroots, ["id"]))
    root = top_runs.where(_is_top()).select("tree", F.array().cast(_PATH).alias("above"), _node().alias("root"))
    tops = _leaves(top_runs, root).select(F.col("id").alias("tree"), F.col("path").alias("above"), "root")
    return _leaves(runs, tops).select(F.col("id").alias(key), "leaf", "subroot", "root", "path", "changed")


def _sides(step: Column) -> tuple[Column, Column]:
    """The digests of a run before and after one's own."""
    end = step["place"] * WIDTH
    return F.substr(step["run"], F.lit(1), end), F.substr(step["run"], end + WIDTH + 1)


def proof(path: Column) -> Column:
    """The siblings' digests from the leaf's run to the root's, joined."""
    return F.array_join(F.transform(path, lambda x: F.concat(*_sides(x))), "")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf's digest and the siblings of a path give."""

    def up(below: Column, step: Column) -> Column:
        left, right = _sides(step)
        return F.sha2(F.concat(left, below, right), 256)

    return F.aggregate(path, leaf, up)
