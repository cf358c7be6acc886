"""Near copies by similarity: SimHash with Golay keys first, prefix filtering for what it can't see.

Two documents are near copies if their sets of five-word shingles have a Jaccard
similarity of ``SIMILARITY`` or more.

1. Equal texts (128 bits of their words) are one class from the start.
2. The SimHash operator links classes whose fingerprints differ in two bits or
   fewer. Its links are verified on the shingle sets; what holds is one group.
   That settles nearly all copies with small changes. At similarity 0.8 some ten
   of 64 bits differ, so no fingerprint search of bounded cost finds all links.
3. Prefix filtering finds the others, completely. With all shingles in one order,
   the same for every document, two sets of sizes m and n with that similarity
   share a shingle among the first m - 0.8 m + 1 of one and n - 0.8 n + 1 of the
   other. So a document stands under each shingle of its prefix, and any near
   copy of it stands under one of them.

Any order is right. Shingles go by their hash, but those that are in the prefixes
of over ``HOT`` documents go last (counted over all documents), so what very many
documents share brings nobody together. Keys are counted alone before anything
wider is shuffled; only keys that different groups share have members.

Documents of a key first meet its lead alone, the one with the fewest shingles
before the key's. Then all pairs of a key that are still in different groups meet:
its documents outside the key's largest group with all of the key. Pairs of one
group need no comparison. A pair becomes a row only if its folded bitmaps (below)
leave it open that the two are near copies.

A pair is first judged by bitmaps. A set's bitmap has the parity of its elements
in each of its bits, so two bitmaps differ in no more bits than the sets differ
in elements: what has too many differing bits can't be similar enough. No near
copy is lost by that, and few others are left for the comparison of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import simhash
from tripmill.llm.common import Tables, free_names, small_batches, tidy
from tripmill.llm.components import components

WORDS, SIMILARITY = 5, 0.8
#: Documents of a key above which its shingle goes last.
HOT = 64
#: Hot shingles that are sent to all executors (8 bytes each); more are joined.
BROADCAST = 1_000_000
#: Documents outside a key's largest group above which they meet leads before they are compared with all.
BUCKET = 64
#: Times that they do so at most, while leads still merge groups.
ROUNDS = 4
#: Bits of a bitmap: the next power of two from the size of its set, this at least.
LEAST_BITS = 512


def _text_hash(parts: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(parts))


def bitmap(shingles: np.ndarray) -> bytes:
    """The parity of the elements in each bit, little endian."""
    width = max(LEAST_BITS, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else LEAST_BITS
    odd = np.bincount(shingles & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype("u1"), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ; the wider one is folded to the other's width."""
    if len(a) < len(b):
        a, b = b, a
    x, n = int.from_bytes(a, "little"), len(a)
    while n > len(b):
        n //= 2
        x = (x >> 8 * n) ^ (x & ((1 << 8 * n) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def folded(bits: bytes) -> list[int]:
    """A bitmap folded to LEAST_BITS, as signed 64-bit words."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, "<i8").reshape(-1, LEAST_BITS // 64), axis=0).tolist()


def needed(m: int, n: int) -> int:
    """The least intersection of sets of sizes m and n with SIMILARITY."""
    return int(np.ceil(SIMILARITY / (1 + SIMILARITY) * (m + n) - 1e-9))


def _prints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, h, fp, size, bits, w of each row: hash of the words, fingerprint, number of shingles, bitmap, and that folded."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, fp, size, bits = [], [], [], []
            for t in batch.column(1).to_pylist():
                parts = simhash.words_of(t)
                hashes = simhash.shingle_hashes(parts, WORDS)
                found = np.unique(hashes.view("i8"))
                h.append(_text_hash(parts))
                fp.append(simhash.majority(hashes))
                size.append(len(found))
                bits.append(bitmap(found))
            columns = [batch.column(0), pa.array(h, pa.binary()), pa.array(np.array(fp, "u8").view("i8")), pa.array(size, pa.int32()), pa.array(bits, pa.binary()), pa.array(map(folded, bits), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "h", "fp", "size", "bits", "w"])

    return docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"id {dict(docs.dtypes)[key]}, h binary, fp long, size int, bits binary, w array<long>")


def _own(named: DataFrame) -> DataFrame:
    """cid, text of the rows of cid, h, text whose text is the one of h: keys may repeat, so rows can meet classes of other texts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [i for i, (t, h) in enumerate(zip(batch.column(2).to_pylist(), batch.column(1).to_pylist())) if _text_hash(simhash.words_of(t)) == h]
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(2)], ["cid", "text"])

    return named.select("cid", "h", "text").mapInArrow(run, "cid long, text string")


def _shingles(text: str | None) -> np.ndarray:
    """The set of a text's shingle hashes, ascending."""
    return np.unique(simhash.shingle_hashes(simhash.words_of(text), WORDS).view("i8"))


def prefix(shingles: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The part of a set of which any set with at least SIMILARITY has an element in its own part. hot: ascending."""
    n = len(shingles)
    if not n:
        return shingles
    ordered = shingles
    if len(hot):
        last = hot[np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)] == shingles
        ordered = np.concatenate([shingles[~last], shingles[last]])
    return ordered[: n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1]


def _emit(texts: DataFrame, pick, hot: np.ndarray | None = None) -> DataFrame:
    """key, cid, size, pos: every text under each of the shingles that ``pick`` takes from its set.

    texts: cid, text and, where ``hot`` is not given to all, hot: the text's own.
    """
    shared = texts.sparkSession.sparkContext.broadcast(hot) if hot is not None else None

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(t) for t in batch.column(1).to_pylist()]
            last = [shared.value] * len(sets) if shared else [np.array(sorted(x or []), "i8") for x in batch.column(2).to_pylist()]
            taken = [pick(s, x) for s, x in zip(sets, last)]
            n = np.array([len(p) for p in taken], "i8")
            cid = batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n)))
            pos = np.concatenate([np.arange(k, dtype="i4") for k in n]) if len(n) else np.zeros(0, "i4")
            size = np.repeat(np.array([len(s) for s in sets], "i4"), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(taken) if taken else np.zeros(0, "i8")), cid, pa.array(size), pa.array(pos)], ["key", "cid", "size", "pos"])

    columns = ["cid", "text"] if shared else ["cid", "text", "hot"]
    return texts.select(*columns).mapInArrow(run, "key long, cid long, size int, pos int")


def _possible(m: Column, i: Column, n: Column, j: Column) -> Column:
    """Whether sets of sizes m and n can have SIMILARITY if the first element they share is at i and j."""
    return (1 + F.least(m - i - 1, n - j - 1)) * (1 + SIMILARITY) >= SIMILARITY * (m + n) - 1e-6


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _no_pairs(spark: SparkSession, a: str, b: str) -> DataFrame:
    """Two columns without rows; an empty list in Python would be read by Python workers of its own, which stay in the executors."""
    return spark.range(0).select(F.col("id").alias(a), F.col("id").alias(b))


def _lead_pairs(members: DataFrame) -> DataFrame:
    """Pairs of the members of a key with its first one, where that is in another group."""
    leads = members.groupBy(F.col("key").alias("of")).agg(F.min(F.struct("pos", "cid", "size", "grp")).alias("l"))
    met = members.join(leads, (members["key"] == leads["of"]) & (members["grp"] != F.col("l.grp")) & _possible(F.col("size"), F.col("pos"), F.col("l.size"), F.col("l.pos")))
    return met.select(*_pair("cid", "l.cid")).distinct()


def _close(m: Column, w: Column, n: Column, v: Column) -> Column:
    """Whether folded bitmaps leave it open that sets of sizes m and n have SIMILARITY."""
    bits = sum((F.bit_count(w[i].bitwiseXOR(v[i])) for i in range(1, LEAST_BITS // 64)), F.bit_count(w[0].bitwiseXOR(v[0])))
    return bits <= m + n - 2 * F.ceil(SIMILARITY / (1 + SIMILARITY) * (m + n) - 1e-9)


def _all_pairs(others: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of different groups: one of others, one of all members of the same key.

    Both have their folded bitmap with them (w), so pairs that can't be similar
    enough end where they meet and are no rows.
    """
    x, y = others.alias("x"), members.alias("y")
    can = _possible(F.col("x.size"), F.col("x.pos"), F.col("y.size"), F.col("y.pos")) & _close(F.col("x.size"), F.col("x.w"), F.col("y.size"), F.col("y.w"))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.grp") != F.col("y.grp")) & can)
    return met.select(*_pair("x.cid", "y.cid")).distinct()


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that sizes and bitmaps leave."""
    a, b = (classes.select(F.col("cid").alias(c), F.col("size").alias(f"n{c}"), F.col("bits").alias(f"bits{c}")) for c in "ab")
    
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            at = [i for i, (m, n, x, y) in enumerate(rows) if differing(x, y) <= m + n - 2 * needed(m, n)]
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1)], ["a", "b"])

    sized = pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= SIMILARITY * F.greatest("na", "nb") - 1e-9)
    return sized.select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame) -> DataFrame:
    """cid, s: the shingle hashes of texts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_shingles(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))], ["cid", "s"])

    return texts.select("cid", "text").mapInArrow(run, "cid long, s array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose shingle sets have at least SIMILARITY."""
    a, b = (sets.select(F.col("cid").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(a, "a").join(b, "b")
    return joined.where(both >= SIMILARITY * (F.size("sa") + F.size("sb") - both) - 1e-9).select("a", "b")


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", tables: Tables | None = None) -> DataFrame:
    """key, h, group, component_id of every row: a number of the row's group, and the group's smallest key.

    Classes of equal texts have numbers of their own, so rows of one key and
    other texts are apart unless their texts are near copies. Texts without words
    are copies of each other. A null key is no candidate for component_id; a text
    that has null keys alone is compared with no other and has null. Texts are
    compared whole, whatever their length.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tables = tables or Tables(spark)
    prints = tables.write(_prints(docs, key, text), "prints")
    one = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "fp", "size", "bits", "w"))).alias("one")
    classes = prints.groupBy("h").agg(one).select("h", F.col("one.id").alias("rep"), "one.fp", "one.size", "one.bits", "one.w")
    classes = tables.write(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    known = classes.where(F.col("rep").isNotNull())
    rows = docs.select(F.col(f"`{key}`").alias("rep"), F.col(f"`{text}`").alias("text"))
    texts = tables.write(_own(rows.join(known.select("rep", "h", "cid"), "rep")), "texts")
    tables.let_go()
    named = None

    def grouped(df: DataFrame) -> DataFrame:
        """df with the group that each class is in so far."""
        if named is None:
            return df.withColumn("grp", F.col("cid"))
        own = named.select(F.col("node").alias("__node"), F.col("component").alias("__of"))
        return df.join(own, df["cid"] == own["__node"], "left").withColumn("grp", F.coalesce("__of", "cid")).drop("__node", "__of")

    def merge(pairs: DataFrame) -> bool:
        """Join the groups of the pairs that are near copies."""
        nonlocal named
        alike = tables.write(_alike(pairs, known), "alike")
        if alike.isEmpty():
            return False
        ends = alike.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        sets = tables.write(_sets(texts.join(ends, "cid", "left_semi")), "sets")
        found = _verified(alike, sets).withColumnRenamed("a", "cid")
        found = grouped(grouped(found).select(F.col("grp").alias("a"), F.col("b").alias("cid"))).select("a", F.col("grp").alias("b"))
        found = tables.write(found.where("a <> b").distinct(), "links")
        tables.drop(sets, alike)
        tables.let_go()
        if found.isEmpty():
            return False
        joined = components(found, tables=tables)
        if named is not None:
            more = joined.join(named, "node", "left_anti")
            to = joined.select(F.col("node").alias("old"), F.col("component").alias("new"))
            joined = named.join(to, named["component"] == to["old"], "left").select("node", F.coalesce("new", "component").alias("component")).unionByName(more)
        named = tables.write(joined, "named")
        tables.drop(found)
        return True

    # what the fingerprints link
    by_print = tables.write(known.groupBy("fp").agg(F.min("cid").alias("rep")), "fingerprints")
    equal = known.join(by_print.select("fp", F.col("rep").alias("first")), "fp").where("cid <> first").select(F.col("first").alias("a"), F.col("cid").alias("b"))
    merge(tables.write(simhash.links(by_print, tables).select(*_pair("a", "b")).unionByName(equal).distinct(), "pairs"))

    # what else shares the first shingles
    none = np.zeros(0, "i8")

    def keys(hot, own: DataFrame | None = None) -> DataFrame:
        if own is None:
            return _emit(texts, prefix, hot)
        return _emit(texts.join(own, texts["cid"] == own["of"], "left").select("cid", "text", "hot"), prefix)

    counted = lambda df: grouped(df.select("key", "cid")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi").select("key", "n")
    shared = tables.write(counted(keys(none)), "counts")
    tables.let_go()
    hot, own = tables.write(shared.where(F.col("n") > HOT).select("key"), "hot"), None
    many = hot.count()
    if 0 < many <= BROADCAST:
        last = np.sort(hot.toPandas()["key"].to_numpy("i8"))
    elif many:
        every = _emit(texts, lambda s, x: s, none).select("key", "cid")
        own = tables.write(every.join(hot, "key").groupBy(F.col("cid").alias("of")).agg(F.collect_list("key").alias("hot")), "hot_of")
        last = None
    if many:
        tables.drop(shared)
        shared = tables.write(counted(keys(last, own)), "counts")
        tables.let_go()
    else:
        last = none
    members = tables.write(keys(last, own).join(shared.select("key"), "key", "left_semi"), "members")
    tables.let_go()
    tested = _no_pairs(spark, "a", "b")
    for turn in range(ROUNDS + 1):
        in_groups = tables.write(grouped(members), "placed")
        per_group = in_groups.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("n"))
        largest = per_group.groupBy("key").agg(F.max(F.struct("n", "grp")).alias("m"), F.sum("n").alias("all")).where("m.n < all")
        largest = tables.write(largest.select("key", F.col("m.grp").alias("base"), (F.col("all") - F.col("m.n")).alias("rest")), "largest")
        placed = tables.write(in_groups.join(largest, "key"), "placed")
        tables.drop(in_groups)
        others = placed.where("grp <> base")
        more = False
        if turn < ROUNDS:
            chosen = placed if not turn else others.where(F.col("rest") > BUCKET)
            pairs = tables.write(_lead_pairs(chosen).join(tested, ["a", "b"], "left_anti"), "pairs")
            more = merge(pairs)
            tested = tested.unionByName(pairs)
        if not more:  # all that is still apart
            whole = tables.write(placed.join(known.select("cid", "w"), "cid"), "whole")
            merge(tables.write(_all_pairs(whole.where("grp <> base"), whole).join(tested, ["a", "b"], "left_anti"), "pairs"))
            break
        tables.drop(placed, largest)
    if named is None:
        named = _no_pairs(spark, "node", "component")
    placed = classes.join(named, classes["cid"] == named["node"], "left").select("h", "rep", F.coalesce("component", "cid").alias("group"))
    smallest = placed.groupBy(F.col("group").alias("of")).agg(F.min("rep").alias("component_id"))
    of = placed.join(smallest, placed["group"] == smallest["of"]).select(F.col("h").alias("class"), "group", "component_id")
    of = tables.write(of, "classes")
    tables.sweep(prints, of)
    return prints.join(of, prints["h"] == of["class"]).select(F.col("id").alias(key), "h", "group", "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", tables: Tables | None = None) -> DataFrame:
    """docs with one row of each group: that with the smallest key, all columns as they are.

    Of rows of one key in a group one text stays, and of rows equal in key and
    text one row; rows of one key in other groups are no copies and stay. A text
    that has null keys alone keeps one row. Any name is free for further columns.
    """
    tables = tables or Tables(docs.sparkSession)
    found = tables.write(groups(docs, text, key, tables).toDF("key", "h", "group", "component_id"), "groups")
    first = found.where(F.col("key").eqNullSafe(F.col("component_id"))).groupBy("group").agg(F.min(F.struct("key", "h")).alias("first"))
    keeps = tables.write(first.select("first.key", "first.h"), "keeps")
    unique = keeps.where(F.col("key").isNull()).isEmpty() and found.groupBy("key").count().where("count > 1").isEmpty()
    tables.sweep(keeps)
    own, own_h, kept_key, kept_h = free_names(docs.columns, "key", "h", "kept_key", "kept_h")
    keeps = keeps.select(F.col("key").alias(kept_key), F.col("h").alias(kept_h))
    if unique:
        return docs.join(keeps, docs[key] == keeps[kept_key], "left_semi")

    @tidy
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            h = pa.array([_text_hash(simhash.words_of(t)) for t in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, h], [*batch.schema.names, own_h])

    types = dict(docs.dtypes)
    hashed = docs.mapInArrow(hashes, ", ".join(f"`{c}` {types[c]}" for c in docs.columns) + f", `{own_h}` binary")
    both = F.col(f"`{key}`").eqNullSafe(F.col(kept_key)) & (F.col(own_h) == F.col(kept_h))
    return hashed.join(keeps, both, "left_semi").dropDuplicates([key, own_h]).drop(own_h)
