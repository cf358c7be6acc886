"""Exact substring de-duplication with suffix arrays and longest-previous-factor arrays.

A byte is a duplicate if a string of ``length`` bytes that covers it also
starts somewhere else. Nobody can sort all suffixes of a corpus in one place,
so the suffixes are first dealt out such that equal strings of ``length`` bytes
meet:

* Every such string has a minimizer, the k-gram in it with the least hash.
  Equal strings have equal minimizers, and neighbouring strings mostly share
  theirs, so a document has about one *anchor* for each (length - k) / 2 bytes.
  Strings whose minimizer occurs once are unique; most text ends here, and
  anchors are counted before they are shuffled.
* The *context* of an anchor holds all strings that contain it. Contexts that
  are equal as a whole (by 128 bits of two independent hashes) are copies; one
  of each kind, the first, stands for them.
* The different contexts of one minimizer meet in a task, many minimizers at a
  time in a buffer of bounded size, in the order of the corpus. There the
  suffix array is built as far as ``length`` bytes (prefix doubling), with the
  array of common prefixes. For each suffix, the previous and the next one in
  suffix order that start at a smaller position give its longest previous
  factor; from ``length`` on, it is a later copy. The same with larger positions
  gives the longest next factor, which tells first copies from strings that
  occur once.
* A minimizer with very many different contexts (the edges of a passage that
  very many documents share) is not brought together. Its strings are anchored
  anew with longer k-grams, at last of ``length`` bytes, where all contexts of
  an anchor are equal and a count is enough.

Texts are shuffled to where their anchors and their spans are, never to one
task; candidate anchors, variants and spans are tables in the shared folder.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.llm.common import Tables, small_batches, tidy

#: Bytes of the strings that count, k-grams of the first and of later rounds.
LENGTH = 200
FIRST_K, NEXT_K = 32, 180
#: Different contexts of one minimizer that meet in a task.
VARIANTS = 2000
#: Bytes whose suffixes are sorted together (a minimizer's contexts may exceed it by their own size).
BUFFER = 1 << 18
#: Bytes of text that are anchored at a time; longer texts are cut with overlap.
SEGMENT = 1 << 18

#: Two independent hashes of byte strings: multipliers, and a number for each byte.
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BYTES = [np.random.default_rng(seed).integers(0, 1 << 63, 256).astype("u8") * np.uint64(2) + np.uint64(1) for seed in (200, 201)]
_POWERS = [np.ones(0, "u8")] * 4


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """A multiplier's powers modulo 2^64 and their inverses."""
    if len(_POWERS[2 * which]) < n:
        for i, m in enumerate((_MULTIPLIERS[which], pow(_MULTIPLIERS[which], -1, 1 << 64))):
            steps = np.full(n, m, "u8")
            steps[0] = 1
            _POWERS[2 * which + i] = np.cumprod(steps)
    return _POWERS[2 * which][:n], _POWERS[2 * which + 1][:n]


def _sums(data: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash sums of all beginnings of data, and what a difference of two is multiplied by, by its first place."""
    up, down = _powers(len(data) + 1, which)
    sums = np.zeros(len(data) + 1, "u8")
    np.cumsum(_BYTES[which][data] * up[:-1], out=sums[1:])
    return sums, down


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sliding(x: np.ndarray, w: int, pick, fill: int) -> np.ndarray:
    """Minimum or maximum of each w neighbours, by runs from both ends of blocks."""
    if w == 1:
        return x.copy()
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, fill, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    left = pick.accumulate(blocks, axis=1).ravel()
    right = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(right[:n], left[w - 1 : w - 1 + n])


def _thin(at: np.ndarray, h: np.ndarray, segment: np.ndarray, w: int) -> np.ndarray:
    """Which anchors to keep: not those between two of the same hash that no string can miss both of."""
    kept = np.ones(len(at), bool)
    near = (h[1:-1] == h[:-2]) & (h[1:-1] == h[2:]) & (segment[:-2] == segment[2:]) & (at[2:] - at[:-2] <= w)
    last = -1
    for i in np.flatnonzero(near) + 1:  # runs of one hash only
        before = last if last >= 0 and not kept[last + 1 : i].any() else i - 1
        if at[i + 1] - at[before] <= w:
            kept[i] = False
            last = before
        else:
            last = -1
    return kept


def anchors_of(data: np.ndarray, ends: np.ndarray, k: int, length: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Anchors of segments that lie one after another in data; ends: where each ends.

    wanted: which strings (by start) need an anchor, all by default. Returns
    position, segment, hash, two hashes of the context, bytes of the context
    before the anchor, its bytes in all.
    """
    none = tuple(np.zeros(0, t) for t in ("i8", "i8", "u8", "u8", "u8", "i8", "i8"))
    n, w = len(data), length - k + 1
    if n < length:
        return none
    sums, down = _sums(data, 0)
    h = _mix((sums[k:] - sums[:-k]) * down[: n - k + 1])
    h |= np.uint64(1)  # 0 stands for no string
    least = _sliding(h, w, np.minimum, np.iinfo("u8").max)
    starts = np.concatenate([[0], ends[:-1]])
    out = np.zeros(n + 1, "i4")  # strings that would cross a segment's end
    np.add.at(out, np.maximum(ends - length + 1, starts), 1)
    np.add.at(out, ends, -1)
    count = n - length + 1
    least[np.cumsum(out)[:count] > 0] = 0
    if wanted is not None:
        least[~wanted[:count]] = 0
    padded = np.zeros(len(h) + w - 1, "u8")
    padded[w - 1 : w - 1 + count] = least
    at = np.flatnonzero(_sliding(padded, w, np.maximum, 0) == h)
    if not len(at):
        return none
    segment = np.searchsorted(ends, at, "right")
    kept = _thin(at, h[at], segment, w)
    at, segment = at[kept], segment[kept]
    first = np.maximum(starts[segment], at - (length - k))
    last = np.minimum(ends[segment], at + length)
    place = ((at - first) << 12 | (last - first)).astype("u8")
    context = _mix((sums[last] - sums[first]) * down[first] + place)
    sums, down = _sums(data, 1)
    return at, segment, h[at], context, _mix((sums[last] - sums[first]) * down[first] + place), at - first, last - first


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one big-endian number."""
    padded = np.concatenate([data, np.zeros(8, "u1")])
    value = np.zeros(len(data), "u8")
    for i in range(8):
        value = value << np.uint64(8) | padded[i : i + len(data)]
    return value


def suffix_array(data: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Places of at least ``length`` bytes to their segment's end, by their first ``length`` bytes, equal ones by place.

    Prefix doubling: ranks by 8 bytes, then by twice as many, and last by two
    overlapping parts. A rank is the place in the array where the suffixes that
    share it begin; only those that share theirs are sorted again.
    """
    n = len(data)
    room = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(n)
    size = min(8, length)
    key = _words(data) >> np.uint64(64 - 8 * size)
    array = np.flatnonzero(room >= size)
    rank = np.full(n, -1, "i8")
    array = array[np.argsort(key[array])]
    place = np.arange(len(array))  # in the array, of what is sorted again
    at, sorted_ = array, key[array]
    while len(at):
        new = np.ones(len(at), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        rank[at] = place[head][group]
        many = np.diff(np.append(head, len(at)))[group] > 1
        if size == length:
            at, place = at[many], place[many]
            array[place] = at[np.argsort(rank[at] * (n + 1) + at)]
            break
        step = min(size, length - size)
        many &= room[at] >= size + step
        at, place = at[many], place[many]
        sorted_ = rank[at] * (n + 1) + rank[at + step]
        order = np.argsort(sorted_)
        at, sorted_ = at[order], sorted_[order]
        array[place] = at
        size += step
    return array[room[array] >= length]


def common_prefixes(data: np.ndarray, array: np.ndarray, length: int) -> np.ndarray:
    """Bytes, up to ``length``, that each suffix of the array shares with the one before it."""
    value = np.concatenate([_words(data), np.zeros(length, "u8")])
    shared = np.zeros(len(array), "i4")
    active = np.arange(1, len(array))
    for done in range(0, length, 8):
        apart = value[array[active] + done] ^ value[array[active - 1] + done]
        bits = np.full(len(active), 64, "i4")
        some = apart != 0
        left = apart[some]
        zeros = np.zeros(len(left), "i4")
        for step in (32, 16, 8):  # leading zeros, in whole bytes
            small = left < np.uint64(1) << np.uint64(64 - step)
            zeros[small] += step
            left = np.where(small, left << np.uint64(step), left)
        bits[some] = zeros
        shared[active] = done + bits // 8
        active = active[~some]
    return np.minimum(shared, length)


def previous_factors(array: np.ndarray, lcp: np.ndarray, enough: int = 1) -> np.ndarray:
    """For each entry of a suffix array, the longest prefix that a suffix at a smaller place has in common with it.

    That suffix is the previous or the next one in suffix order with a smaller
    place. Each entry's candidate jumps over what its own candidate has jumped
    over, and carries the least common prefix on the way. A factor of fewer than
    ``enough`` bytes is not followed to its end; its value is some number below.
    """
    n = len(array)
    best = np.zeros(n, "i4")
    for place, least in ((array, lcp.copy()), (array[::-1], np.concatenate([[0], lcp[:0:-1]]).astype("i4"))):
        to = np.arange(n) - 1
        least[:1] = 0
        active = np.flatnonzero((least >= enough) & (place[to] > place))
        active = active[to[active] >= 0]
        while len(active):
            over = to[active]
            less, jump = np.minimum(least[active], least[over]), to[over]
            less[jump < 0] = 0
            least[active], to[active] = less, jump
            active = active[(less >= enough) & (place[jump] > place[active])]
        best = np.maximum(best, least if place is array else least[::-1])
    return best


def runs(flags: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last of the runs of true values within segments, and each run's segment."""
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1]
    first[begin] = flags[begin]
    last[:-1] &= ~flags[1:]
    last[ends - 1] = flags[ends - 1]
    at = np.flatnonzero(first)
    return at, np.flatnonzero(last), np.searchsorted(ends, at, "right")


def _segments(text: bytes, length: int) -> list[tuple[int, int]]:
    if len(text) <= SEGMENT:
        return [(0, len(text))]
    step = SEGMENT - length + 1
    return [(a, min(a + SEGMENT, len(text))) for a in range(0, len(text) - length + 1, step)]


def _anchors(docs: DataFrame, k: int, length: int, with_spans: bool) -> DataFrame:
    """h, ctx, ctx2, rid, pos, lead, size: the anchors of all texts (of the strings in ``spans``)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list) -> pa.RecordBatch:
            data = np.frombuffer(b"".join(t[a:b] for _, t, a, b, _ in held), "u1")
            ends = np.cumsum([b - a for _, _, a, b, _ in held])
            wanted = None
            if with_spans:
                wanted = np.zeros(len(data), bool)
                for (_, _, a, b, spans), end in zip(held, ends):
                    base = end - (b - a)
                    for lo, hi in spans:
                        if hi >= a and lo < b:
                            wanted[base + max(lo, a) - a : base + min(hi, b - 1) - a + 1] = True
            at, segment, h, context, context2, lead, size = anchors_of(data, ends, k, length, wanted)
            rid = np.array([x[0] for x in held], "i8")
            base = np.array([x[2] for x in held], "i8") - np.concatenate([[0], ends[:-1]])
            return pa.RecordBatch.from_arrays([pa.array(h.view("i8")), pa.array(context.view("i8")), pa.array(context2.view("i8")), pa.array(rid[segment]), pa.array((at + base[segment]).astype("i4")), pa.array(lead.astype("i4")), pa.array(size.astype("i4"))], ["h", "ctx", "ctx2", "rid", "pos", "lead", "size"])

        for batch in batches:
            held, size = [], 0
            spans = batch.column(2).to_pylist() if with_spans else [None] * batch.num_rows
            for rid, text, span in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), spans):
                if text is None or len(text) < length:
                    continue
                span = [(x["lo"], x["hi"]) for x in span] if with_spans else None
                for a, b in _segments(text, length):
                    held.append((rid, text, a, b, span))
                    size += b - a
                    if size >= SEGMENT:
                        yield flush(held)
                        held, size = [], 0
            if held:
                yield flush(held)

    columns = ["rid", "text", "spans"] if with_spans else ["rid", "text"]
    return docs.select(*columns).mapInArrow(run, "h long, ctx long, ctx2 long, rid long, pos int, lead int, size int")


def _contexts(docs: DataFrame) -> DataFrame:
    """The bytes of the contexts that ``wanted`` names."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rid, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for x in wanted:
                    first = x["pos"] - x["lead"]
                    rows.append((x["h"], x["ctx"], x["ctx2"], x["n"], rid, x["pos"], x["lead"], text[first : first + x["size"]]))
            if rows:
                kinds = [*[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["h", "ctx", "ctx2", "n", "rid", "pos", "lead", "bytes"])

    return docs.select("rid", "text", "wanted").mapInArrow(run, "h long, ctx long, ctx2 long, n long, rid long, pos int, lead int, bytes binary")


def factors(held: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which strings of contexts occur elsewhere, and which elsewhere before; begin and end of the contexts.

    held: (copies, document, place in it, bytes) of each context, by document and
    place. A place can be in two contexts; the first of them stands for it.
    """
    data = np.frombuffer(b"".join(x[3] for x in held), "u1")
    ends = np.cumsum([len(x[3]) for x in held])
    begin = np.concatenate([[0], ends[:-1]])
    stands = np.arange(len(data))
    now, until, shift = None, 0, 0
    for (_, rid, start, text), a in zip(held, begin):
        if rid != now:
            now, until = rid, start
        last = start + len(text) - length + 1  # behind the last string
        if start < until:
            seen = min(until, last) - start
            stands[a : a + seen] = stands[start + shift : start + seen + shift]
        if last > until:
            # from here on, this context stands; places before are in earlier ones
            until, shift = last, a - start
    array = suffix_array(data, ends, length)
    array = array[stands[array] == array]
    lcp = common_prefixes(data, array, length)
    copied = np.zeros(len(data) + 1, "i4")
    some = np.array([x[0] for x in held]) > 1  # the context has copies, so all its strings have
    np.add.at(copied, begin[some], 1)
    np.add.at(copied, np.maximum(begin, ends - length + 1)[some], -1)
    own = np.zeros(len(data), bool)
    own[stands[np.cumsum(copied[:-1]) > 0]] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[array] = previous_factors(array, lcp, length) >= length
    after[array] = previous_factors(-array, lcp, length) >= length
    return (before | after | own)[stands], before[stands], begin, ends


def _sorted_suffixes(contexts: DataFrame, length: int) -> DataFrame:
    """h, ctx, ctx2, dups, later: starts of duplicate strings relative to the anchor, as runs.

    dups holds all strings that occur elsewhere; later those of them that occur
    elsewhere before the context's own first place.
    """

    def solve(held: list[tuple]) -> pa.RecordBatch:
        # text order is the order of documents, so that earlier positions are earlier copies
        held.sort(key=lambda x: (x[4], x[5] - x[6]))
        dup, later, begin, ends = factors([(x[3], x[4], x[5] - x[6], x[7]) for x in held], length)
        lead = np.array([x[6] for x in held])
        lists, some = [], None
        for flags in (dup, later):
            first, last, of = runs(flags, begin, ends)
            if some is None:
                some = np.unique(of)
            shift = (begin + lead)[of]
            values = np.stack([first - shift, last - shift], 1).ravel().astype("i4")
            counts = 2 * np.bincount(of, minlength=len(held))[some]
            lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("i4")), pa.array(values)))
        named = [pa.array([held[i][k] for i in some], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*named, *lists], ["h", "ctx", "ctx2", "dups", "later"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if row[0] != now:
                    if size >= BUFFER:
                        yield solve(held)
                        held, size = [], 0
                    now = row[0]
                held.append(row)
                size += len(row[7])
        if held:
            yield solve(held)

    by_minimizer = contexts.repartition("h").sortWithinPartitions("h")
    return by_minimizer.mapInArrow(run, "h long, ctx long, ctx2 long, dups array<int>, later array<int>")


def _round(docs: DataFrame, k: int, length: int, keep_first: bool, with_spans: bool, variants: int, tables: Tables) -> tuple[DataFrame, DataFrame | None]:
    """Spans of duplicate strings that this k settles, and the strings that need a longer one (rid, spans)."""
    kind = ["h", "ctx", "ctx2"]
    named = lambda df: df.withColumnsRenamed({c: f"{c}_of" for c in kind})
    same = lambda df, other: (df["h"] == other["h_of"]) & (df["ctx"] == other["ctx_of"]) & (df["ctx2"] == other["ctx2_of"])
    anchors = lambda: _anchors(docs, k, length, with_spans)  # noqa: E731  cheaper to make again than to keep
    again = tables.write(anchors().groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h"), "minimizers")
    found = tables.write(anchors().join(again, "h", "left_semi"), "anchors")
    kinds = found.groupBy(*kind).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "pos")).alias("first"), F.first("lead").alias("lead"), F.first("size").alias("size"))
    kinds = tables.write(kinds.select(*kind, "n", "first.rid", "first.pos", "lead", "size"), "kinds")
    many = tables.write(kinds.groupBy(F.col("h").alias("hh")).agg(F.count(F.lit(1)).alias("variants")), "variants")
    counted = tables.write(kinds.join(many, kinds["h"] == many["hh"]).drop("hh"), "kinds")
    tables.drop(again, kinds, many)
    # equal contexts: all their strings are copies of those in the first place
    whole = F.array((-F.col("lead")).cast("int"), (F.col("size") - F.col("lead") - length).cast("int"))
    none = F.array().cast("array<int>")
    settled = counted.where("variants = 1 and n > 1").select(*kind, F.col("rid").alias("first_rid"), F.col("pos").alias("first_pos"), whole.alias("dups"), none.alias("later"))
    meet = counted.where(F.col("variants").between(2, variants))
    wanted = meet.groupBy(F.col("rid").alias("of")).agg(F.collect_list(F.struct(*kind, "n", "pos", "lead", "size")).alias("wanted"))
    contexts = _contexts(docs.join(wanted, docs["rid"] == wanted["of"]))
    sorted_ = named(tables.write(_sorted_suffixes(contexts, length), "suffixes"))
    compared = meet.join(sorted_, same(meet, sorted_)).select(*kind, F.col("rid").alias("first_rid"), F.col("pos").alias("first_pos"), "dups", "later")
    results = named(tables.write(settled.unionByName(compared), "results"))
    placed = found.join(results, same(found, results))
    mine = F.when((F.col("rid") == F.col("first_rid")) & (F.col("pos") == F.col("first_pos")), F.col("later")).otherwise(F.col("dups")) if keep_first else F.col("dups")
    spans = placed.withColumn("mine", mine).where(F.size("mine") > 0)
    pairs = F.transform(F.sequence(F.lit(0), F.size("mine") - 1, F.lit(2)), lambda i: F.struct((F.col("pos") + F.col("mine")[i]).alias("lo"), (F.col("pos") + F.col("mine")[i + 1]).alias("hi")))
    spans = tables.write(spans.groupBy("rid").agg(F.flatten(F.collect_list(pairs)).alias("spans")), "spans")
    hot = tables.write(counted.where(F.col("variants") > variants).select(F.col("h").alias("h_of")).distinct(), "hot")
    if hot.isEmpty():
        return spans, None
    strings = found.join(hot, found["h"] == hot["h_of"], "left_semi")
    strings = strings.select("rid", F.struct((F.col("pos") - F.col("lead")).alias("lo"), (F.col("pos") - F.col("lead") + F.col("size") - length).alias("hi")).alias("s"))
    return spans, tables.write(strings.groupBy("rid").agg(F.collect_list("s").alias("spans")), "rest")


def duplicate_spans(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, variants: int = VARIANTS, tables: Tables | None = None) -> DataFrame:
    """rid, spans: starts (lo..hi) of the strings to remove. docs: rid (long, unique), text (binary)."""
    tables = tables or Tables(docs.sparkSession)
    found, rest = _round(docs, min(FIRST_K, length), length, keep_first, False, variants, tables)
    parts = [found]
    for k in (min(NEXT_K, length), length):
        tables.sweep(*parts, *([rest] if rest is not None else []))
        if rest is None:
            break
        left = docs.join(rest.withColumnRenamed("rid", "of"), F.col("rid") == F.col("of")).select("rid", "text", "spans")
        found, rest = _round(left, k, length, keep_first, True, variants if k < length else 1 << 60, tables)
        parts.append(found)
    every = functools.reduce(DataFrame.unionByName, parts)
    return tables.write(every.groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")


def numbered(docs: DataFrame, key: str, text: str, tables: Tables, row: bool = False) -> DataFrame:
    """rid (long, unique, in the order of the key), key, text as bytes; with ``row`` a struct of all columns but the text.

    rid is the key itself where that is a unique long; else the rows are numbered
    in a table of their own, equal keys in any order, null keys last.
    """
    more = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")] if row else []
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"), *more)
    if dict(docs.dtypes)[key] in ("bigint", "int"):
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count("key").alias("m")).first()
        unique = seen["n"] == seen["m"] and rows.groupBy("key").count().where("count > 1").isEmpty()
        if unique:
            return rows.withColumn("rid", F.col("key").cast("long"))
    return tables.write(rows.orderBy(F.col("key").asc_nulls_last()).withColumn("rid", F.monotonically_increasing_id()), "numbered")


def dedup(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, text: str = "text", key: str = "doc_id", outputs: bool = False, variants: int = VARIANTS, row: bool = False, tables: Tables | None = None) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Texts are UTF-8 bytes, null ones empty; matches never cross rows. All
    copies of a repeated string go, or with ``keep_first`` all but the first
    (by key, then place). With ``outputs`` also kept (the remaining text, what
    is left of a split character dropped) and spans (first byte, end). Rows
    with equal keys are rows of their own, and copies of each other. With
    ``row`` all columns but the text are passed on in a struct of that name, so
    theirs are free.
    """
    small_batches(docs.sparkSession)
    tables = tables or Tables(docs.sparkSession)
    mine = Tables(docs.sparkSession)
    rows = numbered(docs, key, text, tables, row)
    spans = duplicate_spans(rows.select("rid", "text"), length, keep_first, variants, mine)
    mine.sweep(spans)
    tables.paths |= mine.paths
    tables.held += mine.held
    joined = rows.join(spans.withColumnRenamed("rid", "of"), F.col("rid") == F.col("of"), "left")
    more = [("kept", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))] if outputs else []
    schema = f"{key} {dict(docs.dtypes)[key]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept string, spans array<struct<start:int,end:int>>" if outputs else "")
    schema = StructType.fromDDL(schema)
    if row:
        schema = schema.add(rows.schema["row"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                merged: list[list[int]] = []
                for lo, hi in sorted((x["lo"], x["hi"] + length) for x in found or []):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                left, at = [], 0
                for lo, hi in merged:
                    left.append(data[at:lo])
                    at = hi
                left = b"".join([*left, data[at:]])
                out = [len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest()]
                rows.append(out + [left.decode("utf-8", "ignore"), [{"start": a, "end": b} for a, b in merged]] if outputs else out)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *(t for _, t in more)]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(n for n, _ in more)]
            made = zip(*rows) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(made, kinds)), *batch.columns[3:]], [key, *names, *["row"] * row])

    return joined.select("key", "text", "spans", *["row"] * row).mapInArrow(run, schema)
