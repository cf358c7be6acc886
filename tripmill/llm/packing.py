"""Packing documents into fixed windows by best-fit decreasing.

Documents are tokenized where they are read, once; their pieces (a few numbers
each) are a table in the shared folder. Full windows have their sequences at once.
Only the rests of documents are shuffled, by a hash of their row's place, so
repeated rows spread like any others, over shards of a bounded mean size. A shard
is packed by itself, so more documents mean more shards, not larger ones; each
shard can leave one badly filled window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.bpe import ids_of, shared
from tripmill.llm.common import Tables, give_back, small_batches

#: Mean number of documents whose pieces are packed together.
SHARD_DOCS = 16_384


class OpenWindows:
    """A segment tree over remaining capacities 0..size with the open windows at its leaves.

    A node counts the open windows below it, so the tightest window with at
    least some room is found by one climb and one descent.
    """

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, room: int, window: int) -> None:
        self.at[room].append(window)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, window) of the tightest window with ``least`` room; removes it."""
        node, count = least + self.leaves, self.count
        while not count[node]:
            while node & 1:  # a right child: nothing larger under its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.at[room].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(window, offset) of each piece, and the number of windows. Lengths are 1..size."""
    window, offset = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    free, made = OpenWindows(size), 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        found = free.take(n) if n < size else None
        room, w = found if found else (size, made)
        made += not found
        window[i], offset[i] = w, size - room
        if room > n:
            free.push(room - n, w)
    return window, offset, made


def pack(docs: DataFrame, vocabulary: str, size: int = 4096, end_id: int = 2, text: str = "text", key: str = "doc_id", shard_docs: int = SHARD_DOCS, tables: Tables | None = None) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``size`` ids.

    A document is its ids and then ``end_id``; a null or empty text is
    ``end_id`` alone. Overlong documents are cut into full windows and a rest;
    rests are packed best fit decreasing. Returns key, start, length,
    ids_crc32, doc_tokens, sequence_id, offset. Rows with equal keys are packed
    as separate documents, in any number; null keys are kept and further columns
    left out. sequence_id is unique, with gaps; it is negative for the full
    windows of overlong documents.
    """
    small_batches(docs.sparkSession)
    tables = tables or Tables(docs.sparkSession)
    automaton = shared(docs.sparkSession, vocabulary)
    kind = dict(docs.dtypes)[key]
    shards = max(1, round(docs.count() / shard_docs))  # a count from the file footers
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("shard", pa.int64()), ("full_id", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end_id], "<u4").tobytes()
        full = -1 - (TaskContext.get().partitionId() << 40)
        for batch in batches:
            rows, source = [], []
            for at, (ids, shard) in enumerate(zip(ids_of(batch.column(1).to_pylist(), vocabulary, automaton), batch.column(2).to_pylist())):
                ids += last
                n = len(ids) // 4
                for start in range(0, n, size):
                    part = ids[4 * start : 4 * (start + size)]
                    whole = len(part) == 4 * size
                    rows.append((start, len(part) // 4, zlib.crc32(part), n, shard, full if whole else None))
                    full -= whole
                    source.append(at)
            columns = [pa.array(c, f[1]) for c, f in zip(zip(*rows), fields)] if rows else [pa.array([], f[1]) for f in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())), *columns], [key, *(f[0] for f in fields)])
        give_back()

    def place(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["length", "ids_crc32", key, "start"], ascending=[False, True, True, True], ignore_index=True)
        window, offset, _ = best_fit_decreasing(x["length"].to_numpy(), size)
        return x.drop(columns=["shard", "full_id"]).assign(sequence_id=(int(x["shard"].iat[0]) << 32) + window, offset=offset)

    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    pieces = f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    cuts = tables.write(docs.select(key, text, dealt.alias("shard")).mapInArrow(cut, f"{pieces}, shard long, full_id long"), "pieces")
    rests = cuts.where("full_id is null").groupBy("shard").applyInPandas(place, f"{pieces}, sequence_id long, offset long")
    return rests.unionByName(cuts.where("full_id is not null").withColumn("sequence_id", F.col("full_id")).withColumn("offset", F.lit(0).cast("long")).drop("shard", "full_id"))
