"""Approximate nearest neighbours by collision counting (query-aware hashing).

Each random projection of a block of vectors is one sorted array. A query looks
at a window around its own projection in each array. The window of a larger
radius contains that of a smaller one, so one array serves all radii (virtual
rehashing): when the radius grows, each window is extended at both ends, and
only the vectors that enter it then add to their collision counters. A vector
whose counter reaches the threshold is verified by its inner product. The radius
grows until k verified vectors are within it.

Inner products become distances by one more component that gives all vectors
one length, which keeps the order of the inner products for each query.

Every vector is indexed, in blocks that are dealt by row. Queries are a stated
set against all vectors, so each block of queries meets each block of vectors; a
task holds one of each, and only the k best of each query and block are shuffled
on. Blocks are as large as a task's memory allows, as a row is copied once for
each block of the other side.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import small_batches

#: Vectors and queries of one block: at most, and what is not cut further to keep all cores busy.
BLOCK, LEAST_BLOCK = 65_536, 4096
#: Projections, half a window's width at radius 1, and how far (in standard
#: deviations) the threshold lies under the collisions expected at the radius.
PROJECTIONS, WIDTH, SLACK = 24, 0.3, 1.3
FIRST_RADIUS, GROWTH = 0.3, 1.4


def usable(vector: str) -> Column:
    """Not null, not zero, all components there and finite."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good & F.exists(v, lambda x: x != 0), F.lit(False))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, components added in order."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(a.shape[1]):
            total += a[:, i] * b[:, i]
    return total


def unit_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length 1 and the logarithms of their lengths, of any finite magnitude."""
    most = np.abs(x).max(1)
    x = x / most[:, None]
    length = np.sqrt(inner(x, x))
    return x / length[:, None], np.log(most) + np.log(length)


class Index:
    """Sorted projections of a block of vectors."""

    def __init__(self, x: np.ndarray) -> None:
        n, d = x.shape
        unit, size = unit_rows(x)
        size = np.exp(size - size.max())  # of the longest
        self.a = np.random.default_rng(n * 1000 + d).standard_normal((PROJECTIONS, d + 1))
        lifted = np.hstack([unit * size[:, None], np.sqrt(np.maximum(0, 1 - size**2))[:, None]])
        self.rough = lifted[:, :-1].astype("f4")  # picks what is then compared in double precision
        spots = np.ascontiguousarray((lifted @ self.a.T).T)
        self.order = np.argsort(spots, axis=1).astype("i4")
        self.spots = np.take_along_axis(spots, self.order, 1)
        p = math.erf(WIDTH / math.sqrt(2))
        self.least = max(1, int(PROJECTIONS * p - SLACK * math.sqrt(PROJECTIONS * p * (1 - p))))
        # up to windows that hold everything: all distances are at most 2, all projections at most |a|
        widest = 2 * np.sqrt((self.a * self.a).sum(1).max()) / WIDTH
        self.radii = FIRST_RADIUS * GROWTH ** np.arange(math.ceil(math.log(widest / FIRST_RADIUS) / math.log(GROWTH)) + 1)

    def windows(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (queries x radii x projections) of the windows in the sorted arrays."""
        reach = WIDTH * self.radii
        lo, hi = (np.empty((len(centres), len(reach), PROJECTIONS), "i4") for _ in range(2))
        for j, s in enumerate(self.spots):
            lo[:, :, j] = np.searchsorted(s, centres[:, j, None] - reach)
            hi[:, :, j] = np.searchsorted(s, centres[:, j, None] + reach, "right")
        return lo, hi

    def candidates(self, u: np.ndarray, lo: np.ndarray, hi: np.ndarray, skip: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors whose counter reached the threshold before k of them were within the radius, and their rough products.

        lo, hi: the windows of a unit query, radii x projections; skip: vectors that are no results.
        """
        n = len(self.rough)
        hits, done = np.zeros(n, "i8"), np.zeros(n, bool)
        cols, nears, first, last = [], [], lo[0].tolist(), lo[0].tolist()
        for radius, low, high in zip(self.radii, lo.tolist(), hi.tolist()):
            entered = [row[a:b] for row, a, b in zip(self.order, low, first) if a < b]
            entered += [row[a:b] for row, a, b in zip(self.order, last, high) if a < b]
            first, last = low, high
            if entered:
                hits += np.bincount(np.concatenate(entered), minlength=n)
            col = np.flatnonzero((hits >= self.least) & ~done)
            done[col] = True
            col = col[~skip[col]]
            cols.append(col)
            nears.append(self.rough[col] @ u)
            # at unit length the squared distance is 2 - 2 <q, x>
            if sum(np.count_nonzero(x >= 1 - radius * radius / 2) for x in nears) >= k or done.all():
                break
        return np.concatenate(cols), np.concatenate(nears)


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of x for each query, vectors of the query's own id left out."""
    index = Index(x)
    unit, _ = unit_rows(q)
    out = []
    for start in range(0, len(q), 256):  # bounds the windows' table
        lo, hi = index.windows(unit[start : start + 256] @ index.a[:, :-1].T)
        for i, (a, b) in enumerate(zip(lo, hi), start):
            col, near = index.candidates(unit[i].astype("f4"), a, b, ids == query_ids[i], k)
            if len(near) > k:  # what rounding could still bring among the k best, all ties included
                col = col[near >= np.partition(near, -k)[-k] - 1e-4]
            score = inner(np.broadcast_to(q[i], (len(col), x.shape[1])), x[col])
            best = np.lexsort((ids[col], -score))[:k]
            out.append((np.full(len(best), query_ids[i]), ids[col[best]], score[best]))
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products found for each query.

    Null, zero and non-finite vectors and rows with a null key take no part;
    components may have any finite magnitude (a product beyond the largest
    double is infinite, and one that is no number comes last). A query's own key
    is never its result; ties go to the smaller key. Vectors are compared with
    queries of the same length only. Rows with equal keys are candidates each,
    in any number; queries with equal keys are answered as one. Other columns
    are left out.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    clean = lambda df: df.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    x, q = clean(vectors), clean(queries).dropDuplicates(["id"])
    block = lambda n, cores: max(1, math.ceil(n / min(BLOCK, max(LEAST_BLOCK, math.ceil(n / cores)))))
    blocks, parts = block(x.count(), spark.sparkContext.defaultParallelism), block(q.count(), 1)
    x = x.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    q = q.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": pd.Series(dtype="i8"), "vec_id": pd.Series(dtype="i8"), "score": pd.Series(dtype="f8")})]
        if len(left) and len(right):
            for d in set(left["v"].map(len)) & set(right["v"].map(len)):
                a, b = (y[y["v"].map(len) == d] for y in (left, right))
                found.append(search_block(a["id"].to_numpy("i8"), np.stack(a["v"].to_list()), b["id"].to_numpy("i8"), np.stack(b["v"].to_list()), k))
        return pd.concat(found)

    found = x.groupBy("block", "part").cogroup(q.groupBy("block", "part")).applyInPandas(cell, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
