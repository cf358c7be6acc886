"""Manifests, against a tree built in plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tripmill.llm import merkle

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def digest(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, up=None):
    """Root, and of each node the (siblings before, siblings after) of each level."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, groups = [], []
        for i in range(0, len(nodes), 16):
            run = nodes[i : i + 16]
            for k in range(len(run)):
                for leaf in members[i + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            groups.append([x for m in members[i : i + 16] for x in m])
        nodes, members = above, groups
    return nodes[0], paths


def expected(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[0], s, r[2]))) for s in sources}
    made = {s: tree([digest(*r) for r in of[s]]) for s in sources}
    root, tops = tree([made[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        for r, path in zip(of[s], made[s][1]):
            proof = "".join(a + b for a, b in [*path, *top])
            now = fold = digest(r[0], s, (r[2] or "").lower() if r[2] is not None and r[0] is not None and r[0] % 3 == 0 else r[2])
            for a, b in [*path, *top]:
                fold = sha(a + fold + b)
            out.append((r[0], digest(*r), made[s][0], root, sha(proof), fold, now))
    return out


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("path", F.lit(1)).withColumn("Leaf", F.lit(1))
    leaf = lambda text: merkle.digest_of(F.col("doc_id"), F.col("source"), text)
    made = merkle.manifest(docs, leaf(F.col("text")), changed=F.when(F.col("doc_id") % 3 == 0, leaf(F.lower("text"))))
    now = F.coalesce("changed", "leaf")
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256), merkle.fold(F.col("path"), now), now)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [300, 1, 16, 33], [5000, 40], [1] * 40])
def test_roots_proofs_and_folds(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [(10 * i + s, f"é{s}" if s else None, rng.choice(["A", "b", "", None, "Ünï"]) ) for s, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    assert sorted(map(tuple, found(spark, rows).collect())) == sorted(expected(rows))


def test_repeated_and_null_ids(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 2, 3]), rng.choice(["a", "B", None]), rng.choice("XYxy")) for _ in range(400)]
    order = lambda rows: sorted(map(repr, rows))
    assert order(map(tuple, found(spark, rows).collect())) == order(expected(rows))


def test_frontiers_meet_in_later_rounds(spark, monkeypatch):
    """Tasks of a few rows leave all that is above them to the rounds after."""
    monkeypatch.setattr(merkle, "STRIDE", 1)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        rows = [(i, "a" if i % 3 else "b", "T") for i in range(900)]
        assert sorted(map(tuple, found(spark, rows).collect())) == sorted(expected(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_an_empty_table_has_no_rows(spark):
    assert found(spark, []).collect() == []


def test_tampering_shows(spark):
    rows = [(i, "s", "Text" if i % 2 else "text") for i in range(50)]
    for doc_id, leaf, _, root, _, fold, now in found(spark, rows).collect():
        assert (fold == root) == (now == leaf) == (not (doc_id % 3 == 0 and doc_id % 2))
