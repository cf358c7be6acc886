"""Components by alternating stars: right labels, and rounds that follow the logarithm."""

import math
import random

import pytest

from tripmill.llm.common import Tables
from tripmill.llm.components import components


class Counting(Tables):
    rounds = 0

    def write(self, df, tag):
        self.rounds += tag == "stars"
        return super().write(df, tag)


def find(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


def labels(spark, edges, tables=None):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r.node: r.component for r in components(df, tables=tables).collect()}


def folded(n):
    """2 - 4 - ... - n - (n - 1) - ... - 3 - 1: the smallest node is at the end that is reached last."""
    return [*range(2, n + 1, 2), *range(n - 1, 0, -2)]


def shuffled(n):
    order = list(range(n))
    random.Random(1).shuffle(order)
    return order


@pytest.mark.parametrize("chain", [folded, shuffled])
def test_rounds_on_long_chains(spark, chain):
    n = 1024
    order = chain(n)
    tables = Counting(spark)
    found = labels(spark, list(zip(order, order[1:])), tables)
    assert len(found) == n and set(found.values()) == {min(order)}
    assert tables.rounds <= 3 * math.log2(n)


def test_any_graph(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(x, 1000) for x in range(1001, 1200)] + [(5, 5), (7, 6), (6, 7)]
    want = find([(a, b) for a, b in edges if a != b])
    assert labels(spark, [*edges, (None, 3), (4, None)]) == want
    assert labels(spark, []) == {} and labels(spark, [(9, 9)]) == {}


def test_stars_need_no_round(spark):
    tables = Counting(spark)
    assert labels(spark, [(1, x) for x in range(2, 50)], tables) == {x: 1 for x in range(1, 50)}
    assert tables.rounds == 0
