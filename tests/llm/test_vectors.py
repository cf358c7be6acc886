"""Nearest neighbours and near-duplicate embeddings against brute force."""

import math

import numpy as np

from tripmill.llm import ann, crosspolytope

SCHEMA = "vec_id long, embedding array<float>, label int, score string, block string, rep string"


def rows_of(x, labels, first=0):
    return [(first + i, [float(v) for v in row], None if label is None else int(label), "s", "b", "r") for i, (row, label) in enumerate(zip(x, labels))]


def test_search_recall_order_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    monkeypatch.setattr(ann, "LEAST_BLOCK", 100)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 24)).astype("f4")
    x[:100] = x[0] + rng.standard_normal((100, 24)).astype("f4") * 0.05
    x *= rng.uniform(0.5, 2, (900, 1)).astype("f4")
    df = spark.createDataFrame(rows_of(x, [1] * 900), SCHEMA).repartition(4)
    got = ann.search(df, df.where("vec_id % 20 = 0"), 20).collect()
    exact = x.astype("f8") @ x.astype("f8").T
    hits = 0
    for q in range(0, 900, 20):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and q not in {r["vec_id"] for r in mine}
        assert all(math.isclose(r["score"], exact[q, r["vec_id"]], rel_tol=1e-12) for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        order = sorted((i for i in range(900) if i != q), key=lambda i: -exact[q, i])[:20]
        hits += len(set(order) & {r["vec_id"] for r in mine})
    assert hits >= 0.9 * 20 * 45


def test_search_leaves_out_unusable_vectors_and_breaks_ties(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 2.0], 1, "", "", "") for i in (7, 3, 5)] + [(20, [2.0, 0.0], 1, "", "", "")]
    bad = [(1, None, 1, "", "", ""), (2, [0.0, 0.0], 1, "", "", ""), (4, [nan, 1.0], 1, "", "", ""), (6, [inf, 1.0], 1, "", "", ""), (8, [None, 1.0], 1, "", "", ""), (9, [1.0], 1, "", "", ""), (None, [1.0, 1.0], 1, "", "", "")]
    df = spark.createDataFrame(good + bad, SCHEMA)
    got = ann.search(df, df.where("vec_id in (20, 2, 4)"), 20).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(20, 1, 3, 2.0), (20, 2, 5, 2.0), (20, 3, 7, 2.0)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_recall_of_one_block_at_production_parameters():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((20_000, 64)).astype("f4").astype("f8")
    x[:2000] = x[rng.integers(2000, 2100, 2000)] + rng.standard_normal((2000, 64)) * 0.3
    x *= rng.uniform(0.5, 1.5, (len(x), 1))
    ids = np.arange(len(x))
    asked = np.arange(0, len(x), 500)
    got = ann.search_block(ids, x, ids[asked], x[asked], 20)
    exact = x[asked] @ x.T
    exact[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-exact, axis=1)[:, :20]
    hits = sum(len(set(b) & set(got[got["query_id"] == q]["vec_id"])) for q, b in zip(asked, best))
    assert len(got) == 20 * len(asked) and hits >= 0.9 * 20 * len(asked)


def test_windows_grow_and_counters_count_each_array_once():
    rng = np.random.default_rng(9)
    x, q = rng.standard_normal((300, 8)), rng.standard_normal((5, 8))
    index = ann.Index(x)
    unit, _ = ann.unit_rows(q)
    lo, hi = index.windows(unit @ index.a[:, :-1].T)
    assert (np.diff(lo, axis=1) <= 0).all() and (np.diff(hi, axis=1) >= 0).all() and (lo[:, -1] == 0).all() and (hi[:, -1] == 300).all()
    for u, a, b in zip(unit, lo, hi):
        col, near = index.candidates(u.astype("f4"), a, b, np.zeros(300, bool), 10)
        r = next(r for r, radius in enumerate(index.radii) if radius >= index.radii[0] and np.count_nonzero(near >= 1 - radius**2 / 2) >= 10)
        within = np.zeros(300, int)
        for order, first, last in zip(index.order, a[r], b[r]):
            within[order[first:last]] += 1
        assert set(col) >= set(np.flatnonzero(within >= index.least))


def test_search_with_huge_and_tiny_components_and_repeated_ids(spark):
    rng = np.random.default_rng(10)
    for size in (1e160, 1e-170, 1e300, 5e-324):
        x = rng.integers(1, 9, (40, 4)) * size
        df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
        got = ann.search(df, df.where("vec_id < 3"), 5).collect()
        assert len(got) == 15 and all(r["query_id"] != r["vec_id"] for r in got)
    same = spark.createDataFrame([(7, [1.0, 2.0])] * 3000 + [(8, [2.0, 1.0])], "vec_id long, embedding array<double>").repartition(3)
    got = ann.search(same, same.where("vec_id = 8"), 5).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(7, 4.0)] * 5


def brute_links(x, labels, cosine):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([[a is not None and a == b for b in labels] for a in labels])
    linked = (unit @ unit.T >= cosine) & same
    np.fill_diagonal(linked, False)
    component = np.arange(len(x))
    while True:
        new = np.array([min([component[i], *component[linked[i]]]) for i in range(len(x))])
        if (new == component).all():
            return linked.sum(1), component
        component = new


def test_near_duplicates_equal_brute_force_with_split_buckets(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((500, 32))
    for k in range(0, 300, 30):  # a hot group and small ones
        x[k : k + 12] = x[0 if k < 150 else k] * rng.uniform(0.5, 2) + rng.standard_normal((12, 32)) * 0.12
    x[400:420] = x[401]
    x = x.astype("f4").astype("f8")
    labels = [None if i % 50 == 49 else i % 2 if i > 150 else 1 for i in range(500)]
    df = spark.createDataFrame(rows_of(x, labels), SCHEMA).repartition(3)
    links, component = brute_links(x, labels, 0.98)
    assert links.sum() > 1000
    for block in (1024, 8):
        got = {r["vec_id"]: r for r in crosspolytope.near_duplicates(df, block=block).collect()}
        assert [got[i]["n_links"] for i in range(500)] == links.tolist()
        assert [got[i]["component_id"] for i in range(500)] == component.tolist()
        assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_members_close_to_different_smallest_ones_stay_in_one_part():
    def signs(*bits):
        return np.packbits(np.isin(np.arange(128), np.concatenate([np.arange(x, y) for x, y in bits])).astype("u1")).view("u8")

    # in a row, each is close to the next only; the ends of the pair in the middle have smaller neighbours of their own
    row = np.stack([signs((0, 0)), signs((0, 20)), signs((0, 40)), signs((0, 60))])
    cid = np.array([1, 5, 7, 2])
    assert crosspolytope.close(row, cid, np.zeros(4, "i8")).tolist() == [1] * 4
    assert crosspolytope.close(row, cid, np.array([0, 1, 0, 1])).tolist() == [1] * 4
    assert crosspolytope.close(row, cid, np.array([0, 0, 1, 1])).tolist() == [1, 5, 5, 2]
    rng = np.random.default_rng(7)
    many = np.concatenate([np.repeat(rng.integers(0, 1 << 63, (5, 2), "u8"), 300, 0)])
    many[:, 0] ^= np.uint64(1) << rng.integers(0, 63, 1500, "u8")
    found = crosspolytope.close(many, rng.permutation(1500), np.zeros(1500, "i8"))
    assert [len(set(x)) for x in found.reshape(5, 300)] == [1] * 5 and len(set(found)) == 5


def test_links_between_members_with_smaller_neighbours_of_their_own_join_components(spark):
    # in a row, each is linked to the next only: 1 - 5 - 7 - 2
    x = np.array([[math.cos(t), math.sin(t), 0.0] for t in np.arange(4) * 0.19])
    cid, size = np.array([1, 5, 7, 2]), np.array([1, 2, 1, 1])
    links, least = crosspolytope.linked(cid, size, x, np.zeros(4, "i8"), 0.98)
    assert links.tolist() == [2, 2, 3, 1] and least.tolist() == [1] * 4
    assert crosspolytope.linked(cid, size, x, np.array([0, 1, 0, 1]), 0.98)[1].tolist() == [1] * 4
    assert crosspolytope.linked(cid, size, x, np.array([0, 0, 1, 1]), 0.98)[1].tolist() == [1, 5, 5, 2]
    # chains of vectors in one label, their ids in random order
    rng = np.random.default_rng(12)
    ids = rng.permutation(400)
    chains = np.zeros((400, 32))
    for i, row in enumerate(chains):
        row[i // 40 * 2 : i // 40 * 2 + 2] = math.cos(i % 40 * 0.15), math.sin(i % 40 * 0.15)
    vectors = chains[np.argsort(ids)]
    links, component = brute_links(vectors, [1] * 400, 0.98)
    df = spark.createDataFrame(rows_of(vectors, [1] * 400), SCHEMA.replace("array<float>", "array<double>")).repartition(3)
    for block in (1024, 16):
        got = {r["vec_id"]: r for r in crosspolytope.near_duplicates(df, block=block).collect()}
        assert [got[i]["n_links"] for i in range(400)] == links.tolist()
        assert [got[i]["component_id"] for i in range(400)] == component.tolist()


def test_deeper_codes_find_the_same_links(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.repeat(rng.standard_normal((60, 64)), 4, axis=0) + rng.standard_normal((240, 64)) * 0.1
    labels = [1] * 240
    df = spark.createDataFrame(rows_of(x.astype("f4"), labels), SCHEMA)
    links, _ = brute_links(x.astype("f4").astype("f8"), labels, 0.98)
    for depth in (2, 3):
        monkeypatch.setattr(crosspolytope, "depth_for", lambda n, w, d=depth: d)
        got = {r["vec_id"]: r["n_links"] for r in crosspolytope.near_duplicates(df).collect()}
        assert [got[i] for i in range(240)] == links.tolist()


def test_no_pair_at_the_bound_is_missed_at_any_depth():
    rng = np.random.default_rng(11)
    n = 4000
    a = rng.standard_normal((n, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((n, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * side
    signs = np.bitwise_count(crosspolytope.sketches(a) ^ crosspolytope.sketches(b)).sum(1)
    assert signs.max() <= crosspolytope.SIGNS
    for depth, tables in crosspolytope.TABLES.items():
        x, y = (crosspolytope.codes(v, tables, depth) for v in (a, b))
        met = (x[:, :, :, None] == y[:, :, None, :]).any((1, 2, 3))
        assert met.all(), (depth, int((~met).sum()))


def test_depth_follows_the_number_of_vectors():
    found = [crosspolytope.depth_for(n) for n in (0, 500, 60_000, 100_000, 8_000_000, 10_000_000, 10**12)]
    assert found == [1, 1, 1, 2, 2, 3, 3]


def test_equal_keys_and_magnitudes(spark):
    rows = [(1, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.01, 0.0], 1), (2, [1e200, 1e198, 0.0], 1), (3, [1e-300, 0.0, 1e-301], 1), (1, [1.0, 0.01, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in crosspolytope.near_duplicates(df).collect())
    assert got == [(1, 0, 1), (1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 3, 1)]


def test_unusable_vectors_link_with_nothing(spark):
    nan = float("nan")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [1.0, 1.0], None), (5, [1.0, 1.0], 2), (6, [2.0, 2.0], 2), (7, [1.0, 1.0, 0.0], 2), (5, [1.0, 1.0], 2), (None, [1.0, 1.0], 2)]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in crosspolytope.near_duplicates(df).collect())
    assert got == sorted([("1", 0, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("4", 0, "4", True), ("5", 2, "5", True), ("5", 2, "5", True), ("6", 2, "5", False), ("7", 0, "7", True), ("None", 0, "None", False)])
    assert crosspolytope.near_duplicates(df.limit(0)).count() == 0


def test_hadamard_is_orthogonal():
    h = crosspolytope.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, 16 * np.eye(16))
