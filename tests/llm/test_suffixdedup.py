"""Substring de-duplication against brute force over all strings."""

import hashlib
import random
from collections import defaultdict

import numpy as np

from tripmill.llm import suffixdedup

DOCS = "doc_id long, text string, h string, ctx string, rid string, spans string"


def brute(rows, length, keep_first):
    """rows: (key, text) in order; the bytes that go, by row."""
    places = defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    for r, d in enumerate(data):
        for i in range(len(d) - length + 1):
            places[d[i : i + length]].append((r, i))
    gone = [np.zeros(len(d), bool) for d in data]
    for at in places.values():
        if len(at) > 1:
            for r, i in sorted(at)[1 if keep_first else 0 :]:
                gone[r][i : i + length] = True
    return data, gone


def digest(data, gone):
    left = bytes(b for b, g in zip(data, gone) if not g)
    edges = np.diff(np.concatenate([[0], gone.astype(int)]))
    return len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(left).hexdigest()


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choices("abcdé fgh", k=n))
    shared = [prose(rng.randrange(30, 200)) for _ in range(8)]
    texts = [prose(rng.randrange(0, 150)) + rng.choice(shared)[rng.randrange(20) :] + prose(rng.randrange(0, 80)) + rng.choice(shared) for _ in range(60)]
    texts += [None, "", "short", "a" * 500, "a" * 39, "ab" * 200, texts[0], texts[0], texts[1] * 3, prose(3000)]
    texts += [prose(40) + shared[0] + prose(40) for _ in range(60)]  # one passage in very many texts
    return texts


def test_dedup_equals_brute_force(spark):
    length = 40
    for seed in (1, 2):
        texts = corpus(seed)
        rows = [(i, t) for i, t in enumerate(texts)]
        docs = spark.createDataFrame([(i, t, "x", "y", "z", "s") for i, t in rows], DOCS).repartition(3)
        for keep_first in (False, True):
            data, gone = brute(rows, length, keep_first)
            for variants in (2000, 5):
                old = suffixdedup.FIRST_K, suffixdedup.NEXT_K
                suffixdedup.FIRST_K, suffixdedup.NEXT_K = 8, 34
                got = {r["doc_id"]: r for r in suffixdedup.dedup(docs, length, keep_first, outputs=True, variants=variants).collect()}
                suffixdedup.FIRST_K, suffixdedup.NEXT_K = old
                assert len(got) == len(rows)
                for i, _ in rows:
                    r = got[i]
                    assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == digest(data[i], gone[i]), (seed, keep_first, variants, i)
                    covered = np.zeros(len(data[i]), bool)
                    for s in r["spans"]:
                        covered[s["start"] : s["end"]] = True
                    assert (covered == gone[i]).all()


def test_arrays_equal_brute_force():
    rng = random.Random(8)
    for length in (1, 3, 8, 11, 40):
        for _ in range(25):
            parts = [bytes(rng.choices(b"ab" if rng.random() < 0.7 else b"abcd", k=rng.randrange(length, 120))) for _ in range(rng.randrange(1, 5))]
            parts += [p[rng.randrange(10) :] + b"aab" * 15 for p in parts if len(p) > 50]
            data = np.frombuffer(b"".join(parts), "u1")
            ends = np.cumsum([len(p) for p in parts])
            whole = data.tobytes()
            places = [i for i, e in zip(range(len(data)), np.repeat(ends, [len(p) for p in parts])) if e - i >= length]
            array = suffixdedup.suffix_array(data, ends, length)
            assert array.tolist() == sorted(places, key=lambda i: (whole[i : i + length], i))
            same = lambda i, j: next((k for k in range(length) if whole[i + k] != whole[j + k]), length)
            lcp = suffixdedup.common_prefixes(data, array, length)
            assert lcp.tolist() == [0] * bool(places) + [same(a, b) for a, b in zip(array[1:], array)]
            factor = dict(zip(array.tolist(), suffixdedup.previous_factors(array, lcp).tolist()))
            assert factor == {i: max((same(i, j) for j in places if j < i), default=0) for i in places}
            again = dict(zip(array.tolist(), suffixdedup.previous_factors(-array, lcp, length).tolist()))
            assert {i for i, f in again.items() if f >= length} == {i for i in places if any(same(i, j) == length for j in places if j > i)}


def test_factors_count_a_place_once():
    rng = random.Random(9)
    for _ in range(40):
        texts = [bytes(rng.choices(b"ab", k=120)) for _ in range(4)]
        length = 12
        held = []
        for rid, t in enumerate(texts):
            for start in sorted(rng.sample(range(80), 4)):  # contexts that overlap
                held.append((rng.choice((1, 1, 1, 2)), rid, start, t[start : start + rng.randrange(length, 41)]))
        dup, later, begin, ends = suffixdedup.factors(held, length)
        places = defaultdict(set)
        copied = set()
        for n, rid, start, t in held:
            for i in range(len(t) - length + 1):
                places[t[i : i + length]].add((rid, start + i))
                copied |= {(rid, start + i)} if n > 1 else set()
        for (_, rid, start, t), a in zip(held, begin):
            for i in range(len(t)):
                at = places.get(t[i : i + length], set()) if i <= len(t) - length else set()
                assert later[a + i] == any(p < (rid, start + i) for p in at)
                assert dup[a + i] == (len(at) > 1 or bool(at & copied))


def test_long_texts_are_cut_with_overlap(spark, monkeypatch):
    rng = random.Random(5)
    a = "".join(rng.choices("abcdef", k=5000))
    texts = [a, "x" + a[1000:4000] + "y", "".join(rng.choices("ghij", k=2000))]
    data, gone = brute(list(enumerate(texts)), 200, False)
    held = [(i, t.encode(), s, e, None) for i, t in enumerate(texts) for s, e in suffixdedup._segments(t.encode(), 200)]
    assert len(held) == 3
    monkeypatch.setattr(suffixdedup, "SEGMENT", 700)
    pieces = suffixdedup._segments(a.encode(), 200)
    assert len(pieces) > 5 and pieces[-1][1] == len(a)
    assert {i for s, e in pieces for i in range(s, e - 199)} == set(range(len(a) - 199))
    monkeypatch.undo()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in suffixdedup.dedup(docs).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == digest(data[r["doc_id"]], gone[r["doc_id"]])


def test_repeated_and_null_keys_and_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert suffixdedup.dedup(empty).count() == 0
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text + "tail"), (None, None)], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffixdedup.dedup(docs).collect())
    assert got == [(0, 0), (300, 300), (300, 300), (304, 300)]
    clash = docs.selectExpr("*", "'a' as kept", "'b' as spans", "'c' as n_bytes", "'d' as row", "'e' as key", "'f' as rid")
    rows = suffixdedup.dedup(clash, outputs=True, row=True).collect()
    assert [r["row"]["kept"] + r["row"]["spans"] + r["row"]["n_bytes"] + r["row"]["row"] + r["row"]["key"] + r["row"]["rid"] for r in rows] == ["abcdef"] * 4
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffixdedup.dedup(docs, keep_first=True).collect())
    assert got == [(0, 0), (300, 0), (300, 300), (304, 300)]
