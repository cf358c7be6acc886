"""SimHash groups against brute force over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import xxhash

from tripmill.llm import golay, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, rep string, component_id string"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {k: k for k in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 2:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {k: root(k) for k in prints}


def test_golay_words_within_two_bits_share_an_index():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 400)
    for flips in [(), *combinations(range(23), 1), *combinations(range(23), 2)]:
        other = words ^ sum(1 << i for i in flips)
        (a, in_a), (b, in_b) = golay.indices(words), golay.indices(other)
        same = (a[:, :, None] == b[:, None, :]) & in_a[:, :, None] & in_b[:, None, :]
        assert same.any((1, 2)).all()


def test_shingle_fingerprint_matches_its_definition():
    for text in [None, "", " \t\n", "One", "one TWO", "a b c", "a b c a b c a b c", "É à Ünï\xa0code x\x85y z", "x " * 70000]:
        assert simhash.majority(simhash.shingle_hashes(simhash.words_of(text), 3)) == brute_fingerprint(text)


def corpus():
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(40, 90))) for _ in range(40)]
    for t in list(texts[:25]):
        words = t.split()
        for _ in range(6):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [None, "", "  ", "short", "short", "Short", "two words"] + [texts[0]] * 5
    rng.shuffle(texts)
    return texts


def test_groups_equal_brute_force_with_small_and_large_buckets(spark):
    texts = corpus()
    rows = [(i * 3 + 1, t, None, "s", None, "x", "y", "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    want = {r[0]: brute_fingerprint(r[1]) for r in rows}
    component = brute_components(want)
    for bucket in (256, 1):
        got = {r["doc_id"]: r for r in simhash.groups(docs, bucket=bucket).collect()}
        assert {k: r["fp"] & (2**64 - 1) for k, r in got.items()} == want
        assert {k: r["component_id"] for k, r in got.items()} == component
    assert len(set(component.values())) < len(component) - 20


def test_empty_and_repeated_rows_and_null_keys(spark):
    assert simhash.groups(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(7, "a b c d", *[None] * 6), (7, "a b c d", *[None] * 6), (None, "a b c d", *[None] * 6), (None, "other text here", *[None] * 6)]
    got = sorted(map(str, ((r["doc_id"], r["component_id"]) for r in simhash.groups(spark.createDataFrame(rows, DOCS)).collect())))
    assert got == sorted(map(str, [(7, 7), (7, 7), (None, 7), (None, None)]))
