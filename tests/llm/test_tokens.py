"""The tokenization automaton and packing, against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tripmill.llm import bpe, packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, shard string, start string, n_tokens string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(seed=1, n=300):
    rng = random.Random(seed)
    letters = "aabcdeghilmnorstu 'éßñ12.,-́ſİΣς\x1c\x85\xa0 中文\U0001f642<|endoftext|>\xb2\xaa\xb5\t\n"
    words = [w.replace("</w>", "") for w in rng.sample(sorted(bpe.memo(PATH, "bytes").automaton.ids), 3000)]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]
    texts += ["".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(n)]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(n)]
    texts += [c * k for c in ("a", "the", "!", "-", "=", "é") for k in range(1, 40)]
    return [*texts, "", " ", "x<|startoftext|>y", "it's WE'RE don't 'S", "a" * 3000, "word " * 2000]


def ids_of(text):
    return np.frombuffer(next(bpe.ids_of([text], PATH)), "<u4").tolist()


def test_ids_equal_the_library(library):
    automaton = bpe.memo(PATH, "bytes").automaton
    texts = odd_texts()
    for text, got in zip(texts, bpe.ids_of(texts, PATH), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert automaton.decode(want) == library.decode(want, skip_special_tokens=False)


def test_memo_forgets_but_stays_right(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 20)
    for text in odd_texts(2, 60):
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_transition_table_equals_the_library(library):
    """An arc leads from a label's state exactly if the library splits their text so."""
    automaton = bpe.memo(PATH, "bytes").automaton
    rng = random.Random(6)
    ids, end = automaton.ids, automaton.end
    inner = [x for x in ids if not x.endswith(end)]
    every, by_start = sorted(ids), {}
    for x in ids:
        by_start.setdefault(x[0], []).append(x)
    pairs = [(rng.choice(inner), rng.choice(every)) for _ in range(10_000)]
    pairs += [(a, rng.choice(by_start[x])) for a in rng.sample(inner, 4000) for x in (a[-1], a[0], "e") if x in by_start]  # many that are joined
    pairs += [(a * m, a * n + e) for a in "aeox!-=" for m in range(1, 9) for n in range(1, 9) for e in ("", end) if a * m in ids and a * n + e in ids]
    want = []
    for a, b in pairs:
        whole = b.endswith(end) and b != end
        got = [t.id for t in library.model.tokenize(a + (b.removesuffix(end) if whole else b))]
        want.append(got == [ids[a], ids[b]] if whole else None)  # the library always ends a word
    got = automaton.arcs(np.array([ids[a] for a, _ in pairs]), np.array([ids[b] for _, b in pairs])).tolist()
    checked = [(g, w) for g, w in zip(got, want) if w is not None]
    assert len(checked) > 3000 and sum(w for _, w in checked) > 500 and sum(not w for _, w in checked) > 500
    assert all(g == w for g, w in checked)


def test_gadgets_equal_merging_by_rank():
    """The table on all pairs of labels of small vocabularies."""
    rng = random.Random(7)
    for _ in range(30):
        tokens, merges = list("abc"), []
        for _ in range(12):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens:
                merges.append((len(tokens), tokens.index(u), tokens.index(v)))
                tokens.append(u + v)
        made = bpe.Automaton.__new__(bpe.Automaton)
        made.size = len(tokens)
        made._compile(np.array([(u, v, uv) for uv, u, v in merges], "i8").reshape(-1, 3))
        size = len(tokens)
        for word in ("".join(rng.choices("abc", k=rng.randrange(2, 9))) for _ in range(200)):
            path = bpe_by_merging(word, tokens, merges)
            if len(path) > 1:
                assert made.arcs(np.array(path[:-1]), np.array(path[1:])).all()
        for p in range(size):
            for t in range(size):
                if bpe_by_merging(tokens[p], tokens, merges) == [p] and bpe_by_merging(tokens[t], tokens, merges) == [t]:
                    assert made.arcs(np.array([p]), np.array([t]))[0] == (bpe_by_merging(tokens[p] + tokens[t], tokens, merges) == [p, t])


def bpe_by_merging(word, tokens, merges):
    path = ["abc".index(c) for c in word]
    for uv, u, v in merges:
        out = []
        for t in path:
            if out and out[-1] == u and t == v:
                out[-1] = uv
            else:
                out.append(t)
        path = out
    return path


def test_long_words_and_unknown_patterns(library, tmp_path):
    for text in ("=" * 5000, "ab" * 5000, "x" * 20_000):
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids
    other = tmp_path / "other.json"
    other.write_text(open(PATH, encoding="utf-8").read().replace("'ll|'d", "'ll"), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Automaton(str(other))


def test_codec_query_columns(spark, library):
    texts = [*odd_texts(3, 40), None]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in bpe.codec(docs, PATH, outputs=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        r = got[i]
        assert (r["n_tokens"], r["ids"], r["decoded"]) == (len(ids), ids, decoded)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.codec(docs.limit(0), PATH).count() == 0


def naive_best_fit(lengths, size):
    rooms, out = [], []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(size - n)
        out.append(n)
    return len(rooms)


def test_best_fit_decreasing_uses_as_many_windows_as_brute_force():
    rng = random.Random(4)
    for size in (10, 64, 100):
        for _ in range(20):
            lengths = np.array([rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 200))])
            window, offset, made = packing.best_fit_decreasing(lengths, size)
            assert made == naive_best_fit(lengths.tolist(), size)
            for w in range(made):
                at = np.flatnonzero(window == w)
                at = at[np.argsort(offset[at])]
                ends = np.cumsum(lengths[at])
                assert ends[-1] <= size and offset[at].tolist() == [0, *ends[:-1].tolist()]


def test_packed_pieces_are_whole(spark, library):
    texts = ["one two three", None, "", "word " * 1000, "a b " * 200, "same text", "same text", *odd_texts(5, 20)]
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)] + [(5, "same text", "x", "y", "z"), (None, "no key", "x", "y", "z")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for shard_docs in (packing.SHARD_DOCS, 30):
        got = packing.pack(docs, PATH, size=64, shard_docs=shard_docs).collect()
        pieces, places = {}, {}
        for r in got:
            pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for i, t, *_ in rows:
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
            cuts = [(s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes())) for s in range(0, len(ids), 64)]
            times = sum(1 for x in rows if x[:2] == (i, t))
            assert sorted(pieces[i, len(ids)]) == sorted(cuts * times)
        for at in places.values():
            end = 0
            for offset, length in sorted(at):
                assert offset == end
                end += length
            assert end <= 64
        assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
        used = sum(r["length"] for r in got)
        assert used / (64 * len(places)) > 0.9
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_repeated_rows_are_packed_by_many_tasks(spark):
    docs = spark.createDataFrame([(7, "the same words again")] * 2000, "doc_id long, text string").repartition(4)
    got = packing.pack(docs, PATH, size=64, shard_docs=100).collect()
    shards = Counter(r["sequence_id"] >> 32 for r in got)
    assert len(got) == 2000 and len(shards) == 20 and max(shards.values()) < 200
