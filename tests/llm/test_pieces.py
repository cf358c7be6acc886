"""Distinct-chunk tables, against the sentencepiece library."""

import hashlib
import random

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from sentencepiece import SentencePieceProcessor  # noqa: E402

from tripmill.llm import pieces  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def odd_texts(seed=1, n=400):
    rng = random.Random(seed)
    letters = "aabcdeghilmnorstu  ▁éßñ12.,-́ſİΣς\x1c\x85\xa0 中文\U0001f642<>s/\xb2\t\n\rﬁ\0"
    labels = pieces.chunk_table(PATH).pieces.label[259:]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(n)]
    texts += ["".join(rng.choice(labels) for _ in range(rng.randrange(1, 8))) for _ in range(n)]
    texts += ["".join(rng.choice(" ab") for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    texts += [c * k for c in (" ", "a", "the", "=", "\n", "é", "▁", "0") for k in range(1, 50)]
    return [*texts, "", " " * 500, "a" * 5000, "ab" * 3000, "<s>", "</s><unk>", "<0x41>", "﻿x", "�"]


def coded(texts):
    return [(n, ids.to_pybytes().decode(), text.to_pybytes().decode()) for n, ids, text in pieces.chunk_table(PATH).codes(pa.array(texts, pa.string()))]


def agrees(library, texts):
    for text, (n, ids, back) in zip(texts, coded(texts), strict=True):
        want = library.encode(text or "")
        assert (n, ids) == (len(want), ",".join(map(str, want))), text
        assert back == library.decode(want)


def test_codes_equal_the_library(library):
    agrees(library, [*odd_texts(), None])


@pytest.mark.parametrize("what, size", [("MEMO", 20), ("SLAB", 1), ("SHORT", 3), ("ROWS", 2)])
def test_bounds_change_nothing(library, monkeypatch, what, size):
    monkeypatch.setattr(pieces, what, size)
    agrees(library, [*odd_texts(2, 60), None])


def test_long_words_in_linear_memory(library):
    agrees(library, ["x" * 100_000, "中文" * 20_000, "a\n" * 50_000, "word " * 50_000])


def test_decode_of_any_ids(library):
    rng = random.Random(5)
    p = pieces.chunk_table(PATH).pieces
    for _ in range(500):
        ids = [rng.choice([rng.randrange(3, 400), rng.randrange(32_000)]) for _ in range(rng.randrange(12))]
        assert p.decode(ids) == library.decode(ids), ids
    assert p.decode([]) == ""


def test_every_distinct_word_is_segmented_once(monkeypatch):
    seen = []
    table = pieces.ChunkTable(PATH)
    real = table.pieces.segment
    monkeypatch.setattr(table.pieces, "segment", lambda words: seen.extend(words) or real(words))
    list(table.codes(pa.array(["to be or not to be", "be  to", "or"] * 50)))
    assert len(seen) == len(set(seen)) == 5  # to, be, or, not, and be with two markers less one


def test_models_that_do_not_fit_are_refused(tmp_path):
    with pytest.raises((OSError, RuntimeError)):
        pieces.Pieces(str(tmp_path / "none.model"))


def test_query_columns(spark, library):
    texts = [*odd_texts(3, 40), None]
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)] + [(1, "twice", "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    made = pieces.codec(docs, PATH, outputs=True)
    assert made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    got = sorted(map(str, made.collect()))
    want = []
    for key, text, _ in rows:
        ids = library.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        back = library.decode(ids)
        want.append((key, len(ids), sha(",".join(map(str, ids))), sha(back), ids, back))
    assert got == sorted(map(str, spark.createDataFrame(want, made.schema).collect()))
    assert pieces.codec(docs.limit(0), PATH).count() == 0
