"""Fill-in-middle, against plain Python."""

import hashlib
import random

import pytest

from tripmill.llm import fillmiddle

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def expected(key, text):
    text = text or ""
    n, h = len(text), sha("1:" + ("" if key is None else str(key)))
    r = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((r[0] % (n + 1), r[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or r[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if r[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("slab", [fillmiddle.SLAB, 100])
def test_forms_and_texts(spark, monkeypatch, slab):
    monkeypatch.setattr(fillmiddle, "SLAB", slab)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab <>PSM\n\0é\U0001f600́中") for _ in range(rng.randrange(40))) for _ in range(600)]
    texts += ["", None, "<P>", "x<S>y", "<M", "é" * 5000]
    rows = [(i if i % 50 else None, t, 5) for i, t in enumerate(texts)] + [(7, "twice", 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = fillmiddle.transform(docs, outputs=True).collect()
    assert len(got) == len(rows)
    want = []
    for key, text, _ in rows:
        n, form, a, m, out = expected(key, text)
        want.append((key, n, form, a, m, sha(out), sha(text or ""), out, text or ""))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_tables_and_names(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fillmiddle.transform(docs).collect() == []
    with pytest.raises(ValueError):
        fillmiddle.transform(docs.withColumnRenamed("doc_id", "form"), key="form")
