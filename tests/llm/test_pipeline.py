"""The pipeline's stages against brute force on a small corpus."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import regex

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tripmill.llm import nearcopies  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentences(rng, words, n):
    return ". ".join(" ".join(rng.choices(words, k=9)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = {"aa": ["ka%sto" % c + d for c in "bcdfglmnprs" for d in "aeiou"], "bb": ["wy%sth" % c + d for c in "bcdfglmnprs" for d in ("ing", "ed", "er")]}
    passage = sentences(rng, words["aa"], 7)
    rows = []
    for i in range(60):
        lang = "aa" if i % 2 else "bb"
        rows.append((lang, sentences(rng, words[lang], rng.randrange(10, 25))))
    for k in (3, 4, 5):  # exact copies and near ones: one word of each changed
        text = rows[k][1]
        rows.append(("aa", text))
        for _ in range(30):
            w = text.split()
            w[rng.randrange(len(w))] = "changed"
            rows.append(("aa", " ".join(w)))
    rows += [("aa", sentences(rng, words["aa"], 4) + ". " + passage + ". " + sentences(rng, words["aa"], 4)) for _ in range(6)]
    rows += [("aa", None), ("bb", "12 34 %%"), ("bb", ""), ("aa", "слова другого письма, много раз " * 9), (None, "mail ann.lee@home.example.org or +1 (415) 555-0142 " + sentences(rng, words["bb"], 6))]
    rng.shuffle(rows)
    return [(i, t, lang, "s", len(t or "")) for i, (lang, t) in enumerate(rows)], passage


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def families(rows):
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {r[0]: shingles(r[1]) for r in rows}
    for a, b in combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: root(k) for k in parent}


def test_stages(spark, corpus, tmp_path):
    rows, passage = corpus
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        kept.append({r["doc_id"]: r for r in docs.collect()} if k < 4 else docs.collect())
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    language, copies, passages, private, packed = kept
    texts = {r[0]: r[1] for r in rows}
    assert set(language) == {i for i, t in texts.items() if t and regex.search(r"\p{Latin}", t)}
    family = families([(i, texts[i]) for i in language])
    assert set(copies) == {i for i, f in family.items() if i == f}
    assert sum(passage in r["text"] for r in passages.values()) == 1 and set(passages) == set(copies)
    assert all(r["n_chars"] == len(r["text"]) for r in passages.values())
    clean = [i for i in copies if passage not in texts[i]]
    assert all(passages[i]["text"] == texts[i] for i in clean)
    mail = next(i for i, t in texts.items() if t and "ann.lee" in t)
    assert "ann.lee" not in private[mail]["text"] and "555-0142" not in private[mail]["text"] and len(private[mail]["text"]) == len(passages[mail]["text"])
    assert all(private[i]["text"] == passages[i]["text"] for i in private if i != mail)
    assert {r["doc_id"] for r in packed} == set(private)
    # stages on tables with columns of any name
    names = ["score", "lang_pred", "odds", "row", "kept", "spans", "n_removed", "h", "__h", "key", "rid", "found", "made"]
    odd = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("*", *[f"'{n}' as `{n}`" for n in names])
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        if k in (0, 2, 3):
            made = stage(spark, odd, str(tmp_path))
            assert made.columns == odd.columns and all(r[n] == n for r in made.select(*names).limit(5).collect() for n in names)
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(tuple(r[c] for c in run.columns) for r in run.collect()) == sorted(tuple(r[c] for c in run.columns) for r in packed)


def test_near_copies_with_large_keys_and_odd_rows(spark, corpus, monkeypatch):
    monkeypatch.setattr(nearcopies, "BUCKET", 4)
    rows = [r for r in corpus[0] if r[1]]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", h string")
    want = families(rows)
    for hot, broadcast in ((3, 1_000_000), (3, 0)):  # hot shingles sent to all, joined
        monkeypatch.setattr(nearcopies, "HOT", hot)
        monkeypatch.setattr(nearcopies, "BROADCAST", broadcast)
        assert {r["doc_id"]: r["component_id"] for r in nearcopies.groups(docs).collect()} == want
    odd = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "A b c d e f"), (None, "other words"), (5, None), (6, " "), (7, "short"), (7, "different")], "doc_id long, text string")
    expected = sorted(["Row(doc_id=1, text='a b c d e f')", "Row(doc_id=None, text='other words')", "Row(doc_id=5, text=None)", "Row(doc_id=7, text='short')", "Row(doc_id=7, text='different')"])
    clash = odd.selectExpr("*", "'x' as h", "1 as kept_h", "2 as __h", "3 as key")
    left = nearcopies.keep_one(clash)
    assert left.columns == clash.columns and sorted(map(str, left.select("doc_id", "text").collect())) == expected
    assert nearcopies.keep_one(odd.limit(0)).count() == 0


def test_repeated_keys_of_unrelated_texts(spark):
    rng = random.Random(12)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c = draw(200), draw(200), draw(200)
    near = [*a[:100], "changed", *a[101:]]
    rows = [(3, near), (5, a), (5, b), (7, c), (7, [*c[:50], "other", *c[51:]]), (None, a), (None, draw(9))]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string")
    left = sorted((r.doc_id or 0, r.text) for r in nearcopies.keep_one(docs).collect())
    # b is no copy of what its key's other row is a copy of; of 7 one text stays
    assert [k for k, _ in left] == [0, 3, 5, 7] and left[2][1] == " ".join(b) and left[3][1].startswith(c[0])


def test_two_runs_in_one_session(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * 30, "en", "s", 10) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    packed, copies = corpus_pipeline.packed(spark, docs, str(tmp_path)), corpus_pipeline.near_copies(spark, docs, str(tmp_path))
    corpus_pipeline.private_data(spark, docs, str(tmp_path)).count()
    assert packed.count() == 20 and copies.count() <= 20


def test_bitmaps_never_differ_more_than_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        m, n, both = (int(rng.integers(0, x)) for x in (2000, 300, 900))
        x = rng.integers(-(1 << 63), 1 << 63, m + n + both)
        a, b = np.unique(x[: m + both]), np.unique(x[m:])
        assert nearcopies.differing(nearcopies.bitmap(a), nearcopies.bitmap(b)) <= len(np.setxor1d(a, b))


def test_recall_by_bands_of_similarity(spark):
    """All links of scattered changes are found, from the bound on."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for k in range(600):
        text = rng.choices(words, k=rng.randrange(120, 500))
        other = list(text)
        for at in rng.sample(range(len(text)), max(1, len(text) * (k % 4 + 1) // 180)):
            other[at] = "changed"
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found, bands = Counter(), Counter()
    for k in range(600):
        a, b = shingles(rows[2 * k][1]), shingles(rows[2 * k + 1][1])
        same = len(a & b) / len(a | b)
        if same >= 0.8:
            band = int((same - 0.8) * 40)  # steps of 0.025
            bands[band] += 1
            found[band] += got[2 * k] == got[2 * k + 1] == 2 * k
        else:
            assert got[2 * k + 1] == 2 * k + 1
    assert bands[0] >= 20 and found == bands


def test_near_copies_among_many_texts_of_one_template(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    template = rng.choices(words, k=100)
    rows = []
    for i in range(400):  # no two similar to each other, all of one template
        rows.append(template + rng.choices(words, k=14))
    for i in range(0, 400, 4):  # but these have a near copy
        at = rng.randrange(20, 90)
        rows.append([*rows[i][:at], "changed", *rows[i][at + 1 :]])
    rng.shuffle(rows)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    want = families(rows)
    assert len(set(want.values())) == 400
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
