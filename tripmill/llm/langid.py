"""Language identification by multilingual mixture inference.

A document is a mixture of languages: each of its words comes from one
language, and a word's likelihood under a language is that of its character
n-grams. Expectation-maximisation estimates the proportions; the set of
languages is chosen by penalised likelihood.

The model is a table of languages by hashed n-grams, so its size is bounded
whatever the corpus; it is counted on a bounded sample of labelled rows.
Prediction is one narrow pass over whole texts.

How well the learned languages explain a document at all is said by its odds
against letters drawn at random: texts in other scripts, or of keyboard noise,
have odds below 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.llm.common import small_batches, tidy

#: Labelled documents to learn from, of each language (about, by a hash of key and text).
SAMPLE_DOCS = 1500
#: Languages to learn at most, the most frequent ones; each takes 128 KiB of the model.
MOST_LANGUAGES = 1000
#: Letters of the alphabet from which random text is drawn.
ALPHABET = 30
#: log2 of the number of n-gram buckets.
BITS = 15
ORDERS = 4
#: A word's log likelihood counts by this factor: its n-grams overlap.
TEMPER = 0.5
#: Characters that are scored at a time, and scores (characters by languages) that are held at a time.
SLICE = 400_000
HELD = 1 << 25


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of lower-case texts.

    Returns buckets (orders x positions; 2^BITS where there is no n-gram), the
    position where each word starts, and the text each word is in. A word is a
    run of letters; a mark stands before and after it, and n-grams do not reach
    past the marks.
    """
    joined = "\n" + "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # one mark after each word
    at = np.flatnonzero(keep)
    z = np.where(letter, codes, 0)[at].astype("u8")
    marks = z == 0
    starts = np.flatnonzero(marks[:-1] & ~marks[1:]) if len(z) > 1 else np.zeros(0, "i8")
    ends = np.cumsum([len(t) + 1 for t in texts])  # the separator after each text, in joined
    doc = np.searchsorted(ends, at[starts + 1], "left") if len(starts) else starts  # by the word's first letter
    none = 1 << BITS
    out = np.full((ORDERS, len(z)), none, "i4")
    h, inside = z.copy(), marks.copy()
    for n in range(1, ORDERS + 1):
        if n > 1:
            if len(z) < n:
                break
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + z[n - 1 :]
            inside = np.zeros(len(h), bool) if n == 2 else inside[:-1] | marks[n - 2 : len(z) - 1]
        b = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)) >> np.uint64(64 - BITS)
        out[n - 1, : len(h)] = np.where(inside, none, b)
    return out, starts, doc


def slices(text: str, many: int) -> list[str]:
    """A lower-case text in parts of up to ``many`` characters, cut at white space where there is any."""
    text = text.lower()
    out, at = [], 0
    while len(text) - at > many:
        cut = max(text.rfind(" ", at, at + many), text.rfind("\n", at, at + many))
        cut = cut if cut > at else at + many
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def groups(texts: list[str | None], many: int | None = None) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in groups of up to ``many`` characters (SLICE of them by default), with the row each part is of."""
    many = many or SLICE
    rows: list[int] = []
    parts: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        for part in slices(t, many) if t else []:
            if size + len(part) > many and rows:
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append(i)
            parts.append(part)
            size += len(part)
    if rows:
        yield rows, parts


@dataclass
class Model:
    languages: list[str]
    #: log likelihood by bucket and language
    table: np.ndarray


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Count n-grams of about ``sample_docs`` documents of each language.

    Rows with a null text or lang take no part, nor do labels beyond the
    MOST_LANGUAGES most frequent ones (ties by name). The sample is by a hash of the
    key and the text, so it is the same in every run. What reaches the driver
    is a count for each language and bucket.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    known = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGUAGES).collect()}
    if not known:
        return Model([], np.zeros(((1 << BITS) + 1, 0), "f4"))
    languages = sorted(known)
    share = F.create_map(*[x for l in languages for x in (F.lit(l), F.lit(min(1.0, sample_docs / known[l])))])
    drawn = rows.where(F.pmod(F.xxhash64("k", "t", F.lit("sample")), F.lit(1_000_000)) < share[F.col("l")] * 1_000_000)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            of = batch.column(0).to_pylist()
            for rows, parts in groups(batch.column(1).to_pylist()):
                for i, part in zip(rows, parts):
                    found = ngrams([part])[0]
                    sums[of[i]] = sums.get(of[i], 0) + np.bincount(found.ravel(), minlength=(1 << BITS) + 1)[:-1]
        for l, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["l", "bucket", "n"])

    counted = drawn.select("l", "t").mapInArrow(count, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((1 << BITS, len(languages)))
    table[counted["bucket"].to_numpy(int), counted["l"].map({l: i for i, l in enumerate(languages)}).to_numpy(int)] = counted["n"].to_numpy(float)
    used = (table.sum(1) > 0).sum() + 1
    table = TEMPER * np.log((table + 0.1) / (table.sum(0) + 0.1 * used))
    return Model(languages, np.vstack([table, np.zeros(len(languages))]).astype("f4"))  # the last row: no n-gram


def mixtures(scores: np.ndarray, starts: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages in each document, and how many were kept.

    scores: log likelihoods, words by languages; starts: each document's first
    word (no document is empty).
    """
    words, many = scores.shape
    size = np.diff(np.append(starts, words))
    doc = np.repeat(np.arange(len(starts)), size)
    like = np.exp(scores - scores.max(1, keepdims=True))

    def em(pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(rounds):
            part = like * pi[doc]
            part /= part.sum(1, keepdims=True) + 1e-30
            pi = np.add.reduceat(part, starts, axis=0) / size[:, None]
        return pi, np.add.reduceat(np.log((like * pi[doc]).sum(1) + 1e-30), starts)

    return _likeliest(em, size, many, rounds)


def mixture_of(parts: Callable[[], Iterator[np.ndarray]], rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """The same of one document whose scores come in parts, of which one is held at a time.

    parts: gives the scores anew each time it is called.
    """
    shapes = [x.shape for x in parts()]
    size, many = np.array([sum(n for n, _ in shapes)]), shapes[0][1]

    def em(pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for at in range(rounds + 1):
            sums, fit_ = np.zeros((1, many)), np.zeros(1)
            for scores in parts():
                like = np.exp(scores - scores.max(1, keepdims=True)) * pi
                total = like.sum(1, keepdims=True) + 1e-30
                sums += (like / total).sum(0)
                fit_ += np.log(total).sum()
            if at < rounds:
                pi = sums / size
        return pi, fit_

    return _likeliest(em, size, many, rounds)


def _likeliest(em: Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray]], size: np.ndarray, many: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of each document: the first k languages by proportion for the k with the least -2 log L + 2 k log n.

    As log L is at most 0, no document gains by a k of which the second term alone
    is no less; the search ends when that holds for all, and a document's result
    is its own.
    """
    full, _ = em(np.full((len(size), many), 1 / many), rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    best, least, kept = None, None, None
    for k in range(1, many + 1):
        can = best is None or 2 * k * np.log(size + 1) < least
        if not np.any(can):
            break
        allowed = np.zeros_like(full)
        np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
        pi = np.maximum(full, 1e-6) * allowed
        pi, fit_ = em(pi / pi.sum(1, keepdims=True), 0 if k == 1 else 2)
        cost = -2 * fit_ + 2 * k * np.log(size + 1)
        if best is None:
            best, least, kept = pi, cost, np.ones(len(size), int)
            continue
        gains = can & (cost < least)
        best[gains], least[gains], kept[gains] = pi[gains], cost[gains], k
    return best, kept


def word_scores(parts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihoods of all words, words by languages; those of random letters; and the part each word is in."""
    buckets, starts, doc = ngrams(parts)
    if not len(starts):
        return np.zeros((0, table.shape[1]), "f4"), np.zeros(0), doc
    total = table[buckets[0]]
    for b in buckets[1:]:
        total += table[b]
    letters = sum((b != 1 << BITS) * n for n, b in enumerate(buckets, 1))
    return np.add.reduceat(total, starts, axis=0), -TEMPER * np.log(ALPHABET) * np.add.reduceat(letters, starts), doc


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """lang_pred, score, n_langs, langs (proportions), odds and ``row`` of every row.

    ``und`` with score 0 and no odds where the text is null or has no letter, or
    nothing was learned. odds: mean log odds of a word against random letters.
    Texts of more than HELD characters by languages are scored in parts, anew in each
    round, so a task's memory does not grow with a text's words.
    Rows are never joined or merged: equal keys stay separate. row is a struct
    of the columns in ``keep``, of all by default, so any names are free.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # languages x 2^BITS floats, of at most MOST_LANGUAGES
    row = F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]).alias("row")
    source = docs.select(row, F.col(f"`{text}`").alias("text"))
    schema = StructType.fromDDL("lang_pred string, score double, n_langs int, langs map<string,double>, odds double").add(source.schema["row"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value

        held_chars = max(1, HELD // max(1, len(m.languages)))
        slice_chars = min(SLICE, held_chars)

        def scored(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            """Scores, scores of random letters and rows of words, whole texts together."""
            held, last = [], None
            for rows, parts in groups(texts, slice_chars):
                scores, random, part = word_scores(parts, m.table)
                if held and rows[0] != last:
                    yield tuple(map(np.concatenate, zip(*held)))
                    held = []
                held.append((scores, random, np.asarray(rows)[part]))
                last = rows[-1]
            if held:
                yield tuple(map(np.concatenate, zip(*held)))

        for batch in batches:
            label: list = ["und"] * batch.num_rows
            odds: list = [None] * batch.num_rows
            score = np.zeros(batch.num_rows)
            count = np.zeros(batch.num_rows, "i4")
            parts: list = [[] for _ in label]
            texts = batch.column(1).to_pylist() if m.languages else []
            long = [i for i, t in enumerate(texts) if t and len(t) > held_chars]
            for i in long:
                cut, texts[i] = slices(texts[i], slice_chars), None

                def word_parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                    return (x[:2] for x in (word_scores([c], m.table) for c in cut) if len(x[0]))

                gain, words = 0.0, 0
                for scores, random in word_parts():
                    gain, words = gain + float((scores.max(1) - random).sum()), words + len(scores)
                if words:
                    pi, k = mixture_of(lambda: (x for x, _ in word_parts()))
                    label[i], odds[i] = m.languages[pi[0].argmax()], gain / words
                    score[i], count[i] = np.clip(pi[0].max(), 0, 1), k[0]
                    parts[i] = [(m.languages[l], float(pi[0, l])) for l in np.flatnonzero(pi[0] > 0)]
            for scores, random, of in scored(texts):
                if not len(of):
                    continue
                rows, starts = np.unique(of, return_index=True)
                pi, k = mixtures(scores, starts)
                first = pi.argmax(1)
                score[rows], count[rows] = np.clip(pi[np.arange(len(rows)), first], 0, 1), k
                gain = np.add.reduceat(scores.max(1) - random, starts) / np.diff(np.append(starts, len(of)))
                for j, i in enumerate(rows):
                    label[i], odds[i] = m.languages[first[j]], float(gain[j])
                    parts[i] = [(m.languages[l], float(pi[j, l])) for l in np.flatnonzero(pi[j] > 0)]
            columns = [pa.array(label, pa.string()), pa.array(score), pa.array(count), pa.array(parts, pa.map_(pa.string(), pa.float64())), pa.array(odds, pa.float64()), batch.column(0)]
            yield pa.RecordBatch.from_arrays(columns, ["lang_pred", "score", "n_langs", "langs", "odds", "row"])

    return source.mapInArrow(run, schema)
