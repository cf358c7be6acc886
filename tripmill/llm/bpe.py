"""BPE encoding and decoding with a tokenization automaton.

The merges of a vocabulary are compiled into a deterministic automaton whose
arcs are labelled with tokens and whose accepted paths are exactly the
tokenizations that BPE makes. It starts as one state with a loop for each base
symbol. The gadget of merge (u, v), applied in rank order,

* gives the label u a state of its own, a copy of the state it led to without
  the arc v, and
* adds an arc uv wherever an arc u could be followed by v, leading to where v
  led.

A state is thus named by the label that enters it. The state of uv starts as a
copy of v's, and the arc uv is copied from the arcs u; so what a gadget removes
is inherited by all states and arcs that are copied later. Number the states such
that each is followed by its copies, latest first, and theirs, and the labels in
the same way: the heirs of u's state after a certain rank are then a range of
states, those of the arc v a range of labels, and a gadget removes one rectangle
from the table. ``_compile`` puts the rectangles together, state by state, as
sorted ranges of labels that have no arc: the whole table, for some 10^9 pairs
of state and label, in a few megabytes.

Encoding walks words left to right, many at a time. Each beginning of a word has
one tokenization, so each place is entered by one label, and the transition table
says which labels lead on from there. Nothing is taken back. Decoding emits the
arcs' labels.
Normalisation and pre-splitting follow the vocabulary file.

Vocabulary files must have the splitting pattern that is fixed below, one merge
for each token, and merges after those of their parts; others raise an error.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tripmill.llm.common import CACHES, small_batches

#: str.split() also splits at these four, which the vocabulary's white space lacks.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Unicode white space, as the pattern \s of the vocabulary's splitter has it.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Distinct words whose codes a worker remembers, twice.
MEMO = 320_000
#: Characters of texts whose words are encoded together.
CHUNK = 500_000
#: Nodes of the trie that have a table of all symbols, a kilobyte each; the first in order of depth.
WIDE = 20_000
#: log2 of the transitions whose answers are remembered, 8 bytes each.
ANSWERS = 20


class Automaton:
    """The tokenization automaton of a word-end BPE vocabulary file.

    >>> a = Automaton(path)
    >>> ids, counts = a.encode(["hello", "you"])
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        spec = json.loads(text)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.label: list[str] = [""] * size
        for s, i in self.ids.items():
            self.label[i] = s
        for s, i in self.special.items():
            self.label[i] = s
        # all that the library does here: normalisation and pre-splitting of texts that are not plain
        self._around = json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []})
        if _PATTERN not in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\"):
            raise ValueError("the vocabulary's pattern is not the one that texts are split by here")
        self._cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.size = size
        merges = [merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"]]
        self._spell()
        self._widen()
        self._compile(np.array([(self.ids[u], self.ids[v], self.ids[u + v]) for u, v in merges], "i8").reshape(-1, 3))

    def __getstate__(self) -> dict:
        """What is broadcast: neither what the library holds nor what is quickly made anew."""
        return {k: v for k, v in self.__dict__.items() if k not in ("library", "wide", "answers")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._widen()
        self.answers = np.full(1 << ANSWERS, -1, "i8")

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self._around)

    def _compile(self, merges: np.ndarray) -> None:
        """Apply the gadgets (u, v, uv) in rank order; see the module's text."""
        size, rank = self.size, np.arange(1, len(merges) + 1)
        u, v, uv = merges.T
        born = np.zeros(size, "i8")
        born[uv] = rank
        if len(np.unique(uv)) < len(uv) or np.any(born[u] >= rank) or np.any(born[v] >= rank):
            raise ValueError("the vocabulary has two merges for a token, or a merge before those of its parts")
        # states are copied from that of the right part, arcs from that of the left part
        self.state, state_from, state_to = _heirs(size, uv, v, born, u, rank)
        self.arc_, arc_from, arc_to = _heirs(size, uv, u, born, v, rank - 1)  # in a run of one symbol, the first two are joined first
        # a rectangle of states and labels for each gadget: one range of labels for each of its states
        high = state_to - state_from
        row = np.repeat(state_from - np.cumsum(high) + high, high) + np.arange(high.sum())
        order = np.lexsort((-np.repeat(arc_to, high), np.repeat(arc_from, high), row))
        row, first, last = row[order], np.repeat(arc_from, high)[order], np.repeat(arc_to, high)[order]
        # ranges are nested or apart: what starts before the end of one is in it
        reach = np.maximum.accumulate(row * (size + 1) + last)
        outer = np.ones(len(row), bool)
        outer[1:] = row[1:] * (size + 1) + first[1:] >= reach[:-1]
        row, first, last = row[outer], first[outer], last[outer]
        self.first, self.last = row * (size + 1) + first, row * (size + 1) + last
        self.answers = np.full(1 << ANSWERS, -1, "i8")

    def arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether the states that labels ``states`` enter have arcs ``tokens``."""
        place = self.state[states] * (self.size + 1) + self.arc_[tokens]
        # pairs recur in many words: answers stand in a table by a hash, a newer one in the place of an older
        slot = (place.astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - ANSWERS)
        known = self.answers[slot]
        new = np.flatnonzero(known >> 1 != place)
        if len(new):
            asked = place[new]
            at = np.searchsorted(self.first, asked, "right") - 1
            known[new] = asked << 1 | ((at < 0) | (asked >= self.last[at]) if len(self.first) else True)
            self.answers[slot[new]] = known[new]
        return (known & 1).astype(bool)

    def _spell(self) -> None:
        """A trie of the labels: sorted (node, symbol) pairs, where they lead, and the labels that end there.

        Nodes are numbered by depth, so those that places are at after as many
        steps are a range. Symbols are numbered from 1; 0 is one that no label has.
        """
        nodes: dict[str, int] = {"": 0}
        edges: list[tuple[int, int, int]] = []
        inside, last = [-1], [-1]
        for text, token in self.ids.items():
            ends = bool(self.end) and text.endswith(self.end) and text != self.end
            text = text[: -len(self.end)] if ends else text
            for i in range(1, len(text) + 1):
                if text[:i] not in nodes:
                    edges.append((nodes[text[: i - 1]], ord(text[i - 1]), len(nodes)))
                    nodes[text[:i]] = len(nodes)
                    inside.append(-1)
                    last.append(-1)
            for to in [last] if ends else [inside] if self.end else [inside, last]:
                to[nodes[text]] = token
        deep = np.fromiter(map(len, nodes), "i4", len(nodes))  # nodes stand in the order of their numbers
        self.level = np.concatenate([[0], np.cumsum(np.bincount(deep))])
        number = np.empty(len(nodes), "i4")
        number[np.argsort(deep, kind="stable")] = np.arange(len(nodes), dtype="i4")
        table = np.array(edges, "i8").reshape(-1, 3)
        alphabet = np.unique(table[:, 1])
        self.symbol = np.zeros(int(alphabet.max(initial=0)) + 2, "i4")  # the last one stands for all beyond
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1)
        shown = np.array([ord(_BYTES.get(x, chr(x))) for x in range(256)])
        self.byte = self.symbol[np.minimum(shown, len(self.symbol) - 1)]
        self.symbols = len(alphabet) + 1
        key = number[table[:, 0]].astype("i8") * self.symbols + self.symbol[table[:, 1]]
        order = np.argsort(key)
        self.edge, self.leads = key[order], number[table[order, 2]]
        self.inside, self.at_end = (np.array(x, "i4")[np.argsort(number)] for x in (inside, last))
        self.length = np.array([len(x) for x in self.label])
        if self.end:
            self.length -= np.array([len(self.end) if x.endswith(self.end) and x != self.end else 0 for x in self.label])

    def _widen(self) -> None:
        """Where the first WIDE nodes lead by each symbol, -1 for nowhere."""
        nodes = min(WIDE, len(self.inside))
        self.wide = np.full(nodes * self.symbols, -1, "i4")
        upto = np.searchsorted(self.edge, nodes * self.symbols)
        self.wide[self.edge[:upto]] = self.leads[:upto]

    def _step(self, node: np.ndarray, symbol: np.ndarray, depth: int) -> np.ndarray:
        """Where nodes of one depth lead, -1 for nowhere."""
        key = node.astype("i8") * self.symbols + symbol
        first, last = self.level[depth : depth + 2] if depth + 1 < len(self.level) else (0, 0)
        if last * self.symbols <= len(self.wide):
            return self.wide[key]
        a, b = np.searchsorted(self.edge, [first * self.symbols, last * self.symbols])
        edge = self.edge[a:b]
        if not len(edge):
            return np.full(len(key), -1, "i4")
        at = np.minimum(np.searchsorted(edge, key), len(edge) - 1)
        return np.where(edge[at] == key, self.leads[a:b][at], -1)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-split words (in the vocabulary's byte alphabet, none empty), and how many each word has."""
        symbols = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        symbols = self.symbol[np.minimum(symbols, len(self.symbol) - 1)]
        return self._walk(symbols, np.fromiter(map(len, words), "i4", len(words)))

    def encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words as they stand in texts: their UTF-8 bytes are the symbols."""
        size = np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in words), "i4", len(words))
        return self._walk(self.byte[np.frombuffer("".join(words).encode(), "u1")], size)

    def _walk(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words are walked at once: first the trie tells which labels stand at
        which places, then one place of all words after the other is entered.
        """
        end = np.cumsum(size, dtype="i4")
        word = np.repeat(np.arange(len(size), dtype="i4"), size)
        found = []
        place, depth = np.arange(len(symbols), dtype="i4"), 0
        node, left = np.zeros(len(symbols), "i4"), end[word] - place
        while len(place):
            node = self._step(node, symbols[place + depth], depth)
            some = np.flatnonzero(node >= 0)
            place, node, left = place[some], node[some], left[some]
            depth += 1
            whole = left == depth
            token = np.where(whole, self.at_end[node], self.inside[node])
            here = np.flatnonzero(token >= 0)
            found.append(np.stack([place[here], np.full(len(here), depth, "i4"), token[here]]))
            on = np.flatnonzero(~whole)
            place, node, left = place[on], node[on], left[on]
        place, depth, token = np.concatenate(found, 1) if found else np.zeros((3, 0), "i4")
        # a word has one more place than symbols, so a place's number grows by that of its word
        step = place - (end - size)[word[place]]
        order = np.argsort(step.astype("u2") if step.max(initial=0) < 1 << 16 else step, kind="stable")  # short ones by digits
        step, place, depth, token = step[order], (place + word[place])[order], depth[order], token[order]
        entered = np.full(len(symbols) + len(size), -1, "i4")
        for a, b in zip(*(np.searchsorted(step, np.arange(step[-1] + 1 if len(step) else 0), side) for side in ("left", "right"))):
            p, d, t = place[a:b], depth[a:b], token[a:b]
            if a:
                by = entered[p]
                on = by >= 0
                p, d, t, by = p[on], d[on], t[on], by[on]
                on = self.arcs(by, t)
                p, d, t = p[on], d[on], t[on]
            entered[p + d] = t
        # back from each word's end
        now, of, path = end + np.arange(len(size)), np.arange(len(size)), []
        first = now - size
        while len(of):
            token = entered[now]
            if token.min() < 0:
                raise ValueError(f"no tokenization of the word at place {of[token.argmin()]}")
            path.append((of, token))
            now = now - self.length[token]
            left = now > first[of]
            now, of = now[left], of[left]
        count = np.bincount(np.concatenate([x for x, _ in path]), minlength=len(size)) if path else np.zeros(len(size), "i8")
        ends = np.cumsum(count)
        ids = np.empty(ends[-1] if len(ends) else 0, "i8")
        for back, (of, token) in enumerate(path, 1):
            ids[ends[of] - back] = token
        return ids, count

    def decode(self, ids: list[int]) -> str:
        """Labels of the arcs, as the library joins them when the file names no decoder."""
        return " ".join(self.label[i] for i in ids)

    def piece(self, text: str) -> list[int]:
        """Ids of a piece of text without white space in it, split as the library does."""
        out: list[int] = []
        parts = self._cut.split(text) if self._cut and "<|" in text else [text]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal, split = self.library.normalizer, self.library.pre_tokenizer
                part = normal.normalize_str(part) if normal else part
                words = [word for word, _ in split.pre_tokenize_str(part)] if split else [part]
                out += self.encode(words)[0].tolist() if words else []
        return out


def _heirs(size: int, made: np.ndarray, of: np.ndarray, born: np.ndarray, asked: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all labels such that copies follow what they are copied from, latest first; and ranges of heirs.

    Label ``made[i]`` is copied from ``of[i]``, at rank born. The heirs of
    ``asked[i]`` are itself and what was copied from it after rank ``after[i]``,
    with all copies of those: the range from its number to the second result.
    """
    order = made[np.argsort(-born[made], kind="stable")]  # latest first
    parent = np.full(size, -1, "i8")
    parent[made] = of
    weight = np.ones(size, "i8")  # of a label with all its heirs
    for x in order.tolist():  # copies come later than what they are copied from
        weight[parent[x]] += weight[x]
    number = np.full(size, -1, "i8")
    roots = np.flatnonzero(parent < 0)
    number[roots] = np.cumsum(weight[roots]) - weight[roots]
    # before a copy stand its source and the source's later copies, with their heirs
    by_source = order[np.argsort(parent[order], kind="stable")]
    source = parent[by_source]
    total = np.cumsum(weight[by_source])
    head = np.searchsorted(source, source)
    before = total - weight[by_source] - np.where(head > 0, total[head - 1], 0)
    shift = np.zeros(size, "i8")
    shift[by_source] = before + 1
    for x in order[::-1].tolist():
        number[x] = number[parent[x]] + shift[x]
    # the copies of ``asked`` after a rank are the first ones of its list
    key = source * (len(made) + 2) + (len(made) + 1 - born[by_source])
    upto = np.searchsorted(key, asked * (len(made) + 2) + (len(made) + 1 - after))
    start = np.searchsorted(source, asked)
    sums = np.concatenate([[0], total])
    return number, number[asked], number[asked] + 1 + sums[np.maximum(upto, start)] - sums[start]


#: Texts of these characters alone are split here; all others by the library.
_PLAIN = re.compile("[\t-\r -~\xa1\xab\xbb\xbf\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: The vocabulary file's pattern, for those characters and in lower case.
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-/:-@\\[-`{-~\xa1\xab\xbb\xbf]+")
#: What the plain path assumes of a vocabulary file.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Byte -> the character that stands for it in byte-level vocabularies: printable
#: ones for themselves, the others in order from U+0100 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_HIDDEN = [b for b in range(256) if b not in set(_SHOWN)]
_BYTES = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
#: Marks a memo's key that is a piece of text, not a pre-split word.
_PIECE = "\0"


def pieces(text: str) -> list[str]:
    """Memo keys of a text: its pre-split words, or its parts between white space."""
    if _PLAIN.fullmatch(text) and "<|" not in text:
        return _WORDS.findall(text.lower())
    parts = [x for x in _SPACE.split(text) if x] if _SEPARATORS.search(text) else text.split()
    return [_PIECE + x for x in parts]


class Memo(dict):
    """key of ``pieces`` -> what ``make`` gives for its ids.

    ``make`` takes the ids of many keys, one after the other, and where those of
    each begin and end. Two generations of at most MEMO entries: what is asked for
    again moves to the new one, the rest is forgotten, so memory is bounded and
    frequent words stay.
    """

    def __init__(self, automaton: Automaton, make: Callable[[np.ndarray, list[int], list[int]], list]) -> None:
        super().__init__()
        self.automaton, self.make = automaton, make
        self.old: dict = {}

    def learn(self, keys: set[str]) -> None:
        """Encode what is not known yet, all words together."""
        old = self.old
        new = [k for k in keys if k not in self and k not in old]  # a set's difference would run over all that is known
        words = [k for k in new if k[0] != _PIECE]
        parts = [k for k in new if k[0] == _PIECE] if len(words) < len(new) else []
        ids, count = self.automaton.encode_plain(words)
        more = [self.automaton.piece(k[1:]) for k in parts]
        if more:
            ids = np.concatenate([ids, *[np.array(x, "i8") for x in more]])
            count = np.concatenate([count, [len(x) for x in more]])
        ends = np.cumsum(count).tolist()
        self.update(zip(words + parts, self.make(ids, [0, *ends], ends)))

    def __missing__(self, key: str):
        self[key] = value = self.old[key]
        return value

    def values_of(self, texts: list[str | None]) -> Iterator[list]:
        """What the keys of each text stand for."""
        for at in _chunks(texts):
            keys = [pieces(t) if t else [] for t in texts[at]]
            every = set().union(*keys)
            if len(self) + len(every) > MEMO:
                self.old = dict(self)
                self.clear()
            self.learn(every)
            for k in keys:
                yield list(map(self.__getitem__, k))


def _chunks(texts: list[str | None]) -> Iterator[slice]:
    """Slices of about CHUNK characters, of one text at least."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


_MADE: dict[tuple, Memo] = {}
CACHES.append(_MADE)


def _as_bytes(ids: np.ndarray, starts: list[int], ends: list[int]) -> list[bytes]:
    raw = ids.astype("<u4").tobytes()
    return [raw[4 * a : 4 * b] for a, b in zip(starts, ends)]


def _as_texts(automaton: Automaton) -> Callable[[np.ndarray, list[int], list[int]], list]:
    names = list(map(str, range(automaton.size)))

    def make(ids: np.ndarray, starts: list[int], ends: list[int]) -> list[tuple[str, str]]:
        every = ids.tolist()
        return [(" ".join([names[i] for i in every[a:b]]), automaton.decode(every[a:b])) for a, b in zip(starts, ends)]

    return make


def shared(spark: SparkSession, path: str) -> Broadcast:
    """The compiled automaton, for all workers: some 20 MB, given by the vocabulary and not by the data."""
    return spark.sparkContext.broadcast(Automaton(path))


def memo(path: str, kind: str, automaton: Broadcast | None = None) -> Memo:
    """One memo for each vocabulary and kind in a Python worker; the automaton is compiled here if none was broadcast."""
    if (path, kind) not in _MADE:
        a = automaton.value if automaton else Automaton(path)
        _MADE[path, kind] = Memo(a, _as_bytes if kind == "bytes" else _as_texts(a))
    return _MADE[path, kind]


def ids_of(texts: list[str | None], path: str, automaton: Broadcast | None = None) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers."""
    return map(b"".join, memo(path, "bytes", automaton).values_of(texts))


def codec(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", outputs: bool = False) -> DataFrame:
    """Encode and decode every text: key, n_tokens, ids_sha256, decoded_sha256.

    With ``outputs`` also ids (array of int) and decoded (string). Null texts
    count as empty (no ids, empty decoded text); rows with equal keys stay
    separate rows; other columns are left out. One narrow pass, no shuffle.
    """
    small_batches(docs.sparkSession)
    automaton = shared(docs.sparkSession, vocabulary)
    schema = f"{key} {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if outputs else "")
    kind = pa.schema([pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memo(vocabulary, "texts", automaton)
        for batch in batches:
            counts, digests, decoded, more_ids, more_text = [], [], [], [], []
            for made in known.values_of(batch.column(1).to_pylist()):
                if made:
                    ids, labels = zip(*made)
                    ids, labels = " ".join(ids), " ".join(labels)
                    counts.append(ids.count(" ") + 1)
                else:
                    ids = labels = ""
                    counts.append(0)
                digests.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(labels.encode()).hexdigest())
                if outputs:
                    more_ids.append([int(x) for x in ids.split()])
                    more_text.append(labels)
            columns = [batch.column(0), pa.array(counts, kind.field(0).type), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = [key, *kind.names]
            if outputs:
                columns += [pa.array(more_ids, pa.list_(pa.int32())), pa.array(more_text, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(key, text).mapInArrow(run, schema)
