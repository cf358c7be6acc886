"""SentencePiece BPE encoding and decoding with tables of distinct chunks.

A text gets a marker in front and one for each space. No piece of the vocabulary
has a marker after another symbol (a file that has one is refused), so no piece
crosses the place between the two, and a text is a row of marked words, each a run
of markers and what follows up to the next one, that are segmented independently.

Each slab of texts is split into its marked words, as an array of distinct ones and
one of positions. Those that the worker's table lacks are segmented, each once and
all together; then the ids are joined back by position. A table for all documents would need all positions of all words in a
shuffle, several times the text's size; a slab's table needs none, and rows that
repeat a word cost a lookup.

Words are segmented by merging, as the library does: of all neighbours whose
concatenation is a piece, the pair of the best score first, the leftmost of equal
ones. A pair of characters that no piece contains can never be inside one, so words
are cut there first. Parts of up to ``SHORT`` symbols are merged as rows of arrays,
longer ones with a heap. Characters of no piece become their bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tripmill.llm.common import CACHES, small_batches

#: What stands for a space.
MARK = "▁"
#: A run of markers and what follows.
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
#: Symbols of parts that are merged as rows of an array.
SHORT = 32
#: Parts that are merged together.
ROWS = 32_768
#: Marked words that a worker remembers, twice.
MEMO = 200_000
#: Bytes of texts whose words are segmented together.
SLAB = 4_000_000
#: A rank behind all others, where two symbols do not make a piece.
NEVER = np.iinfo("i4").max


class Pieces:
    """Segmentation of marked words by a BPE model file with byte fallback.

    >>> p = Pieces(path)
    >>> ids, counts = p.segment(["▁Hello", "▁you"])
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.label = [model.id_to_piece(i) for i in range(size)]
        kinds = [(model.is_control(i), model.is_unknown(i), model.is_byte(i)) for i in range(size)]
        self.control = {i for i, k in enumerate(kinds) if k[0]}
        self.unknown = {i for i, k in enumerate(kinds) if k[1]}
        self.byte = {i: int(self.label[i][3:5], 16) for i, k in enumerate(kinds) if k[2]}
        self.byte_id = {b: i for i, b in self.byte.items()}
        normal = [i for i, k in enumerate(kinds) if not any(k)]
        if any(model.is_unused(i) for i in normal) or len(self.byte_id) < 256:
            raise ValueError("the model has unused pieces or no byte fallback")
        odd = " a  é①ﬁ\t\n​"
        if model.normalize(odd) != MARK + odd.replace(" ", MARK):
            raise ValueError("the model normalises texts or adds no marker in front")
        if crossing := [self.label[i] for i in normal if re.search(f"[^{MARK}]{MARK}", self.label[i])]:
            raise ValueError(f"pieces cross markers: {crossing[:5]}")
        self._pairs({self.label[i]: i for i in normal}, {i: model.get_score(i) for i in normal})
        if any(self.segment([self.label[i]])[0].tolist() != [i] for i in normal[:: max(1, len(normal) // 20)] if MARK not in self.label[i][1:] and model.encode(self.label[i].replace(MARK, "", 1) if self.label[i][0] == MARK else "") == [i]):
            raise ValueError("the model is no BPE model")

    def _pairs(self, pieces: dict[str, int], score: dict[int, float]) -> None:
        """Symbols (pieces, and characters of pieces that are none) and the pairs that make a piece."""
        size = len(self.label)
        chars = sorted({c for p in pieces for c in p})
        symbol = dict(pieces)
        for c in chars:
            symbol.setdefault(c, size + len(symbol) - len(pieces))
        #: ids of each symbol
        self.ids: list[list[int]] = [[i] for i in range(size)] + [[]] * (len(symbol) - len(pieces))
        for c, s in symbol.items():
            if s >= size:
                self.ids[s] = self.bytes_of(c)
        self.of_char = np.full(0x110000, -1, "i4")
        self.of_char[[ord(c) for c in chars]] = [symbol[c] for c in chars]
        order = {s: rank for rank, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {p: order[score[i]] for p, i in pieces.items()}
        rows = [(symbol[p[:k]], symbol[p[k:]], rank[p], i) for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        table = np.array(rows, "i8").reshape(-1, 4)
        self.width = len(self.ids)
        key = table[:, 0] * self.width + table[:, 1]
        by = np.argsort(key)
        self.key, self.rank, self.made = key[by], table[by, 2].astype("i4"), table[by, 3].astype("i4")
        #: pairs of characters that some piece contains
        self.inside = np.unique(np.array([ord(a) << 21 | ord(b) for p in pieces for a, b in zip(p, p[1:])], "i8"))

    def bytes_of(self, text: str) -> list[int]:
        return [self.byte_id[b] for b in text.encode()]

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that two symbols make (NEVER if none), and its id."""
        key = left.astype("i8") * self.width + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (left >= 0) & (right >= 0), self.rank[at], NEVER), self.made[at]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of marked words, one after the other, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype("i8")
        size = np.fromiter(map(len, words), "i8", len(words))
        word = np.repeat(np.arange(len(words)), size)
        symbol = self.of_char[points]
        # cut between words, and where no piece has the two characters side by side
        cut = np.ones(len(points), bool)
        pair = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.inside, pair), len(self.inside) - 1)
        cut[1:] = (self.inside[at] != pair) | (word[1:] != word[:-1])
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(points)))
        merged = np.full(len(points), -1, "i4")  # symbols at the place where they begin
        one = length == 1
        merged[start[one]] = symbol[start[one]]
        for low, high in ((1, 8), (8, 16), (16, SHORT)):
            rows = np.flatnonzero((length > low) & (length <= high))
            for block in (rows[i : i + ROWS] for i in range(0, len(rows), ROWS)):
                self._merge_rows(symbol, start[block], length[block], merged)
        for i in np.flatnonzero(length > SHORT).tolist():
            a, b = int(start[i]), int(start[i] + length[i])
            merged[a:b] = self._merge_long(symbol[a:b].tolist())
        # symbols to ids: most are one id, characters of no piece are bytes
        live = merged >= 0
        live[start[one]] = True  # unknown characters are parts of their own
        place = np.flatnonzero(live)
        found = merged[place]
        plain = (found >= 0) & (found < len(self.label))
        if plain.all():
            return found, np.bincount(word[place], minlength=len(words))
        others = np.flatnonzero(~plain)
        many = [self.ids[s] if s >= 0 else self.bytes_of(chr(c)) for s, c in zip(found[others].tolist(), points[place[others]].tolist())]
        count = np.ones(len(found), "i8")
        count[others] = list(map(len, many))
        end = np.cumsum(count)
        ids = np.empty(int(end[-1]), "i4")
        ids[end[plain] - 1] = found[plain]
        for e, more in zip(end[others].tolist(), many):
            ids[e - len(more) : e] = more
        return ids, np.bincount(word[place], count, len(words)).astype("i8")

    def _merge_rows(self, symbol: np.ndarray, start: np.ndarray, length: np.ndarray, out: np.ndarray) -> None:
        """Merge parts, one in each row of an array, until no neighbours make a piece."""
        wide = int(length.max())
        column = np.arange(wide)
        inside = column < length[:, None]
        now = np.where(inside, symbol[np.minimum(start[:, None] + column, len(symbol) - 1)], -1)
        after = np.broadcast_to(column + 1, now.shape).copy()  # the next live column
        before = np.broadcast_to(column - 1, now.shape).copy()
        rank = np.full(now.shape, NEVER, "i4")
        made = np.zeros(now.shape, "i4")
        rank[:, :-1], made[:, :-1] = self._look(now[:, :-1], now[:, 1:])
        row = np.arange(len(now))
        while len(row):
            best = rank[row].argmin(1)  # the first of equal ones
            some = rank[row, best] < NEVER
            row, best = row[some], best[some]
            gone = after[row, best]
            now[row, best] = made[row, best]
            now[row, gone] = -1
            rank[row, gone] = NEVER
            behind = after[row, gone]
            after[row, best] = behind
            r = behind < wide
            before[row[r], behind[r]] = best[r]
            right = np.where(r, now[row, np.minimum(behind, wide - 1)], -1)
            rank[row, best], made[row, best] = self._look(now[row, best], right)
            ahead = before[row, best]
            r = ahead >= 0
            rank[row[r], ahead[r]], made[row[r], ahead[r]] = self._look(now[row[r], ahead[r]], now[row[r], best[r]])
        live = now >= 0
        at = (start[:, None] + column)[live]
        out[at] = now[live]

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap, for one part of any length; -1 where a symbol has gone."""
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        first = np.array(symbols, "i8")
        ranks, made = self._look(first[:-1], first[1:])
        heap = [(r, i, m, symbols[i], symbols[i + 1]) for i, (r, m) in enumerate(zip(ranks.tolist(), made.tolist())) if r < NEVER]
        heapq.heapify(heap)
        if not hasattr(self, "_known"):
            self._known = dict(zip(self.key.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        while heap:
            _, i, m, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= size or symbols[j] != right:
                continue  # one of the two has been merged since
            k = after[j]
            symbols[i], symbols[j], after[i] = m, -1, k
            if k < size:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < size and (new := self._known.get(symbols[a] * self.width + symbols[b])):
                    heapq.heappush(heap, (new[0], a, new[1], symbols[a], symbols[b]))
        return symbols

    def spell(self, ids: list[int]) -> str:
        """The characters of ids: bytes are put together (a wrong one is U+FFFD), control ids are silent."""
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.byte:
                run.append(self.byte[i])
                continue
            while run:
                try:
                    out.append(run.decode())
                    run.clear()
                except UnicodeDecodeError as error:
                    out.append(run[: error.start].decode() + "�")
                    del run[: error.start + 1]
            if i >= 0 and i not in self.control:
                out.append(" ⁇ " if i in self.unknown else self.label[i])
        return "".join(out).replace(MARK, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the marker in front goes."""
        text = self.spell(ids)
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and self.label[first].startswith(MARK) else text


def marked_words(text: str | None) -> list[str]:
    """The marked words of a text without their first marker, none if it is empty or null."""
    return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))] if text else []


def split(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
    """``marked_words`` of each text (none null), and the place of each text among the lists.

    Texts without a doubled, leading or trailing marker are split as arrays.
    """
    texts = pc.replace_substring(texts, MARK, " ")
    tests = [pc.match_substring(texts, "  "), pc.starts_with(texts, " "), pc.ends_with(texts, " "), pc.equal(pc.binary_length(texts), 0)]
    odd = np.flatnonzero(np.any([t.to_numpy(zero_copy_only=False) for t in tests], axis=0))
    plain = np.setdiff1d(np.arange(len(texts)), odd)
    lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
    more = pa.array([marked_words(t) for t in texts.take(pa.array(odd)).to_pylist()], lists.type)
    place = np.empty(len(texts), "i8")
    place[np.append(plain, odd)] = np.arange(len(texts))
    return pa.concat_arrays([lists, more]), place


class ChunkTable:
    """marked word (without its first marker) -> its ids as text, and what they decode to.

    Two generations of at most MEMO words, so memory is bounded and frequent
    words stay.
    """

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.ids: dict[str, str] = {}
        self.text: dict[str, str] = {}
        self.old: tuple[dict, dict] = ({}, {})
        size = len(self.pieces.label)
        self._names = pa.array([str(i) for i in range(size)])
        self._shown = pa.array([s.replace(MARK, " ") for s in self.pieces.label])
        self._is_byte = np.isin(np.arange(size), list(self.pieces.byte))

    def add(self, words: set[str]) -> None:
        """Make the table have these words; what it lacks is segmented together."""
        lacks = words.difference(self.ids)
        if len(self.ids) + len(lacks) > MEMO and self.ids:
            self.old, self.ids, self.text = (self.ids, self.text), {}, {}
            lacks = words
        ids, text = self.old
        for w in lacks.intersection(ids):
            self.ids[w], self.text[w] = ids[w], text[w]
        new = list(lacks.difference(ids))
        if not new:
            return
        flat, count = self.pieces.segment([MARK + w for w in new])
        ends = np.cumsum(count)
        offsets = pa.array(np.append(0, ends), pa.int32())
        for known, strings, between in ((self.ids, self._names, ","), (self.text, self._shown, "")):
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, strings.take(pa.array(flat))), between)
            known.update(zip(new, joined.to_pylist()))
        # bytes are characters only together
        for at in np.unique(np.searchsorted(ends, np.flatnonzero(self._is_byte[flat]), "right")).tolist():
            self.text[new[at]] = self.pieces.spell(flat[ends[at] - count[at] : ends[at]].tolist())

    def codes(self, texts: pa.Array) -> Iterator[tuple[int, pa.Buffer, pa.Buffer]]:
        """Number of ids, ids joined by commas, and decoded text of each text."""
        for slab in _slabs(pc.fill_null(texts.cast(pa.large_string()), "")):
            lists, place = split(slab)
            coded = lists.flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            self.add(set(words))
            of = coded.indices
            begin = lists.offsets.to_numpy()
            count = pc.add(pc.count_substring(pa.array([self.ids[w] for w in words], pa.large_string()), ","), 1)
            total = np.append(0, np.cumsum(count.take(of).to_numpy(zero_copy_only=False)))
            made = []
            for known, between in ((self.ids, ","), (self.text, "")):
                column = pa.array([known[w] for w in words], pa.large_string()).take(of)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(begin), column), pa.scalar(between, pa.large_string()))
                made += [np.frombuffer(joined.buffers()[1], "i8"), joined.buffers()[2]]
            (at_ids, ids, at_text, text) = made
            for i in place.tolist():
                a, b = begin[i : i + 2]
                # the marker in front goes
                yield int(total[b] - total[a]), ids[at_ids[i] : at_ids[i + 1]], text[at_text[i] + (b > a) : at_text[i + 1]]


def _slabs(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts of about SLAB bytes together, one at least."""
    end = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        upto = (end[first - 1] if first else 0) + SLAB
        last = max(int(np.searchsorted(end, upto, "right")), first + 1)
        yield texts.slice(first, last - first)
        first = last


_MADE: dict[str, ChunkTable] = {}
CACHES.append(_MADE)


def chunk_table(path: str) -> ChunkTable:
    """One table for each model in a Python worker."""
    if path not in _MADE:
        _MADE[path] = ChunkTable(path)
    return _MADE[path]


def codec(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", outputs: bool = False) -> DataFrame:
    """Encode and decode every text: key, n_tokens, ids_sha256, decoded_sha256.

    With ``outputs`` also ids (array of int) and decoded (string). Null texts
    count as empty (no ids, empty decoded text); keys may be null or repeat, rows
    stay as many as they are; other columns are left out, so their names do not
    matter. One narrow pass without a shuffle: a lost executor costs its tasks.
    """
    small_batches(docs.sparkSession)
    schema = f"`{key}` {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if outputs else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in batches:
            count, digest, decoded, more_ids, more_text = [], [], [], [], []
            for n, ids, back in table.codes(batch.column(1)):
                count.append(n)
                digest.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
                if outputs:
                    more_ids.append([int(x) for x in ids.to_pybytes().split(b",")] if n else [])
                    more_text.append(back.to_pybytes().decode())
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if outputs:
                columns += [pa.array(more_ids, pa.list_(pa.int32())), pa.array(more_text, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(key, text).mapInArrow(run, schema)
