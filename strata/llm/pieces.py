"""Encoding and decoding with a sentence-piece byte-pair model, by suffix-array matching.

The distinct words of a batch that were not met before are one string of characters.  A suffix array over it
(suffixes are compared by as many characters as the longest piece has) is searched for every piece at once,
which gives each piece's range of occurrences.  The occurrences are the edges of a lattice; sorted by the
position they end at, they are relaxed from left to right.

The model merges pairs by score, so what is relaxed is not a sum of scores.  A text has exactly one sequence of
pieces in which every two neighbours are what merging makes of the two together, and every prefix of
it is that of a shorter text.  So an edge is taken if its piece is such a neighbour of the last piece before
it.  Whether two pieces are neighbours follows from undoing their merges, the latest first: they aren't if a
merge over the border would have come before.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.wordcode import UNSAFE, WordEncoder
from strata.llm.words import chunks, ragged, spread

SPACE = "▁"
MEMORY = 300_000
_U = np.uint64
_NEVER = 1 << 30


class Model:
    """The pieces of a model file and what follows from them; made once on the driver."""

    def __init__(self, file: bytes):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=file)
        n = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(n)]
        self.unknown = p.unk_id()
        other = {i for i in range(n) if p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)}
        self.bytes = np.full(256, self.unknown, np.int64)
        for i in range(n):
            if p.is_byte(i):
                self.bytes[int(self.pieces[i][3:5], 16)] = i
        self.normal = {self.pieces[i]: i for i in range(n) if i not in other}
        self.spaces = {len(t): i for t, i in self.normal.items() if t and not t.strip(SPACE)}
        self.control = {i for i in other if not p.is_byte(i)}
        # Merges are made in order of score, which is a rank's order; pieces of equal score share a rank.
        order = sorted(self.normal.values(), key=lambda i: (-p.get_score(i), i))
        self.rank: dict[int, int] = {}
        for place, i in enumerate(order):
            same = place and p.get_score(order[place - 1]) == p.get_score(i)
            self.rank[i] = self.rank[order[place - 1]] if same else place

    def merge(self, text: str) -> list[str]:
        """The symbols that merging leaves of a short text, by the rule itself: the best-scored pair
        first, of equal ones the leftmost."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = _NEVER, -1
            for k in range(len(symbols) - 1):
                r = self.rank.get(self.normal.get(symbols[k] + symbols[k + 1], -1), _NEVER)
                if r < best:
                    best, at = r, k
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols


class Lattice:
    """Arrays over pieces for matching and relaxing; what travels to the executors."""

    def __init__(self, model: Model):
        self.size = len(model.pieces)
        self.pieces = model.pieces
        self.bytes = model.bytes
        self.unknown = model.unknown
        self.control = model.control
        # Pieces of several spaces have equal scores; words that hold such runs are merged by the rule.
        usable = {t: i for t, i in model.normal.items() if SPACE + SPACE not in t}
        self.longest = max(map(len, usable))
        alphabet = sorted({c for t in usable for c in t})
        self.letters = np.array([ord(c) for c in alphabet], np.int64)
        letter = {c: k + 1 for k, c in enumerate(alphabet)}
        self.rank = np.full(self.size + 1, -1, np.int64)
        self.left = np.zeros(self.size + 1, np.int64)
        self.right = np.zeros(self.size + 1, np.int64)
        reachable, codes = [], []
        pairs, merged = [], []
        for t, i in usable.items():
            if len(t) > 1:
                self.rank[i] = model.rank[i]
                a, b = self._last_merge(model, t)
                if a is None:
                    continue
                self.left[i], self.right[i] = a, b
            reachable.append(i)
            codes.append([letter[c] for c in t])
        for t, i in usable.items():
            for k in range(1, len(t)):
                a, b = usable.get(t[:k]), usable.get(t[k:])
                if a is not None and b is not None:
                    pairs.append(a * (self.size + 1) + b)
                    merged.append(model.rank[i])
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.merged = np.array(pairs, np.int64)[order], np.array(merged, np.int64)[order]
        # Four letters to a 64-bit word; a piece is the range from its letters padded low to padded high.
        self.ids = np.array(reachable, np.int64)
        self.lengths = np.array([len(c) for c in codes], np.int64)
        words = -(-self.longest // 4)
        padded = np.zeros((len(codes), words * 4), np.int64)
        for k, c in enumerate(codes):
            padded[k, : len(c)] = c
        self.low = _packed(padded)
        high = padded.copy()
        high[np.arange(words * 4) >= self.lengths[:, None]] = 0xFFFF
        self.high = _packed(high)
        self.single = np.full(len(alphabet) + 1, self.size, np.int64)
        for c, k in letter.items():
            if c in usable:
                self.single[k] = usable[c]

    @staticmethod
    def _last_merge(model: Model, text: str):
        """The two pieces whose merge makes ``text``, or none if merging its letters doesn't end there."""
        symbols = list(text)
        while len(symbols) > 2:
            ranks = [model.rank.get(model.normal.get(a + b, -1), _NEVER) for a, b in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == _NEVER:
                return None, None
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        a, b = (model.normal.get(s) for s in symbols)
        return (a, b) if a is not None and b is not None else (None, None)

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of both pieces leaves just these two."""
        good = np.ones(len(a), bool)
        left = np.flatnonzero((a < self.size) & (b < self.size))  # a foreign letter merges with nothing
        a, b = a[left], b[left]
        limit = np.full(len(a), 2 * _NEVER)
        while len(left):
            key = a * (self.size + 1) + b
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.where(self.pairs[at] == key, self.merged[at], 3 * _NEVER)
            bad = rank < limit
            good[left[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            going = ~bad & ((ra >= 0) | (rb >= 0))
            left, a, b, ra, rb = left[going], a[going], b[going], ra[going], rb[going]
            # Undo the later merge; of equal ones, the right one, as merges go from left to right.
            undo = ra > rb
            limit = np.where(undo, ra, rb + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return good

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of pieces in ``text`` (letters from 1; 0 is foreign): begin, end, piece."""
        n = len(text)
        words = self.low.shape[1]
        padded = np.append(text, np.zeros(words * 4, np.int64)).astype(_U)
        four = np.zeros(n + words * 4 - 3, _U)
        for k in range(4):
            four = (four << _U(16)) | padded[k : k + len(four)]
        columns = [four[4 * k : 4 * k + n] for k in range(words)]
        suffixes = np.lexsort(columns[::-1])
        lo = np.zeros(len(self.ids), np.int64)
        hi = np.full(len(self.ids), n)
        for k in range(words):
            column = columns[k][suffixes]
            which = np.flatnonzero((self.lengths > 4 * k) & (hi > lo))
            a = _bound(column, lo[which], hi[which], self.low[which, k], False)
            b = _bound(column, lo[which], hi[which], self.high[which, k], True)
            lo[which], hi[which] = a, b
        many = np.maximum(hi - lo, 0)
        begin = suffixes[spread(lo, many)]
        piece, length = np.repeat(self.ids, many), np.repeat(self.lengths, many)
        return begin, begin + length, piece

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all words and how many each has; words hold no run of spaces."""
        sizes = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        if not len(text):
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.letters, text), len(self.letters) - 1)
        letters = np.where(self.letters[at] == text, at + 1, 0)
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        begin, end, piece = self.edges(letters)
        # Letters that are no piece alone stand for themselves.
        alone = np.flatnonzero(self.single[letters] == self.size)
        begin, end = np.append(begin, alone), np.append(end, alone + 1)
        piece = np.append(piece, np.full(len(alone), self.size))
        inside = word[begin] == word[np.minimum(end, len(text)) - 1]
        inside &= end <= len(text)
        begin, end, piece = begin[inside], end[inside], piece[inside]
        # Relax: all words in step, by the place in the word where edges end.
        first = (ends - sizes)[word[begin]]
        step = end - first
        order = np.lexsort((end, step))
        begin, end, piece, first, step = begin[order], end[order], piece[order], first[order], step[order]
        last = np.full(len(text) + 1, -1, np.int64)  # the piece that ends before this place
        size_of = np.zeros(len(text) + 1, np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, step[1:] != step[:-1])), len(step))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            i, j, t = begin[a:b], end[a:b], piece[a:b]
            opening = i == first[a:b]
            before = np.where(opening, self.size, last[i])
            good = opening | (last[i] >= 0)
            good[good] = self.neighbours(before[good], t[good])
            last[j[good]] = t[good]
            size_of[j[good]] = (j - i)[good]
            # A word's first place is another's last: what ends there is read before it is written again
            # only by edges of the earlier word, which began before it.
        return self._back(last, size_of, ends, sizes, text)

    def _back(self, last, size_of, ends, sizes, text) -> tuple[np.ndarray, np.ndarray]:
        """Follow the pieces from the end of each word; foreign letters become bytes."""
        at, starts = ends.copy(), ends - sizes
        word = np.flatnonzero(sizes > 0)
        at = at[word]
        places, owners = [], []
        while len(word):
            places.append(at)
            owners.append(word)
            at = at - size_of[at]
            going = at > starts[word]
            at, word = at[going], word[going]
        if not places:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        place, owner = np.concatenate(places), np.concatenate(owners)
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        ids = last[place]
        counts = np.bincount(owner, minlength=len(sizes))
        foreign = np.flatnonzero(ids == self.size)
        if len(foreign):
            parts, previous = [], 0
            for k in foreign.tolist():
                data = chr(text[place[k] - 1]).encode("utf-8", "surrogatepass")
                codes = [int(self.bytes[b]) for b in data]
                if self.unknown in codes:
                    codes = [self.unknown]
                parts += [ids[previous:k], np.array(codes)]
                counts[owner[k]] += len(codes) - 1
                previous = k + 1
            ids = np.concatenate([*parts, ids[previous:]])
        return ids, counts


def _packed(letters: np.ndarray) -> np.ndarray:
    out = np.zeros((len(letters), letters.shape[1] // 4), _U)
    for k in range(letters.shape[1]):
        out[:, k // 4] = (out[:, k // 4] << _U(16)) | letters[:, k].astype(_U)
    return out


def _bound(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, above: bool) -> np.ndarray:
    """The first place of ``column[lo:hi]`` not below ``value``, or above it; each row a binary search."""
    lo, hi = lo.copy(), hi.copy()
    going = np.flatnonzero(lo < hi)
    while len(going):
        middle = (lo[going] + hi[going]) // 2
        there = column[middle]
        below = there <= value[going] if above else there < value[going]
        lo[going] = np.where(below, middle + 1, lo[going])
        hi[going] = np.where(below, hi[going], middle)
        going = going[lo[going] < hi[going]]
    return lo


class PieceEncoder(WordEncoder):
    """Codes texts as the sentence-piece library does with this model, without begin and end pieces."""

    def __init__(self, lattice: Lattice, model: Model):
        self.lattice, self.model = lattice, model
        # A line break must be foreign, so that no piece reaches over it.
        super().__init__(MEMORY, int(lattice.bytes[10]), bare_opening=False)
        self.breaks = not any("\n" in t for t in model.normal)

    def learn(self, words: list[str], bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unsafe = np.array([w.startswith(SPACE) or not self.breaks for w in words], bool)
        texts = ["" if u else (w if b else SPACE + w) for w, b, u in zip(words, bare.tolist(), unsafe.tolist())]
        ids, sizes = self.lattice.encode(texts)
        return np.where(unsafe, UNSAFE, sizes), ids

    def whole(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        text = SPACE + text.replace(" ", SPACE)
        # Before a space that follows another character no piece goes on.
        parts, start = [], 0
        for k in range(1, len(text)):
            if text[k] == SPACE and text[k - 1] != SPACE:
                parts.append(text[start:k])
                start = k
        parts.append(text[start:])
        # All merges within a run of spaces come after those that take its last space to the word after it, so the
        # word is merged with that space, and then what is left of the run alone.
        runs = [len(p) - len(p.lstrip(SPACE)) if SPACE + SPACE in p else 1 for p in parts]
        words = [p[run - 1 :] if len(p) > run or run == 1 else "" for p, run in zip(parts, runs)]
        distinct = {word: k for k, word in enumerate(dict.fromkeys(words))}
        ids, sizes = self.lattice.encode(list(distinct))
        known = np.split(ids, np.cumsum(sizes)[:-1])
        pieces = [known[distinct[word]] for word in words]
        alone = self.model.normal.get(SPACE)
        out = []
        for word, run, own in zip(words, runs, pieces):
            if run > 1 and (not word or (len(own) and own[0] == alone)):
                own, left = own[1:], run
            else:
                left = run - 1
            if left:
                out.append(np.array(self._spaces(left), np.int64))
            out.append(own)
        return np.concatenate(out)

    def _spaces(self, run: int) -> list[int]:
        """Pieces of a run of spaces alone.

        The pieces of several spaces have one rank, so the leftmost pair that has a piece is merged first.  That is
        what a stack does: whatever lies on it has no pair, and what comes on top joins what is below while it can.
        """
        pieces = self.model.spaces
        if len({self.model.rank[i] for size, i in pieces.items() if size > 1}) > 1:
            return [pieces[len(s)] for s in self.model.merge(SPACE * run)]
        stack: list[int] = []
        for _ in range(run):
            top = 1
            while stack and stack[-1] + top in pieces:
                top += stack.pop()
            stack.append(top)
        return [pieces[size] for size in stack]


def decode(lattice: Lattice, ids: np.ndarray, first: np.ndarray) -> list[str]:
    """The texts of ragged ids: pieces one after the other, byte pieces as bytes, the first space off."""
    data, offsets = _surfaces(lattice)
    sizes = np.diff(offsets)
    total = np.append(0, np.cumsum(sizes[ids]))
    blob = data[spread(offsets[ids], sizes[ids])].tobytes()
    edges = total[first].tolist()
    out = []
    for a, b in zip(edges, edges[1:]):
        text = blob[a:b].decode("utf-8", "replace").replace(SPACE, " ")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def _surfaces(lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    if not hasattr(lattice, "surfaces"):
        byte_of = {int(i): b for b, i in enumerate(lattice.bytes) if i != lattice.unknown}
        out = []
        for i, piece in enumerate(lattice.pieces):
            if i in byte_of:
                out.append(bytes([byte_of[i]]))
            elif i == lattice.unknown:
                out.append(" ⁇ ".encode())
            else:
                out.append(b"" if i in lattice.control else piece.encode())
        lattice.surfaces = (
            np.frombuffer(b"".join(out), np.uint8),
            np.append(0, np.cumsum([len(o) for o in out])).astype(np.int64),
        )
    return lattice.surfaces


_encoders: dict[str, PieceEncoder] = {}


def _shared(docs: DataFrame, path: str):
    """The digest of the model file at ``path``, and what the executors need of it."""
    with open(path, "rb") as file:
        data = file.read()
    model = Model(data)
    # Some MB, as the model file.
    return hashlib.md5(data).hexdigest(), docs.sparkSession.sparkContext.broadcast((Lattice(model), model))


def _encoder(digest: str, shared) -> PieceEncoder:
    """The worker's only copy of a model, for encoding and decoding; ``shared`` is read for the first use only."""
    if digest not in _encoders:
        _encoders[digest] = PieceEncoder(*shared.value)
    return _encoders[digest]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_tokens`` and ``ids`` under the model file at ``model`` (on the driver).

    A null or empty text has no ids.  Repeated rows are encoded each; other columns are not read; an empty
    table gives no rows.  Nothing is shuffled.
    """
    digest, shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(digest, shared)
        for batch in chunks(batches, "text"):
            ids, lengths = encoder.encode(batch.column("text").fill_null(""))
            offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(lengths.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                ],
                names=[id_col, "n_tokens", "ids"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids array<int>")


def decode_pieces(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """All columns of ``rows`` and the text of their ids in ``text_col``; null ids give a null text.

    Bytes that are no UTF-8 become the replacement character; control pieces have no text.
    """
    digest, shared = _shared(rows, model)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _encoder(digest, shared).lattice
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(part.num_columns - 1)
                ids, first = ragged(lists)
                texts = decode(lattice, ids.astype(np.int64), first)
                nulls = np.asarray(lists.is_null())
                texts = [None if n else t for t, n in zip(texts, nulls.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string())], names=[*part.schema.names[:-1], "_text"]
                )

    packed = rows.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(names)], F.col(ids_col).alias("_ids"))
    kinds = ", ".join(f"_c{k} {rows.schema[k].dataType.simpleString()}" for k in range(len(names)))
    out = packed.mapInArrow(run, f"{kinds}, _text string")
    kept = [F.col(f"_c{k}").alias(c) for k, c in enumerate(names) if c != text_col]
    return out.select(*kept, F.col("_text").alias(text_col))


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ``n_tokens``, ``ids_crc32`` of the ids as little-endian 32-bit integers, and
    ``round_trip``: whether decoding gives the text again.

    A null text counts as empty.  Text that holds the model's own space mark comes back with a space.
    """
    digest, shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(digest, shared)
        for batch in chunks(batches, "text"):
            texts = batch.column("text").fill_null("")
            ids, lengths = encoder.encode(texts)
            first = np.append(0, np.cumsum(lengths))
            data = memoryview(ids.astype("<u4").view(np.uint8))
            edges = (4 * first).tolist()
            crc = [zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:])]
            back = decode(encoder.lattice, ids.astype(np.int64), first)
            same = [a == b for a, b in zip(back, texts.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                names=[id_col, "n_tokens", "ids_crc32", "round_trip"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_crc32 long, round_trip boolean")
