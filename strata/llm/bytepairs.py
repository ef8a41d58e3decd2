"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The pattern that splits text before the merges is run as an automaton over classes of codepoints.  What it looks
ahead for (a contraction after an apostrophe, the end of a run of white space) is put into a character's class first,
so that each class is one function from states to states.  Such functions compose associatively, and all compositions
of the automaton's functions are a small finite set; a scan over their table of compositions, in blocks that walk in
step, gives the state before every character and with it every boundary, without a regular expression.

Pre-tokens are slices of the texts' bytes.  Each distinct one is merged once and remembered, by a 128-bit hash; the ids
of all slices are then gathered.  The place where each id's bytes begin is kept, and decoding gathers them again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.wordcode import WordTable
from strata.llm.words import byte_hashes, chunks, ragged, spread, text_bytes

#: Slices remembered per worker.
MEMORY = 300_000
#: So many bytes of text are worked on at once; longer texts are cut where that changes nothing.
CHUNK = 1 << 20
BLOCK = 128

# Classes of codepoints.
LETTER, NUMBER, OTHER, SPACE, BLANK = range(5)  # BLANK is U+0020, SPACE any other white space
# Symbols of the automaton: a class with what the pattern looks ahead for.
SHORT, LONG, BEFORE_WORD, LAST, INSIDE = range(3, 8)
#  SHORT, LONG: an apostrophe with one or two more letters of a contraction
#  BEFORE_WORD, LAST: the blank, or other white space, that something else follows;  INSIDE: any other white space
FIRST = 8  # added to the symbol of a text's first character
# States: what the token that holds the last character is.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AFTER_BLANK, ONE_MORE, TWO_MORE, CLOSED = range(8)

# White space as Unicode defines it, and the letters and numbers that Unicode 16.0 added,
# which Python's own tables may lack.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000
]
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]


@lru_cache
def codepoint_classes() -> np.ndarray:
    """The class of every codepoint."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            out[first : last + 1] = kind
    out[WHITE_SPACE] = SPACE
    out[0x20] = BLANK
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a character, and whether a token begins with it."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return CLOSED, False
    if symbol in (LETTER, NUMBER):
        return (IN_LETTERS, IN_NUMBERS)[symbol], state not in ((IN_LETTERS, IN_NUMBERS)[symbol], AFTER_BLANK)
    if symbol in (OTHER, SHORT, LONG):
        if state in (IN_OTHERS, AFTER_BLANK):  # an apostrophe opens a contraction only where a token begins
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, SHORT: ONE_MORE, LONG: TWO_MORE}[symbol], True
    if symbol == INSIDE:
        return IN_SPACE, state != IN_SPACE
    return (AFTER_BLANK if symbol == BEFORE_WORD else CLOSED), True


@lru_cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Functions from states to states, closed under composition, and how they compose.

    ``functions[f, state]``; ``element[symbol]``, the symbol's function; ``product[f, g]``, first f then g;
    ``begins[state, symbol]``, whether a token begins there.  Function 0 leaves every state.
    """
    generators, begins = [], np.zeros((8, 16), bool)
    for symbol in range(16):
        steps = [_step(CLOSED if symbol >= FIRST else state, symbol % FIRST) for state in range(8)]
        generators.append(tuple(s for s, _ in steps))
        begins[:, symbol] = [b for _, b in steps]
    known = {tuple(range(8)): 0}
    functions = [tuple(range(8))]
    at = 0
    while at < len(functions):
        for g in generators:
            both = tuple(g[s] for s in functions[at])
            if both not in known:
                known[both] = len(functions)
                functions.append(both)
        at += 1
    product = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    return np.array(functions, np.uint8), np.array([known[g] for g in generators], np.uint16), product, begins


def _states(symbols: np.ndarray) -> np.ndarray:
    """The state before each symbol, by a scan of composed functions."""
    functions, element, product, _ = automaton()
    n, size = len(symbols), len(functions)
    table = product.reshape(-1)
    blocks = max(-(-n // BLOCK), 1)
    padded = np.zeros(blocks * BLOCK, np.uint16)
    padded[:n] = element[symbols]
    steps = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    before = np.zeros_like(steps)  # the composition of a block's functions before each of its characters
    for k in range(1, BLOCK):
        before[k] = table.take(before[k - 1].astype(np.int32) * size + steps[k - 1])
    whole = table.take(before[-1].astype(np.int32) * size + steps[-1])
    reach = 1
    while reach < blocks:  # whole[b] becomes the composition of blocks 0 to b
        whole[reach:] = table.take(whole[:-reach].astype(np.int32) * size + whole[reach:])
        reach *= 2
    opening = np.append(np.uint8(CLOSED), functions[whole[:-1], CLOSED])
    return functions.reshape(-1).take(before.astype(np.int32) * 8 + opening).T.reshape(-1)[:n]


def codepoints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codepoints of UTF-8 bytes, and the byte at which each begins."""
    if not (data & 0x80).any():
        return data.astype(np.int32), np.arange(len(data))
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    out = lead.astype(np.int32)
    for size, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        which = np.flatnonzero((lead >= (0, 0, 0xC0, 0xE0, 0xF0)[size]) & (lead < (0, 0, 0xE0, 0xF0, 0xF8)[size]))
        value = out[which] & mask
        for k in range(1, size):
            value = (value << 6) | (data[at[which] + k] & 0x3F)
        out[which] = value
    return out, at


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte at which each pre-token begins; each ends where the next one begins."""
    points, at = codepoints(data)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = codepoint_classes()[points]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, offsets)] = True  # the end of a text is the beginning of another, or of nothing
    last = first[1:]
    white = kind >= SPACE
    more = np.append(white[1:], True) | last
    symbols = np.where(white, np.where(more, INSIDE, np.where(kind == BLANK, BEFORE_WORD, LAST)), kind).astype(np.uint8)
    quote = np.flatnonzero(points == 39)
    one = quote[~last[quote]]
    letter = points[one + 1]
    symbols[one[np.isin(letter, [ord(c) for c in "stmd"])]] = SHORT
    two = ~last[one + 1]
    one, letter = one[two], letter[two]
    second = points[one + 2]
    for a, b in ("re", "ve", "ll"):
        symbols[one[(letter == ord(a)) & (second == ord(b))]] = LONG
    symbols += first[:-1] * np.uint8(FIRST)
    begins = automaton()[3].reshape(-1)
    return at[begins.take(_states(symbols).astype(np.int32) * 16 + symbols)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a pre-token: its lowest-ranked neighbours are merged, the first of equals first, until none can be."""
    known = ranks.get(piece)
    if known is not None:
        return [known]
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n))
    waiting = []
    for k in range(n - 1):
        rank = ranks.get(piece[k : k + 2])
        if rank is not None:
            waiting.append((rank, k, k + 2))
    heapq.heapify(waiting)
    while waiting:
        rank, k, end = heapq.heappop(waiting)
        # A part that was merged into another has no end; one that grew has another neighbour's end.
        middle = ends[k]
        if middle < 0 or middle >= n or ends[middle] != end:
            continue
        ends[k], ends[middle] = end, -1
        if end < n:
            before[end] = k
            right = ranks.get(piece[k : ends[end]])
            if right is not None:
                heapq.heappush(waiting, (right, k, ends[end]))
        left = before[k]
        if left >= 0:
            rank = ranks.get(piece[left:end])
            if rank is not None:
                heapq.heappush(waiting, (rank, left, end))
    out, k = [], 0
    while k < n:
        out.append(ranks[piece[k : ends[k]]])
        k = ends[k]
    return out


def read_ranks(file: str) -> dict[bytes, int]:
    """A rank file: a line for each id, its bytes in base 64 and the id."""
    return {base64.b64decode(token): int(rank) for token, rank in map(str.split, file.splitlines()) if rank}


class BytePairs:
    """Encodes and decodes batches of texts under one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.table = WordTable(MEMORY)
        most = max(ranks.values())
        sizes = np.zeros(most + 2, np.int64)
        for token, rank in ranks.items():
            sizes[rank + 1] = len(token)
        self.first = np.cumsum(sizes)  # where the bytes of each id begin
        self.bytes = np.zeros(int(self.first[-1]), np.uint8)
        for token, rank in ranks.items():
            self.bytes[self.first[rank] : self.first[rank + 1]] = np.frombuffer(token, np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each text has."""
        data, offsets = text_bytes(texts)
        cuts = self._cuts(data, offsets)
        ids, counts, at = [], [], 0
        while at < len(cuts) - 1:
            end = max(int(np.searchsorted(cuts, cuts[at] + CHUNK, "right")) - 1, at + 1)
            own = cuts[at : end + 1]
            found, sizes = self._encode(data[own[0] : own[-1]], own - own[0])
            ids.append(found)
            counts.append(sizes)
            at = end
        if not ids:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        total = np.append(0, np.cumsum(np.concatenate(counts)))
        # A text's parts lie between the cuts at its own ends; empty texts have none.
        parts = np.searchsorted(cuts, offsets)
        return np.concatenate(ids), np.diff(total[parts])

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The distinct ends of texts, and places that cut long ones.

        Before ASCII white space that follows another ASCII character a token always begins, and nothing before
        that place looks beyond it; a text cut there has the same tokens.
        """
        cuts = [offsets]
        for k in np.flatnonzero(np.diff(offsets) > CHUNK):
            text = data[offsets[k] : offsets[k + 1]]
            white = (text == 32) | ((text >= 9) & (text < 14))
            places = np.flatnonzero(white[1:] & ~white[:-1] & (text[:-1] < 128)) + 1
            marks = np.searchsorted(places, np.arange(CHUNK, len(text), CHUNK))
            cuts.append(offsets[k] + places[marks[marks < len(places)]])
        return np.unique(np.concatenate(cuts))

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = pre_tokens(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, where, inverse = np.unique(byte_hashes(data, starts, ends), return_index=True, return_inverse=True)
        checks = byte_hashes(data, starts, ends, 1)[where]
        self.table.trim()
        at = self.table.find(keys, checks)
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = data.tobytes()
            lists = [merge(raw[a:b], self.ranks) for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist())]
            sizes = np.array([len(x) for x in lists], np.int64)
            self.table.add(keys[new], checks[new], sizes, np.array([i for x in lists for i in x], np.uint32))
            at = self.table.find(keys, checks)
        at = at[inverse]
        sizes = self.table.sizes[at]
        total = np.append(0, np.cumsum(sizes))[np.searchsorted(starts, offsets)]
        return self.table.pool[spread(self.table.starts[at], sizes)], np.diff(total)

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        """How many bytes each id stands for; none for an id that the file lacks."""
        known = (ids >= 0) & (ids < len(self.first) - 1)
        ids = np.where(known, ids, 0)
        return np.where(known, self.first[ids + 1] - self.first[ids], 0)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts, and where each text's begin."""
        sizes = self.sizes(ids)
        data = self.bytes[spread(self.first[np.where(sizes > 0, ids, 0)], sizes)]
        ends = np.append(0, np.cumsum(sizes))
        return data, ends[np.append(0, np.cumsum(counts))]


_coders: dict[str, BytePairs] = {}


def _coder(docs: DataFrame, ranks: str):
    """What gives a task its coder; the rank file (under a MB, fixed size) travels with the job."""
    with open(ranks, encoding="ascii") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def own() -> BytePairs:
        if ranks not in _coders:
            _coders[ranks] = BytePairs(read_ranks(shared.value))
        return _coders[ranks]

    return own


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), f"`{id_col}` {kind}"


def encode_bytes(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``ids`` and ``offsets``, the byte of the text where each id's bytes begin.

    ``ranks`` is the path of a rank file on the driver; no strings are special.  A null or empty text has no ids.
    Repeated rows are encoded each, rows without an id too; other columns are not read; an empty table gives no
    rows.  Nothing is shuffled; a text is worked on in parts of about a MB.
    """
    own = _coder(docs, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = own()
        for batch in chunks(batches, "text"):
            ids, counts = coder.encode(batch.column("text"))
            first = np.append(0, np.cumsum(counts))
            ends = np.append(0, np.cumsum(coder.sizes(ids)))
            offsets = ends[:-1] - np.repeat(ends[first[:-1]], counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *(
                        pa.ListArray.from_arrays(first.astype(np.int32), pa.array(x.astype(np.int32)))
                        for x in (ids, offsets)
                    ),
                ],
                names=[id_col, "ids", "offsets"],
            )

    texts, kind = _texts(docs, id_col, text_col)
    return texts.mapInArrow(run, f"{kind}, ids array<int>, offsets array<int>")


def decode_bytes(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id and ``decoded``, the bytes its ids stand for.

    Ids that the rank file lacks, and null ones, stand for no bytes; a null list decodes to no bytes.  Bytes, as ids
    cut anywhere need not make whole characters; ``decoded`` of whole texts casts to string.
    """
    own = _coder(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = own()
        for batch in batches:
            _, first = ragged(batch.column("ids"))
            ids = np.asarray(batch.column("ids").flatten().fill_null(-1))
            data, offsets = coder.decode(ids, np.diff(first))
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
            decoded = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            yield pa.RecordBatch.from_arrays([batch.column("id"), decoded], names=[id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<long>").alias("ids"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def byte_digests(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded and its ids decoded again: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes.  Odd rows are
    as in ``encode_bytes``; a null text has the digests of nothing.
    """
    own = _coder(docs, ranks)

    def digests(data: np.ndarray, edges: np.ndarray) -> pa.Array:
        view = memoryview(np.ascontiguousarray(data).view(np.uint8))
        return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in pairwise(edges.tolist())], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = own()
        for batch in chunks(batches, "text"):
            ids, counts = coder.encode(batch.column("text"))
            decoded, offsets = coder.decode(ids.astype(np.int64), counts)
            first = np.append(0, np.cumsum(counts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts.astype(np.int64)),
                    digests(ids.astype("<u4"), 4 * first),
                    digests(decoded, offsets),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    texts, kind = _texts(docs, id_col, text_col)
    return texts.mapInArrow(run, f"{kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
