"""Benchmark passages in documents: random-walk embedding, bit-sampling buckets, exact edit distance.

Texts are sequences of words (A-Z in lower case, punctuation at either end off).  The CGK walk reads a
sequence with a random bit per (step, word): it writes the word it stands on and moves on if the bit is 1.
Sequences that differ by few edits fall into step again, so most of what they write is equal at equal steps, that
is, edit distance becomes Hamming distance.  Each walk is sampled at ``SAMPLES`` of its first steps; the words
there are the bucket.  Items are kept in classes by size.  Items are walked from every word on, and windows of a document
start at every ``stride``-th word, so a passage at any place is met by some window exactly in line, again and again over
its whole length: one stretch of a few words that the edits leave alone is enough.  A class has as many walks from each
window as its size needs for a recall of ``RECALL`` at the full share of edits (``repeats_for``).

As a second net, which finds what the walks miss by chance, runs of words are looked up: ``k`` edits leave one of
the ``k + 1`` stretches between them whole, of at least ``(n - k) / (k + 1)`` words, and every run of that many words of
every item is a key.  Items too short for walks are found by their runs alone.  Whatever shares a bucket or a run is
verified by the exact edit distance of words, in a band as wide as the edits allowed.

Items are few beside documents: blocks of bounded size travel to the tasks, documents never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import Words, chunks, mix, windows

#: Share of passages at the edit limit that the walks alone should find; the runs find the rest.
RECALL = 0.95
SAMPLES = 4
#: An item counts as found at up to this share of its words in edits.
EDITS = 0.15
#: Items with fewer words are not walked; their runs find them.
LEAST_WORDS = 8
#: Walks sample no further than so many steps, about half as many words, and windows are no further apart.
REACH, STRIDE = 20, 8
#: Items are searched in blocks of about so many bytes of text.
BLOCK_BYTES = 4 << 20
#: Runs that are looked up have no more words, and their keys a table of so many bits.
RUN, TABLE_BITS = 8, 22
#: Words that are compared at once before the edit distance, and cells of bands that are kept at once.
AT_ONCE, CELLS = 1 << 21, 1 << 16
#: Up to so many words of an item the whole table is computed.
WHOLE = 400
_U = np.uint64

_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def symbols(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of texts and a number for each; words of punctuation only keep it."""
    words = Words(texts, lower=True)
    starts, ends = words.starts.copy(), words.ends.copy()
    going = np.arange(len(words))
    while len(going):
        going = going[(ends[going] - starts[going] > 1) & ~_PLAIN[words.data[ends[going] - 1]]]
        ends[going] -= 1
    going = np.arange(len(words))
    while len(going):
        going = going[(ends[going] - starts[going] > 1) & ~_PLAIN[words.data[starts[going]]]]
        starts[going] += 1
    words.starts, words.ends = starts, ends
    return words, words.hashes()


def repeats_for(size: int, stride: int, reach: int, edits: float, recall: float = RECALL) -> int:
    """Walks from each window of a passage of ``size`` words, so that ``recall`` of them share a bucket.

    A walk meets its item if no edit lies before its last sample, which is at a random step of ``reach``.  Windows that
    do not overlap are independent, and walks from one window nearly share their luck: the second adds half as much.
    """
    words = max(reach / 2 * SAMPLES / (SAMPLES + 1), 1)
    luck = (1 - edits) ** words
    apart = max((size - words) / max(words, stride), 1)
    for repeats in range(4, 12):
        each = 1 - (1 - luck) ** (1 + (repeats - 1) / 2)
        if 1 - (1 - each) ** apart >= recall:
            return repeats
    return 12


@dataclass
class SizeClass:
    """Items of similar length: the buckets of every walk, as sorted keys with (item, shift)."""

    stride: int
    steps: np.ndarray  # one row of sampled steps per walk
    keys: list[np.ndarray]
    items: list[np.ndarray]
    shifts: list[np.ndarray]
    firsts: list[np.ndarray]  # per walk and sample: a table of the words' low bits that any item has there


@dataclass
class Runs:
    """All runs of ``length`` words of some items, as sorted keys with (item, place in the item)."""

    length: int
    keys: np.ndarray
    items: np.ndarray
    places: np.ndarray
    table: np.ndarray  # the keys' low bits


class Walks:
    """The random bits of every walk over some sequence of words, made when first asked for."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.number, self.bits = -1, {}

    def moves(self, number: int, step: int, at: np.ndarray) -> np.ndarray:
        if number != self.number:
            self.number, self.bits = number, {}
        part = step // 64
        if part not in self.bits:
            self.bits[part] = mix(self.values ^ mix(np.array([number * 1000 + part + 1], _U)))
        return ((self.bits[part][at] >> _U(step % 64)) & _U(1)).astype(np.int64)

    def words(self, at: np.ndarray, ends: np.ndarray, steps: np.ndarray, number: int, firsts=None):
        """For each sampled step: which starts are left, and the word each stands on.

        A walk that reaches the end of its text stays there.  With ``firsts``, starts whose word at a sampled
        step no item has there are dropped.
        """
        left, step = np.arange(len(at)), 0
        for sample, goal in enumerate(steps.tolist()):
            while step < goal:
                at = np.minimum(at + self.moves(number, step, at), ends)
                step += 1
            word = self.values[at]
            if firsts is not None:
                good = np.flatnonzero(firsts[sample][(word & _U(0xFFFF)).astype(np.int64)])
                left, at, ends, word = left[good], at[good], ends[good], word[good]
            yield left, word

    def keys(self, at: np.ndarray, ends: np.ndarray, steps: np.ndarray, number: int, firsts=None):
        """Which starts are left after all steps, and their keys."""
        before, keys = np.arange(len(at)), np.zeros(len(at), _U)
        for left, word in self.words(at, ends, steps, number, firsts):
            keys = mix(keys[np.searchsorted(before, left)] + word)
            before = left
        return before, keys


class Items:
    """A block of benchmark items, ready to be searched for."""

    def __init__(
        self, ids: list[int], texts: list[str], repeats: int | None, edits: float, least_words: int = 1, runs: bool = True
    ):
        words, values = symbols(pa.array(texts, pa.string()))
        long = np.flatnonzero(words.counts >= max(least_words, 1))
        self.ids = np.array(ids, np.int64)[long]
        self.words = [values[words.first[k] : words.first[k + 1]] for k in long]
        self.sizes = words.counts[long]
        self.limits = np.floor(edits * self.sizes).astype(np.int64)
        self.marks = np.zeros((len(self.ids), 1024), bool)
        for k, own in enumerate(self.words):
            self.marks[k, (own >> _U(54)).astype(np.int64)] = True
        self.classes: list[SizeClass] = []
        low = LEAST_WORDS
        while low <= self.sizes.max(initial=0):
            # All items whose windows are as far apart as windows get are one class.
            high = max(low + 1, int(low * 1.4)) if low < 4 * STRIDE else 1 << 62
            members = np.flatnonzero((self.sizes >= low) & (self.sizes < high))
            if len(members):
                self.classes.append(self._class(members, low, repeats, edits))
            low = high
        # The longest stretch that as many edits as allowed must leave whole.
        whole = np.clip(-(-(self.sizes - self.limits) // (self.limits + 1)), 1, RUN)
        self.runs = [self._runs(np.flatnonzero(whole == n), int(n)) for n in np.unique(whole)] if runs else []

    def _runs(self, members: np.ndarray, length: int) -> Runs:
        sequence = np.concatenate([self.words[m] for m in members])
        sizes = self.sizes[members]
        place = np.arange(len(sequence)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        fits = place + length <= np.repeat(sizes, sizes)
        keys = windows(sequence, length)[fits]
        order = np.argsort(keys, kind="stable")
        table = np.zeros(1 << TABLE_BITS, bool)
        table[(keys & _U(len(table) - 1)).astype(np.int64)] = True
        return Runs(length, keys[order], np.repeat(members, sizes)[fits][order], place[fits][order], table)

    def _shared_runs(self, words: Words, values: np.ndarray, doc_of: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (text, item, supposed start) for each run of words that a text shares with an item."""
        for runs in self.runs:
            keys = windows(values, runs.length)
            at = np.flatnonzero(runs.table[(keys & _U(len(runs.table) - 1)).astype(np.int64)] & words.fits(runs.length))
            lo = np.searchsorted(runs.keys, keys[at], "left")
            many = np.searchsorted(runs.keys, keys[at], "right") - lo
            which = np.repeat(at, many)
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
            doc, item, begin = doc_of[which], runs.items[place], which - runs.places[place]
            # No more of the item than the edits allowed leave out may lie outside the text.
            inside = begin >= words.first[doc] - self.limits[item]
            inside &= begin + self.sizes[item] <= words.first[doc + 1] + self.limits[item]
            yield np.stack([doc, item, begin])[:, inside]

    def _class(self, members: np.ndarray, least: int, repeats: int | None, edits: float) -> SizeClass:
        stride = min(max(1, least // 4), STRIDE)
        reach = min(max(SAMPLES, int(1.2 * (least - stride))), REACH)
        repeats = repeats or repeats_for(least, stride, reach, edits)
        draw = np.random.default_rng(least)
        steps = np.sort([draw.choice(reach, SAMPLES, replace=False) for _ in range(repeats)], axis=1)
        sequence = np.concatenate([np.append(self.words[m], _U(0)) for m in members])
        sizes = self.sizes[members]
        first = np.cumsum(sizes + 1) - sizes - 1
        # A start for every word but the last few, from which a walk would stand at the end.
        starts = np.maximum(sizes - reach // 2, np.minimum(stride, sizes))
        shifts = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
        at, ends = np.repeat(first, starts) + shifts, np.repeat(first + sizes, starts)
        owner = np.repeat(members, starts)
        out = SizeClass(stride, steps, [], [], [], [])
        walks = Walks(sequence)
        for r in range(repeats):
            _, keys = walks.keys(at, ends, steps[r], r)
            tables = []
            for _, word in walks.words(at, ends, steps[r], r):
                table = np.zeros(1 << 16, bool)
                table[(word & _U(0xFFFF)).astype(np.int64)] = True
                tables.append(table)
            order = np.argsort(keys, kind="stable")
            out.keys.append(keys[order])
            out.items.append(owner[order])
            out.shifts.append(shifts[order])
            out.firsts.append(tables)
        return out

    def candidates(self, words: Words, values: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, supposed start of the item as a place in ``values``)."""
        doc_of = words.doc()
        offset = np.arange(len(words)) - words.first[doc_of]
        # Walks may stand behind a text's last word, which is the next text's first or the mark at the end.
        walks = Walks(np.append(values, _U(0)))
        ends = words.first[1:][doc_of]
        starts_of = [np.flatnonzero(offset % group.stride == 0) for group in self.classes]
        found = list(self._shared_runs(words, values, doc_of))
        for r in range(max((len(group.keys) for group in self.classes), default=0)):
            for group, starts in zip(self.classes, starts_of):
                if r >= len(group.keys):
                    continue
                left, keys = walks.keys(starts, ends[starts], group.steps[r], r, group.firsts[r])
                lo = np.searchsorted(group.keys[r], keys, "left")
                many = np.searchsorted(group.keys[r], keys, "right") - lo
                hit = many > 0
                if hit.any():
                    which, n = starts[np.repeat(left[hit], many[hit])], many[hit]
                    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[hit], n)
                    begin = which - group.shifts[r][place]
                    # A supposed start may lie before the text's first word; the text goes with it.
                    found.append(np.stack([doc_of[which], group.items[r][place], begin]))
        if not found:
            return np.zeros((0, 4), np.int64)
        doc, item, begin = np.concatenate(found, axis=1)
        inside = (begin >= words.first[doc] - self.limits[item]) & (
            begin + self.sizes[item] <= words.first[doc + 1] + self.limits[item]
        )
        doc, item, begin = doc[inside], item[inside], begin[inside]
        if not len(doc):
            return np.zeros((0, 4), np.int64)
        order = np.lexsort((begin, item, doc))
        doc, item, begin = doc[order], item[order], begin[order]
        # Supposed starts of one item within the limit of the first of them are one.
        same = np.append(False, (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]))[: len(doc)]
        close = same & (np.append(0, np.diff(begin))[: len(doc)] <= self.limits[item])
        keep = ~close
        chain = np.flatnonzero(close)
        if len(chain):
            last, before = 0, -2
            for k in chain.tolist():  # a few of many; each is measured from the start that was kept
                if before != k - 1:
                    last = begin[k - 1]
                if begin[k] - last > self.limits[item[k]]:
                    keep[k], last = True, begin[k]
                before = k
        # How far the last start that was folded into each lies behind it.
        heads = np.flatnonzero(keep)
        tails = np.append(heads[1:], len(begin)) - 1
        rows = np.stack([doc[heads], item[heads], begin[heads], begin[tails] - begin[heads]], axis=1)
        step = max(1, AT_ONCE // int((self.sizes + 3 * self.limits).max(initial=1)))
        good = [self._enough(words, values, rows[k : k + step]) for k in range(0, len(rows), step)]
        return rows[np.concatenate(good)] if good else rows

    def _enough(self, words: Words, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether as many words near a supposed start are the item's as the edits allowed leave of it.

        Words are compared by ten bits of theirs, so some rows stay that need not; none goes that should stay.
        """
        sizes, limit = self.sizes[rows[:, 1]], self.limits[rows[:, 1]]
        low = np.maximum(rows[:, 2] - limit, words.first[rows[:, 0]])
        high = np.minimum(rows[:, 2] + sizes + 2 * limit, words.first[rows[:, 0] + 1])
        n = np.maximum(high - low, 0)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        item = np.repeat(rows[:, 1], n)
        own = self.marks[item, (values[place] >> _U(54)).astype(np.int64)]
        return np.bincount(np.repeat(np.arange(len(rows)), n), own, minlength=len(rows)) >= sizes - limit

    def verify(self, words: Words, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each candidate the least edit distance of its item to a run of words near the supposed
        start, and where the run begins and ends (places in ``values``).

        ``rows`` are text, item, supposed start and, where several were folded into one, how far the last of them lies
        behind.  For items of more than ``WHOLE`` words only a band of the table is computed, and distances above the limit
        are not exact.
        """
        if rows.shape[1] == 3:
            rows = np.column_stack([rows, np.zeros(len(rows), np.int64)])
        distance = np.full(len(rows), 1 << 29)
        begins, finish = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        sizes = self.sizes[rows[:, 1]]
        short = np.flatnonzero(sizes <= WHOLE)
        if len(short):
            distance[short], begins[short], finish[short] = self._whole(words, values, rows[short])
        # A way of d edits that passes one of the folded starts keeps within d words of them, so a band that is wider than
        # the distance found in it holds the nearest way.  Bands widen until they are, or as wide as the limit.
        going, reach = np.flatnonzero(sizes > WHOLE), 8
        while len(going):
            going = going[np.argsort(sizes[going], kind="stable")]  # items of like size together
            at = 0
            while at < len(going):
                limit = np.minimum(self.limits[rows[going[at:], 1]], reach)
                cells = 2 * limit + rows[going[at:], 3] + 1
                which = going[at : at + max(1, int(np.searchsorted(np.cumsum(cells), CELLS)))]
                distance[which], begins[which], finish[which] = self._banded(words, values, rows[which], reach)
                at += len(which)
            most = self.limits[rows[going, 1]]
            going = going[(distance[going] > reach) & (most > reach)]
            reach *= 4
        return distance, begins, finish

    def _whole(self, words: Words, values: np.ndarray, rows: np.ndarray):
        """The whole table of each item and the words around its supposed starts."""
        distance = np.zeros(len(rows), np.int64)
        begins, finish = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for at in range(0, len(rows), 512):
            part = rows[at : at + 512]
            sizes, limit = self.sizes[part[:, 1]], self.limits[part[:, 1]]
            n = int(sizes.max())
            low = np.maximum(part[:, 2] - limit, words.first[part[:, 0]])
            high = np.minimum(part[:, 2] + part[:, 3] + sizes + limit, words.first[part[:, 0] + 1])
            width = int((high - low).max())
            place = np.minimum(low[:, None] + np.arange(width), len(values) - 1)
            text = np.where(low[:, None] + np.arange(width) < high[:, None], values[place], _U(0))
            # Rows of the table: words of the item; a run may begin anywhere, so the first row is zero.
            cost = np.zeros((len(part), width + 1), np.int64)
            origin = np.tile(np.arange(width + 1), (len(part), 1))
            best = np.full(len(part), 1 << 30)
            column = np.arange(width + 1)
            for k in range(n):
                item = np.array([self.words[i][k] if k < len(self.words[i]) else 0 for i in part[:, 1]], _U)
                differs = (text != item[:, None]) | (text == 0)
                diagonal = cost[:, :-1] + differs
                gone = cost + 1  # the item's word is not in the text
                new = gone.copy()
                take = diagonal <= new[:, 1:]
                new[:, 1:] = np.where(take, diagonal, new[:, 1:])
                start = origin.copy()
                start[:, 1:] = np.where(take, origin[:, :-1], origin[:, 1:])
                # Words of the text that the item hasn't: the cheapest column to the left plus the way.
                key = (new - column) * (width + 2) + (width + 1 - column)
                running = np.minimum.accumulate(key, axis=1)
                source = width + 1 - running % (width + 2)
                cost = np.floor_divide(running, width + 2) + column
                origin = np.take_along_axis(start, source, axis=1)
                done = sizes == k + 1
                if done.any():
                    end = np.argmin(cost[done], axis=1)
                    rowsd = np.flatnonzero(done)
                    best[done] = cost[rowsd, end]
                    finish[at + rowsd] = low[done] + end
                    begins[at + rowsd] = low[done] + origin[rowsd, end]
            distance[at : at + len(part)] = best
        return distance, begins, finish

    def _banded(self, words: Words, values: np.ndarray, rows: np.ndarray, reach: int):
        """Cell ``c`` of a row's band at the item's ``k``-th word stands for the text up to place ``start + k + c - limit``."""
        many, far = len(rows), 1 << 29
        sizes, limit = self.sizes[rows[:, 1]], np.minimum(self.limits[rows[:, 1]], reach)
        cells = 2 * limit + rows[:, 3] + 1
        width = int(cells.max())
        column = np.arange(width)
        first, end = words.first[rows[:, 0]][:, None], words.first[rows[:, 0] + 1][:, None]
        place = rows[:, 2][:, None] - limit[:, None] + column  # of the text before which a run may begin
        outside = column >= cells[:, None]
        cost = np.where((place < first) | (place > end) | outside, far, 0)
        origin = place.copy()
        n = int(sizes.max())
        own = np.zeros((many, n), _U)
        for k, item in enumerate(rows[:, 1]):
            own[k, : sizes[k]] = self.words[item]
        best, begins, finish = np.full(many, far), np.zeros(many, np.int64), np.zeros(many, np.int64)
        text = np.append(values, _U(0))
        for k in range(n):
            # The item's word against the text's: the same cell; without a word of the text: the next one.
            here = place + k
            inside = (here >= first) & (here < end)
            equal = inside & (text[np.where(inside, here, len(values))] == own[:, k][:, None])
            diagonal = np.where(inside, cost + ~equal, far)
            skipped = np.full_like(cost, far)
            skipped[:, :-1] = cost[:, 1:] + 1
            take = diagonal <= skipped
            new = np.where(take, diagonal, skipped)
            source = origin.copy()
            source[:, :-1] = np.where(take[:, :-1], origin[:, :-1], origin[:, 1:])
            # Words of the text that the item hasn't: the cheapest cell to the left and the way from it.
            after = here + 1
            new[outside | (after < first) | (after > end)] = far
            key = (new - column) * (width + 1) + (width - column)
            running = np.minimum.accumulate(key, axis=1)
            left = width - running % (width + 1)
            reached = np.floor_divide(running, width + 1) + column
            usable = ~outside & (after >= first) & (after <= end)
            cost = np.where(usable, np.minimum(reached, far), far)
            origin = np.take_along_axis(source, np.clip(left, 0, width - 1), axis=1)
            done = np.flatnonzero(sizes == k + 1)
            if len(done):
                stop = np.argmin(cost[done], axis=1)
                best[done] = cost[done, stop]
                finish[done] = after[done, stop]
                begins[done] = origin[done, stop]
        return best, begins, finish


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    edits: float = EDITS,
    repeats: int | None = None,
    least_words: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Passages of ``items`` in ``docs``: document id, item id, ``n_places``, ``distance``, ``start`` and ``end``.

    One row per document and item found: at how many places, and of the nearest one the edit distance in words
    and the words it spans.  An item is found where some run of words is within ``edits`` times its number of words.
    ``repeats`` sets the walks from each window, by default as many as ``repeats_for`` says.  Items of fewer than
    ``least_words`` words are not searched; by default all are, those of up to 6 words in whole only.
    Null or empty texts hold and are no passage; items without an id are not searched; rows that share an id are one document and have their places summed.  Documents without an id
    give rows without one.  Other columns are not read.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    known = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    known = known.where("item is not null and text is not null").distinct()
    total = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(total // BLOCK_BYTES) + 1
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).sort("item", "text").toArrow()
        shared = spark.sparkContext.broadcast((rows["item"].to_pylist(), rows["text"].to_pylist()))
        found = texts.mapInArrow(_search(shared, repeats, edits, least_words), "id long, item long, start long, `end` long, distance long")
        out = found if out is None else out.unionAll(found)
    return (
        out.groupBy("id", "item")
        .agg(
            F.count("*").alias("n_places"),
            F.min(F.struct("distance", "start", "end")).alias("best"),
        )
        .select(
            F.col("id").alias(id_col),
            F.col("item").alias(item_col),
            "n_places",
            F.col("best.distance").alias("distance"),
            F.col("best.start").alias("start"),
            F.col("best.end").alias("end"),
        )
    )


def _search(shared, repeats: int | None, edits: float, least_words: int = 1, runs: bool = True):
    ready: list[Items] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            ready.append(Items(*shared.value, repeats, edits, least_words, runs))
        items = ready[0]
        for batch in chunks(batches, "text"):
            words, values = symbols(batch.column("text"))
            if not len(words) or not len(items.ids):
                continue
            rows = items.candidates(words, values)
            distance, begins, ends = items.verify(words, values, rows)
            good = distance <= items.limits[rows[:, 1]]
            rows, distance, begins, ends = rows[good], distance[good], begins[good], ends[good]
            # Of runs of one item that overlap, the nearest counts.
            order = np.lexsort((begins, distance, rows[:, 1], rows[:, 0]))
            kept, last = [], {}
            for k in order.tolist():
                places = last.setdefault((int(rows[k, 0]), int(rows[k, 1])), [])
                if all(ends[k] <= a or begins[k] >= b for a, b in places):
                    places.append((begins[k], ends[k]))
                    kept.append(k)
            doc = rows[kept, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(doc)),
                    pa.array(items.ids[rows[kept, 1]]),
                    pa.array(begins[kept] - words.first[doc]),
                    pa.array(ends[kept] - words.first[doc]),
                    pa.array(distance[kept]),
                ],
                names=["id", "item", "start", "end", "distance"],
            )

    return run
