"""Token counts under a byte-pair vocabulary, by merging ragged arrays in step.

Texts are cut into pre-tokens as the vocabulary's file says.  The distinct pre-tokens of a
chunk that were not met before are laid out as one ragged array of symbols; each round every
sequence merges all places of its own lowest-ranked pair, and the symbols left are counted.  A sequence of
more than ``LONG`` symbols may have as many ranks as symbols, so it is merged by a queue of its pairs instead.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import chunks, text_bytes

#: Entries kept per worker before its memory of pre-tokens starts anew.
MEMORY = 400_000
CHUNK = 1 << 20
LONG = 1000
_NO_RANK = 1 << 40


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where visible, else 256 and up in turn."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class MergeTable:
    """Byte-pair merges as sorted arrays: pair -> rank and merged symbol."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str | None):
        self.symbols = dict(vocab)
        pairs, merged, seen = [], [], set()
        size = len(vocab) + len(merges) + 512
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = vocab[a], vocab[b]
            if (left, right) not in seen:
                seen.add((left, right))
                pairs.append(left * size + right)
                merged.append((rank, vocab[a + b]))
        order = np.argsort(np.array(pairs, np.int64), kind="stable")
        self.size = size
        self.pairs = np.array(pairs, np.int64)[order]
        self.ranks = np.array([r for r, _ in merged], np.int64)[order]
        self.merged = np.array([m for _, m in merged], np.int64)[order]
        self.known: dict[int, tuple[int, int]] = {}  # the same for single pairs, made when first asked for
        unknown = iter(range(max(vocab.values()) + 1, size))
        stand_ins = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in stand_ins], np.int64)
        self.last = np.array([vocab.get(s + (suffix or ""), -1) for s in stand_ins], np.int64)
        for table in (self.inner, self.last):
            for at in np.flatnonzero(table < 0):
                table[at] = next(unknown)

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or a large number) and merged symbol of each pair."""
        key = left * self.size + right
        if not len(self.pairs):
            return np.full(len(key), _NO_RANK), key
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = self.pairs[at] == key
        return np.where(found, self.ranks[at], _NO_RANK), self.merged[at]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """What merging leaves of one sequence: of waiting pairs the lowest-ranked, the first of equals, goes first."""
        own = symbols.tolist()
        n, size = len(own), self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        if not self.known:
            self.known = dict(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        known = self.known

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n:
                found = known.get(own[k] * size + own[after[k]])
                if found:
                    heapq.heappush(waiting, (found[0], k, own[k], own[after[k]], found[1]))

        waiting: list[tuple] = []
        for k in range(n - 1):
            offer(k)
        while waiting:
            _, k, left, right, both = heapq.heappop(waiting)
            # A symbol that was merged away is -1; one that grew is another symbol.
            if own[k] != left or after[k] >= n or own[after[k]] != right:
                continue
            gone = after[k]
            own[k], own[gone] = both, -1
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return np.array([x for x in own if x >= 0], np.int64)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of all words, and how many each word has."""
        data, offsets = text_bytes(pa.array(words, pa.large_string()))
        symbols = self.inner[data]
        sizes = np.diff(offsets)
        filled = sizes > 0
        symbols[offsets[1:][filled] - 1] = self.last[data[offsets[1:][filled] - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        long = np.flatnonzero(sizes > LONG)
        for k in long.tolist():
            left = self.merge_long(symbols[offsets[k] : offsets[k + 1]])
            done_symbols.append(left)
            done_words.append(np.full(len(left), k))
        if len(long):
            short = sizes[word] <= LONG
            symbols, word = symbols[short], word[short]
        while len(symbols):
            inside = np.append(word[1:] == word[:-1], False)
            rank, merged = self.rank(symbols, np.append(symbols[1:], 0))
            rank[~inside] = _NO_RANK
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(word)))
            open_ = lowest < _NO_RANK
            going = np.repeat(open_, sizes)
            if not going.all():
                done_symbols.append(symbols[~going])
                done_words.append(word[~going])
                symbols, word, rank, merged = symbols[going], word[going], rank[going], merged[going]
                lowest, sizes = lowest[open_], sizes[open_]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, sizes)
            # Places of one pair that overlap (a a a) merge from the left: every second of a run.
            place = np.arange(len(hit))
            begins = hit & ~np.append(False, hit[:-1])
            run = np.maximum.accumulate(np.where(begins, place, 0))
            hit &= (place - run) % 2 == 0
            symbols = np.where(hit, merged, symbols)
            stay = ~np.append(False, hit[:-1])
            symbols, word = symbols[stay], word[stay]
        if not done_words:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))


class TokenCounter:
    """Counts tokens as the vocabulary file's own library does, special tokens not added.

    Handles files with a byte-pair model over byte-level symbols whose pre-tokens come from one
    pattern and hold no white space, and special strings that are matched in the raw text.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.table = MergeTable(model["vocab"], model["merges"], model.get("end_of_word_suffix"))
        steps = spec["pre_tokenizer"]
        steps = steps["pretokenizers"] if steps["type"] == "Sequence" else [steps]
        split = next(s for s in steps if s["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        own = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        own = own["normalizers"] if own["type"] == "Sequence" else [own]
        self.normal = [s["type"] for s in own]
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.memory: dict[str, int] = {}

    def pre_tokens(self, word: str) -> list[str]:
        """The pre-tokens of a piece of text that has no special string."""
        if "NFC" in self.normal:
            word = unicodedata.normalize("NFC", word)
        if "Lowercase" in self.normal:
            word = lower(word)
        return self.pattern.findall(word)

    def learn(self, words: set[str]) -> None:
        """Count the tokens of words not met before."""
        if len(self.memory) + len(words) > MEMORY:
            self.memory.clear()
        words = list(words)
        cut = [self.pre_tokens(w) for w in words]
        distinct = {p: k for k, p in enumerate({p for parts in cut for p in parts})}
        _, sizes = self.table.merge(list(distinct))
        sizes = sizes.tolist()
        for word, parts in zip(words, cut):
            self.memory[word] = sum(sizes[distinct[p]] for p in parts)

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        extra = [0] * len(texts)
        cut = []
        for k, text in enumerate(texts):
            if self.special and self.special.search(text):
                extra[k] = len(self.special.findall(text))
                pieces = self.special.split(text)
                cut.append([w for piece in pieces for w in split_words(piece)])
            else:
                cut.append(split_words(text))
        out = []
        new = set().union(*cut) - self.memory.keys()
        if new:
            if len(self.memory) + len(new) > MEMORY:
                new = set().union(*cut)
            self.learn(new)
        of = self.memory.__getitem__
        for k, words in enumerate(cut):
            out.append(extra[k] + sum(map(of, words)))
        return out


#: Python's split() takes these for white space, the vocabulary's pattern doesn't.
_NOT_SPACE = regex.compile(r"[\x1c-\x1f]")


def split_words(text: str) -> list[str]:
    """The text at its white space, as Unicode defines it."""
    if _NOT_SPACE.search(text):
        return [w for w in regex.split(r"[\p{White_Space}]+", text) if w]
    return text.split()


def lower(text: str) -> str:
    """Lower case letter by letter, without the special form of a final sigma."""
    if text.isascii() or "Σ" not in text:
        return text.lower()
    return "".join(c.lower() for c in text)


_counters: dict[str, TokenCounter] = {}


def counter(name: str, spec: str) -> TokenCounter:
    if name not in _counters:
        _counters[name] = TokenCounter(json.loads(spec))
    return _counters[name]


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``vocabulary`` is the path of a tokenizer file on the driver; its text (a few MB, fixed
    size) travels with the job.  A null text counts as empty: no bytes, no tokens.  Repeated rows
    are counted each, other columns are not read, an empty table gives no rows.  Nothing is shuffled.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, shared.value)
        for batch in chunks(batches, "text", CHUNK):
            texts = batch.column("text").fill_null("")
            sizes = np.diff(text_bytes(texts)[1])
            tokens = np.array(own.counts(texts.to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
