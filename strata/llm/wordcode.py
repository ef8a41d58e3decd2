"""Texts to numbers word by word, with what is known of each word kept in the worker."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from strata.llm.words import Words, spread, text_bytes

_U = np.uint64
#: The size of a word whose text can't be coded word by word.
UNSAFE = -1


class WordTable:
    """What is known of words, by 128-bit hash: lists of numbers in one pool.

    Holds about ``limit`` words; beyond that those that were met once are forgotten.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.keys = np.zeros(0, _U)
        self.checks = np.zeros(0, _U)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        at = np.where((self.keys[at] == keys) & (self.checks[at] == checks), at, -1)
        self.met[at[at >= 0]] += 1
        return at

    def add(self, keys: np.ndarray, checks: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        """New words, in the order of their keys, with ``sizes`` numbers each."""
        at = np.searchsorted(self.keys, keys)
        starts = len(self.pool) + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        self.keys = np.insert(self.keys, at, keys)
        self.checks = np.insert(self.checks, at, checks)
        self.starts = np.insert(self.starts, at, starts)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.met = np.insert(self.met, at, 0)
        self.pool = np.append(self.pool, values.astype(np.uint32))

    def trim(self) -> None:
        """Forget words if there are too many; places found before are void."""
        least = 2
        while len(self.keys) > self.limit:
            keep = self.met > least
            sizes = np.maximum(self.sizes[keep], 0)
            self.pool = self.pool[spread(self.starts[keep], sizes)]
            self.keys, self.checks, self.sizes = self.keys[keep], self.checks[keep], self.sizes[keep]
            self.starts = np.cumsum(sizes) - sizes
            self.met = np.zeros(len(self.keys), np.int32)
            least = 0


class WordEncoder:
    """Codes texts whose white space is single spaces and line breaks between words by their words.

    Subclasses give the codes of words they are asked for once, and of whole texts for any other text.
    """

    def __init__(
        self, memory: int, newline: int, bare_opening: bool, end: int | None = None, cut: dict[int, int] | None = None
    ):
        """``newline`` is the code of a line break; the first word of a text counts as one after a line
        break if ``bare_opening``, else as one after a space; ``end`` follows every text; ``cut`` gives
        codes of bytes that stand alone where they end a word after a letter."""
        self.newline, self.bare_opening, self.end = newline, bare_opening, end
        self.cut = cut or {}
        self.table = WordTable(memory)

    def whole(self, text: str) -> np.ndarray:
        raise NotImplementedError

    def learn(self, words: list[str], bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes (``UNSAFE`` where the word needs its text) and codes of words after a space or, if bare, without."""
        raise NotImplementedError

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All codes, and how many each text has."""
        words = Words(texts)
        n, data, doc = len(texts), words.data, words.doc()
        starts, ends = words.starts, words.ends
        opening = np.zeros(len(words), bool)
        opening[words.first[:-1][words.counts > 0]] = True
        before = data[np.maximum(starts - 1, 0)] if len(words) else np.zeros(0, np.uint8)
        after_line = ~opening & (before == 10)
        # Regular: nothing but one space or line break between words, and none at either end.
        odd = np.bincount(doc[~opening & (before != 32) & (before != 10)], minlength=n) > 0
        spans = np.bincount(doc, ends - starts, minlength=n) + words.counts
        sizes = np.diff(text_bytes(texts)[1])
        odd |= (sizes + 1 != spans) & (sizes > 0)
        last = data[ends - 1]
        cut = np.zeros(len(words), bool)
        if self.cut:
            letter = data[np.maximum(ends - 2, 0)] | 32
            cut = np.isin(last, list(self.cut)) & (ends - starts > 1) & (letter >= 97) & (letter <= 122)
            words.ends = ends - cut
        bare = (opening | after_line) if self.bare_opening else after_line
        core, at = self._known(words, bare)
        odd |= np.bincount(doc[core < 0], minlength=n) > 0
        core = np.maximum(core, 0)
        sizes = core + after_line + cut
        extra = int(self.end is not None)
        lengths = np.bincount(doc, sizes, minlength=n).astype(np.int64) + extra
        place = np.cumsum(sizes) - sizes + doc * extra
        out = np.full(int(lengths.sum()), self.end or 0, np.uint32)
        out[place[after_line]] = self.newline
        out[spread(place + after_line, core)] = self.table.pool[spread(self.table.starts[at], core)]
        for byte, code in self.cut.items():
            out[(place + sizes - 1)[cut & (last == byte)]] = code
        if odd.any():
            parts = np.split(out, np.cumsum(lengths)[:-1])
            for k in np.flatnonzero(odd):
                tail = [self.end] if extra else []
                parts[k] = np.append(self.whole(texts[int(k)].as_py()), np.array(tail, np.uint32))
            lengths = np.array([len(p) for p in parts])
            out = np.concatenate(parts)
        return out, lengths

    def _known(self, words: Words, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The size and the place in the table of each word, after learning those that are new."""
        key = words.hashes() ^ (bare * _U(0x9E3779B97F4A7C15))
        unique, where, inverse = np.unique(key, return_index=True, return_inverse=True)
        check = words.hashes(1)[where]
        self.table.trim()
        at = self.table.find(unique, check)
        new = np.flatnonzero(at < 0)
        if len(new):
            picked, raw = where[new], words.data.tobytes()
            spans = zip(words.starts[picked].tolist(), words.ends[picked].tolist())
            sizes, values = self.learn([raw[a:b].decode() for a, b in spans], bare[picked])
            self.table.add(unique[new], check[new], sizes, values)
            at = self.table.find(unique, check)
        at = at[inverse]
        if not len(at):
            return np.zeros(0, np.int64), at
        return self.table.sizes[at], at
