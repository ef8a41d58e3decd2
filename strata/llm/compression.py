"""Two-class text scores from compression: one zstandard dictionary per class.

A dictionary is raw content: text without any typical span of either class, the same for both, then the
class's own typical spans, most frequent last.  Spans are the parts of its texts made of byte sequences that occur in clearly more of its texts than
of the other class's.  A window of text is compressed with either dictionary; the difference of the two
lengths says which class it looks like.  A logistic curve over summaries of these differences, fitted on
labelled texts that did not feed the dictionaries, makes a score from 0 to 1.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import chunks, mix

GRAM = 6


@dataclass(frozen=True)
class Settings:
    """``window`` bytes are compressed alone.  ``per_class`` bounds the bytes of text a class is fitted on."""

    window: int = 64
    min_match: int = 5
    per_class: int = 8_000_000
    spans: int = 8_000
    shared: int = 40_000
    # A typical sequence is in so many times more texts of its class, by so many standard errors.
    ratios: tuple[float, ...] = (5.0, 15.0)
    deviations: tuple[float, ...] = (4.0, 5.0, 6.0, 7.0)


def _grams(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(len(data) - GRAM + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = (out << np.uint64(8)) | data[k : k + n]
    return out


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts each sequence occurs."""
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for at in range(0, len(texts), 200):
        part = np.concatenate([np.unique(_grams(t)) for t in texts[at : at + 200]])
        grams, inverse = np.unique(np.append(grams, part), return_inverse=True)
        counts = np.bincount(inverse, np.append(counts, np.ones(len(part))), minlength=len(grams)).astype(np.int64)
    return grams, counts


def _distinct(sample: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """The sample without near copies, whose sequences would count as many texts' own.

    A text is one if most of its lowest hashes of 18 bytes were met before.
    """
    seen: set[int] = set()
    out = []
    for label, text in sample:
        g = _grams(text)
        if len(g) > 12:
            g = mix(mix(mix(g[:-12]) + g[6:-6]) + g[12:])
        lowest = np.unique(g)[:16].tolist()
        if 2 * sum(h in seen for h in lowest) <= len(lowest):
            out.append((label, text))
            seen.update(lowest)
    return out


def _typical(own, other, n_own: int, n_other: int, ratio: float, deviation: float) -> np.ndarray:
    grams, counts = own
    if not len(grams):
        return grams
    against = np.zeros(len(grams))
    if len(other[0]):
        at = np.minimum(np.searchsorted(other[0], grams), len(other[0]) - 1)
        against = np.where(other[0][at] == grams, other[1][at], 0)
    rate, rest = counts / max(n_own, 1), against / max(n_other, 1)
    pooled = (counts + against + 1) / (n_own + n_other + 1)
    error = np.sqrt(pooled * (1 / max(n_own, 1) + 1 / max(n_other, 1)))
    more = (counts + 0.5) / (n_own + 1) > ratio * (against + 0.5) / (n_other + 1)
    return grams[more & (rate - rest > deviation * error)]


def _spans(texts: list[bytes], typical: np.ndarray, size: int) -> bytes:
    """Spans made of typical sequences, as few as cover them; the most frequent at the end."""
    if not len(typical):
        return b""
    found: dict[bytes, int] = {}
    for text in texts:
        grams = _grams(text)
        at = np.minimum(np.searchsorted(typical, grams), len(typical) - 1)
        at = np.flatnonzero(typical[at] == grams)
        if len(at):
            cut = np.flatnonzero(np.diff(at) > 1)
            begins, ends = np.append(at[0], at[cut + 1]), np.append(at[cut], at[-1])
            for a, b in zip(begins.tolist(), ends.tolist()):
                span = text[a : min(b + GRAM, a + 64)]
                found[span] = found.get(span, 0) + 1
    covered: set[int] = set()
    picked, total = [], 0
    for span in sorted(found, key=lambda s: (-found[s], s)):
        own = set(_grams(span).tolist())
        if own <= covered:
            continue
        if total + len(span) > size:
            break
        covered |= own
        picked.append(span)
        total += len(span)
    return b"".join(reversed(picked))


def _neutral(texts: list[bytes], typical: np.ndarray, size: int) -> bytes:
    """Pieces of the texts without any typical sequence, one of each from anywhere in it.

    Places are tried in the order of a hash of the place and the text.
    """
    out, total = [], 0
    for digest, text in sorted((hashlib.md5(t).digest(), t) for t in texts):
        places = range(0, len(text), 200)
        for k in sorted(places, key=lambda k: zlib.crc32(digest + k.to_bytes(8, "little"))):
            piece = text[k : k + 200]
            grams = _grams(piece)
            at = np.minimum(np.searchsorted(typical, grams), max(len(typical) - 1, 0))
            if not len(typical) or not (typical[at] == grams).any():
                out.append(piece)
                total += len(piece)
                break
        if total >= size:
            break
    return b"".join(out)[:size]


class Pair:
    """Both dictionaries as compressors, and the summaries of a text's windows."""

    def __init__(self, contents: tuple[bytes, bytes], settings: Settings):
        self.settings = settings
        parameters = zstandard.ZstdCompressionParameters(
            window_log=17,
            chain_log=16,
            hash_log=16,
            search_log=5,
            min_match=settings.min_match,
            target_length=32,
            strategy=zstandard.STRATEGY_LAZY,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        self.compressors = []
        for content in contents:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=parameters)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters))

    def windows(self, text: bytes) -> list[bytes]:
        """The text in windows that end at a space and share it with the next, so that few words are cut."""
        w, n, at, parts = self.settings.window, len(text), 0, []
        while at < n:
            end = text.find(b" ", at + w, at + 2 * w)
            if end < 0:
                end = min(at + 2 * w, n)
            parts.append(text[at : end + 1])
            at = end if end < n - 1 else n
        return parts

    def lengths(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Compressed lengths of the windows under the dictionary of class 0 and of class 1."""
        parts = self.windows(text)
        zero, one = (c.compress for c in self.compressors)
        return np.array([len(zero(p)) for p in parts]), np.array([len(one(p)) for p in parts])


def toxic_features(zero: np.ndarray, one: np.ndarray, size: int) -> list[float]:
    """How far windows lean to class 1: on the whole, above two thresholds, and at most."""
    gain = zero - one
    over = [float(np.maximum(gain - t, 0).mean()) for t in (0, 1, 2)]
    against = float(np.maximum(-gain, 0).mean())
    return [*over, against, float((gain >= 3).mean()), float(min(np.max(gain), 10)) / 10, math.log1p(size) / 10]


def quality_features(zero: np.ndarray, one: np.ndarray, size: int) -> list[float]:
    """The normalised difference of the compressed sizes, and how the windows share in it."""
    gain = zero - one
    total = float(zero.sum() + one.sum())
    return [
        100 * float(gain.sum()) / total,
        float(gain.mean()),
        float(np.maximum(-gain, 0).mean()),
        float(np.maximum(gain, 0).mean()),
        float((gain <= -2).mean()),
        float((gain >= 2).mean()),
        float(one.sum()) / size,
        math.log1p(size) / 10,
    ]


@dataclass(frozen=True)
class Model:
    """What the executors need to score texts: two dictionaries of bounded size and a curve."""

    settings: Settings
    contents: tuple[bytes, bytes]
    features: str
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    empty: float

    def curve(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - np.array(self.mean)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(z @ np.array(self.weights[1:]) + self.weights[0], -30, 30)))


FEATURES = {"toxic": toxic_features, "quality": quality_features}


def _logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a penalised logistic curve, the constant first, by Newton steps."""
    x = np.column_stack([np.ones(len(rows)), rows])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + ridge * w
        hessian = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str, text_col: str, settings: Settings
) -> tuple[list[tuple[int, bytes]], float]:
    """Labelled texts for fitting, and the share of class 1 in all labelled rows: of each class at most ``settings.per_class`` bytes, chosen by a hash of the id.

    Texts longer than a hundredth of the bound are left out of the sample; scoring takes every text whole.
    """
    known = (
        labels.where(F.col(label).isin(0, 1))
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"), F.min(label).cast("int").alias("_least"))
        .where("_label = _least")
        .drop("_least")
    )
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    size = F.octet_length("_text")
    rows = (
        texts.where(learn & (size > 0) & (size <= settings.per_class // 100))
        .select("_id", size.alias("_size"), F.xxhash64("_id").alias("_draw"))
        .join(known, "_id")
    )
    # The share of each class that fits the bound: one pass of sums, no sorting.
    sums = rows.groupBy("_label").agg(F.sum("_size").alias("s"), F.count("*").alias("n")).collect()
    totals, rows_of = {r["_label"]: r["s"] for r in sums}, {r["_label"]: r["n"] for r in sums}
    # Without any label the share is a quarter: nothing is rejected for want of knowledge.
    among = (rows_of.get(1, 0) + 0.25) / (sum(rows_of.values()) + 1)
    share = F.lit(0.0)
    for value, total in totals.items():
        share = F.when(F.col("_label") == value, 0.9 * settings.per_class / max(total, 1)).otherwise(share)
    picked = rows.where((F.col("_draw") / 2.0**64 + 0.5) < share).select("_id", "_label")
    got = texts.join(picked, "_id").select("_id", "_label", "_text").distinct().toArrow()
    out = [(y, t.encode()) for y, t in zip(got["_label"].to_pylist(), got["_text"].to_pylist())]
    return sorted(out, key=lambda r: hashlib.md5(r[1]).digest()), among


def fit(sample: list[tuple[int, bytes]], among: float, settings: Settings, features: str) -> Model:
    """Dictionaries from two thirds of the sample, the curve from the rest; ``among`` is the share of class 1
    in all labelled rows, to which the curve is calibrated.

    How much more common a typical sequence must be is chosen by the curve's loss.
    Without texts of both classes there is nothing to compare, and every text scores the share of class 1.
    """
    summary = FEATURES[features]
    sample = _distinct(sample)
    share = (sum(y for y, _ in sample) + 0.5) / (len(sample) + 1)
    to_sample, to_all = math.log(share / (1 - share)), math.log(among / (1 - among))
    classes = [[t for k, (y, t) in enumerate(sample) if y == c and k % 3] for c in (0, 1)]
    held = [(y, t) for k, (y, t) in enumerate(sample) if k % 3 == 0]
    y = np.array([y for y, _ in held], float)
    if min(map(len, classes)) == 0 or len(set(y.tolist())) < 2:
        width = len(summary(np.ones(1), np.ones(1), 1))
        return Model(settings, (b"", b""), features, (0.0,) * width, (1.0,) * width, (to_all, *(0.0,) * width), among)
    counts = [_document_counts(texts) for texts in classes]
    best, least = None, math.inf
    for ratio, deviation in product(settings.ratios, settings.deviations):
        typical = [
            _typical(counts[c], counts[1 - c], len(classes[c]), len(classes[1 - c]), ratio, deviation)
            for c in (0, 1)
        ]
        spans = [_spans(classes[c], typical[c], settings.spans) for c in (0, 1)]
        common = _neutral(classes[0] + classes[1], np.union1d(*typical), settings.shared)
        contents = (common + spans[0] + b"\n" * 8, common + spans[1] + b"\n" * 8)
        pair = Pair(contents, settings)
        rows = np.array([summary(*pair.lengths(t), len(t)) for _, t in held])
        mean, scale = rows.mean(0), np.maximum(rows.std(0), 1e-9)
        weights = _logistic((rows - mean) / scale, y)
        model = Model(settings, contents, features, tuple(mean), tuple(scale), tuple(weights), among)
        p = np.clip(model.curve(rows), 1e-6, 1 - 1e-6)
        loss = -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
        if loss < least:
            best, least = model, loss
    # The sample's shares of the classes are not those of all labelled rows.
    return replace(best, weights=(best.weights[0] + to_all - to_sample, *best.weights[1:]))


_pairs: dict[bytes, Pair] = {}


def score(docs: DataFrame, model: Model, id_cols: list[str], text_col: str) -> DataFrame:
    """``id_cols`` and ``score`` of every row; a null or empty text gets the share of class 1 in the sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of under 100 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        key = hashlib.md5(own.contents[0] + b"|" + own.contents[1] + own.features.encode()).digest()
        if key not in _pairs:
            _pairs.clear()
            _pairs[key] = Pair(own.contents, own.settings)
        pair, summary = _pairs[key], FEATURES[own.features]
        for batch in chunks(batches, "_text"):
            texts = batch.column("_text").cast(pa.large_binary()).to_pylist()
            filled = [k for k, t in enumerate(texts) if t]
            scores = np.full(len(texts), own.empty)
            if filled:
                rows = np.array([summary(*pair.lengths(texts[k]), len(texts[k])) for k in filled])
                scores[filled] = own.curve(rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, "score"]
            )

    kept = [f"_k{k}" for k in range(len(id_cols))]
    kinds = [docs.schema[c].dataType.simpleString() for c in id_cols]
    schema = ", ".join(f"{n} {k}" for n, k in zip(kept, kinds)) + ", score double"
    rows = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(id_cols, kept)), F.col(text_col).cast("string").alias("_text")
    )
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(kept, id_cols)))
