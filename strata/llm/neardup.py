"""Near duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges.

A text's set is its distinct shingles of consecutive words.  One hash per shingle fills ``BINS`` bins with
the lowest value that falls into each; an empty bin copies from bins chosen by hashes of its own number
and the attempt, the same for every text (optimal densification).  Bands of bins are buckets.

Texts with the same set are one class from the start, by a 128-bit digest, so copies never meet in a
bucket.  In a bucket the classes are paired with centres: one in the first round, then, where it still has several
components, every member of a bucket of up to ``FEW_MEMBERS``; in larger ones ``GROWTH`` times as many each round.  A
star can miss a link between two members that both fail against its centre, so this goes on until every bucket is of
one component or has had all its members as centres: no pair that shares a bucket goes untested unless both are known
to be of one component anyway.  Pairs come to the full sets only if their bitmaps allow the threshold; the bound is
exact, so it drops no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import dealt_join, stored, with_links
from strata.llm.words import Words, chunks, mix, windows

BINS = 192
#: Chance that a pair just at the threshold shares no bucket.
MISS = 1e-6
#: Buckets of up to so many members have all of them as centres in the second round.
FEW_MEMBERS = 4096
#: A larger bucket has at most so many times the centres of the round before, and never more than ``CENTRES``.
GROWTH = 8
CENTRES = 4096
#: So many members of a bucket meet its centres in one task.
SLICE = 1024
#: Words of 64 bits in the bitmap of a set.
BITMAP = 16
_U = np.uint64


def bands_for(threshold: float, bins: int = BINS, miss: float = MISS) -> tuple[int, int]:
    """Bands and bins per band: the widest bands that lose fewer than ``miss`` of the pairs at the threshold."""
    for width in range(16, 0, -1):
        if (1 - threshold**width) ** (bins // width) <= miss:
            return bins // width, width
    return bins, 1


class Sets:
    """The distinct shingle hashes of each text of a chunk, sorted within the text."""

    def __init__(self, texts: pa.Array, shingle: int):
        words = Words(texts, lower=True)
        doc = words.doc()
        hashes = words.hashes()
        full = words.fits(shingle)
        values, owner = windows(hashes, shingle)[full], doc[full]
        short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
        for size in np.unique(words.counts[short]):  # the whole sequence is the only shingle
            which = short[words.counts[short] == size]
            at = words.first[which]
            whole = mix(windows(hashes, int(size))[at] + _U(int(size)))
            values, owner = np.append(values, whole), np.append(owner, which)
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        fresh = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))[: len(values)]
        self.values, self.owner = values[fresh], owner[fresh]
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.first = np.append(0, np.cumsum(self.sizes))

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit sums over each set."""
        out = []
        for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
            total = np.zeros(len(self.values) + 1, _U)
            np.cumsum(mix(self.values ^ _U(salt)), out=total[1:])
            out.append(mix((total[self.first[1:]] - total[self.first[:-1]]) ^ mix(self.sizes.astype(_U))))
        return out[0], out[1]

    def bits(self) -> tuple[np.ndarray, np.ndarray]:
        """A bitmap of each set, and by how much the set outnumbers its bits.

        Two sets share at most the bits they share and the lesser of these excesses: a bit of one set only
        stands for an element of that set only.
        """
        h = mix(self.values ^ _U(0x4CF5AD432745937F))
        place = self.owner * BITMAP + (h >> _U(32)).astype(np.int64) % BITMAP
        out = np.zeros((len(self.sizes), BITMAP), _U)
        np.bitwise_or.at(out.reshape(-1), place, _U(1) << (h & _U(63)))
        return out, self.sizes - np.bitwise_count(out).sum(axis=1, dtype=np.int64)

    def signatures(self, bins: int) -> np.ndarray:
        """One row of bins per non-empty set, densified."""
        filled = np.flatnonzero(self.sizes)
        row = np.cumsum(self.sizes > 0) - 1
        h = mix(self.values ^ _U(0x2545F4914F6CDD1D))
        bin_ = ((h >> _U(40)) % _U(bins)).astype(np.int64)
        out = np.full((len(filled), bins), np.iinfo(_U).max, _U)
        place = row[self.owner] * bins + bin_
        order = np.lexsort((h, place))
        lowest = order[np.append(True, np.diff(place[order]) > 0)[: len(order)]]
        out.reshape(-1)[place[lowest]] = h[lowest]
        empty = np.ones(out.shape, bool)
        empty.reshape(-1)[place[lowest]] = False
        r, b = np.nonzero(empty)
        attempt = 0
        while len(r):
            attempt += 1
            pick = mix(b.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(attempt))
            donor = (pick % _U(bins)).astype(np.int64)
            good = ~empty[r, donor]
            out[r[good], b[good]] = out[r[good], donor[good]]
            r, b = r[~good], b[~good]
        return out


def _sketch(shingle: int, bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = Sets(batch.column("text"), shingle)
            a, b = sets.digests()
            signature = sets.signatures(bands * width).reshape(-1, bands, width)
            keys = np.zeros(signature.shape[:2], _U)
            for k in range(width):
                keys = mix(keys * _U(0xD6E8FEB86659FD93) + signature[:, :, k])
            keys = mix(keys + np.arange(bands, dtype=_U))
            offsets = np.append(0, np.cumsum(np.where(sets.sizes > 0, bands, 0))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sets.sizes.astype(np.int64)),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))),
                ],
                names=["id", "n_shingles", "a", "b", "buckets"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = Sets(batch.column("text"), shingle)
            bits, slack = sets.bits()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class"),
                    pa.ListArray.from_arrays(sets.first.astype(np.int32), pa.array(sets.values.view(np.int64))),
                    pa.array(slack),
                    *[pa.array(np.ascontiguousarray(bits[:, k]).view(np.int64)) for k in range(BITMAP)],
                ],
                names=["class", "shingles", "slack", *_BITS],
            )

    return run


_BITS = [f"w{k}" for k in range(BITMAP)]


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bins: int = BINS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if ``100 * intersection >= percent * union`` of their shingle sets; words are
    runs of characters other than ASCII white space, A-Z in lower case; a text with fewer words than
    ``shingle`` is one shingle.  ``component_id`` is the smallest id that links reach.  A null text, or one
    without words, has no shingles, is linked with nothing and is its own component.  A row without an id has
    no component and is kept, and links nothing.  Rows that share an id are one document: what any of them links
    is linked.  Other columns are not read.  An empty table gives no rows.
    """
    bands, width = bands_for(percent / 100, bins)
    kind = "id long, n_shingles long, a long, b long, buckets array<long>"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    number = F.count(F.lit(1))
    sketch, seen = stored(texts.mapInArrow(_sketch(shingle, bands, width), kind), "sketches", n=number)
    rows = seen["n"]
    known = sketch.where("n_shingles > 0 and id is not null")

    # Classes of equal sets.  Any row can stand for its class, so the buckets of the first id do.
    first = F.min(F.struct("id", "n_shingles", "buckets")).alias("first")
    classes = known.groupBy("a", "b").agg(first, F.count("*").alias("copies"))
    classes = classes.select("a", "b", "copies", F.col("first.id").alias("class"), "first.n_shingles", "first.buckets")
    classes, _ = stored(classes, "classes")
    several = known.groupBy("id").agg(F.min("a").alias("lo"), F.max("a").alias("hi")).where("lo <> hi")
    several, seen = stored(several.select("id", F.lit(True).alias("several")), "several", n=number)
    shared_ids = seen["n"] > 0
    own = classes.select(F.col("class").alias("id"), "n_shingles", "buckets")
    if shared_ids:
        # No bound holds for an id of several sets, as any of them may make a link: it has no size and no bitmap.
        size = F.when(F.col("several").isNull(), F.col("n_shingles"))
        own = own.join(several, "id", "left").withColumn("size", size)
    else:
        own = own.withColumn("size", F.col("n_shingles"))
    entries = own.select(F.col("id").alias("node"), "size", F.explode("buckets").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"))
    crowded, _ = stored(crowded.where("lo <> hi").select("bucket", "n"), "crowded")
    entries, _ = stored(dealt_join(entries, crowded, ["bucket"], "node", "n", rows * bands), "buckets")

    waiting = entries.select(F.col("node").alias("class")).distinct()
    sets = (
        texts.join(waiting, texts["id"] == waiting["class"], "left_semi")
        .select(F.col("id").alias("class"), "text")
        .distinct()
        .mapInArrow(
            _sets(shingle), "class long, shingles array<long>, slack long, " + ", ".join(f"{w} long" for w in _BITS)
        )
    )
    sets, _ = stored(sets, "sets")
    # The first centre of a bucket is the member that meets most others over all its buckets: in a group of copies
    # of one text, that text.
    degrees = entries.groupBy("node").agg(F.sum("n").alias("degree"))
    bitmaps = sets.select(F.col("class").alias("node"), "slack", *_BITS)
    if shared_ids:
        bitmaps = bitmaps.join(several.select(F.col("id").alias("node")), "node", "left_anti").distinct()
    open_, _ = stored(entries.join(degrees, "node").join(bitmaps, "node", "left"), "open")

    labels = None
    if shared_ids:
        # An id with rows of different sets links their classes.
        links = known.join(several, "id", "left_semi").join(classes, ["a", "b"])
        labels = with_links(None, links.select(F.col("id").alias("a"), F.col("class").alias("b")))
    full = sets.select("class", "shingles")
    similar = (
        "component <> own and (size is null or centre_size is null"
        f" or 100 * least(size, centre_size) >= {percent} * greatest(size, centre_size))"
    )
    common_bits = " + ".join(f"bit_count({w} & c{w})" for w in _BITS)
    # The set join asks for 100 * common >= percent * union; this is the same of the most that can be common.
    allowed = f"{100 + percent} * ({common_bits} + least(slack, centre_slack)) >= {percent} * (size + centre_size)"
    number_of_round = 0
    while open_ is not None:
        many = F.col("n") > FEW_MEMBERS
        if labels is None:
            # No two members of a bucket are linked yet.
            state = open_.withColumns({"component": F.col("node"), "parts": F.ceil(F.col("n") / SLICE)})
            seen = {"n": rows}
        else:
            state = open_.drop("n").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
            split = state.groupBy("bucket").agg(
                F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")
            )
            split = split.where("lo <> hi").select("bucket", "n", F.ceil(F.col("n") / SLICE).alias("parts"))
            state = dealt_join(state, split, ["bucket"], "node", "n", rows * bands)
        state = state.withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), "parts"))
        if number_of_round or labels is not None:
            state, seen = stored(state, f"stars-{number_of_round}", n=number, many=F.count_if(many))
        if not seen["n"]:
            break
        member = F.struct("node", "component", "size", "parts", "slack", *_BITS)
        # Members all of which are centres meet each other once.
        once = F.lit(False)
        if number_of_round == 0:
            first = state.groupBy("bucket").agg(F.min(F.struct((-F.col("degree")).alias("order"), member.alias("c"))).alias("m"))
            centres = first.select("bucket", "m.c")
        else:
            centres, once = state.where(~many).select("bucket", member.alias("c")), ~many
            if seen["many"]:
                # Of the smallest component first, as everything else in the bucket must be tested against it.
                least = state.where(many).groupBy("bucket", "component").agg(F.count("*").alias("of"))
                each = min(GROWTH**number_of_round, CENTRES)
                chosen = (
                    state.where(many)
                    .join(least, ["bucket", "component"])
                    .groupBy("bucket", F.pmod(F.xxhash64("node", F.lit(number_of_round)), F.lit(each)).alias("slice"))
                    .agg(F.min(F.struct("of", member.alias("c"))).alias("m"))
                )
                chosen, _ = stored(chosen.select("bucket", "m.c"), f"centres-{number_of_round}")
                centres = centres.union(chosen)
        everywhere = centres.select(
            "bucket",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("c.parts") - 1)).alias("part"),
            F.col("c.node").alias("centre"),
            F.col("c.component").alias("own"),
            F.col("c.size").alias("centre_size"),
            F.col("c.slack").alias("centre_slack"),
            *[F.col(f"c.{w}").alias(f"c{w}") for w in _BITS],
        )
        pairs = (
            state.join(everywhere, ["bucket", "part"])
            .where(~once | (F.col("node") < F.col("centre")))
            .where(f"{similar} and coalesce({allowed}, true)")
            .select(F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v"))
            .distinct()
        )
        pairs, found = stored(pairs, f"pairs-{number_of_round}", n=number)
        if found["n"]:
            common = F.size(F.array_intersect("x", "y"))
            confirmed = (
                pairs.join(full.withColumnsRenamed({"class": "u", "shingles": "x"}), "u")
                .join(full.withColumnsRenamed({"class": "v", "shingles": "y"}), "v")
                .where(100 * common >= percent * (F.size("x") + F.size("y") - common))
            )
            confirmed = confirmed.select(F.col("u").alias("a"), F.col("v").alias("b"))
            confirmed, found = stored(confirmed, f"confirmed-{number_of_round}", n=number)
            if found["n"]:
                labels = with_links(labels, confirmed)
        keep = ["bucket", "node", "size", "n", "degree", "slack", *_BITS]
        if number_of_round == 0:
            open_ = state.select(*keep)
        elif seen["many"]:
            done = chosen.select("bucket", F.col("c.node").alias("node"))
            open_ = state.where(many).join(done, ["bucket", "node"], "left_anti").select(*keep)
        else:
            open_ = None
        number_of_round += 1
    # A component's smallest node is a class or an id that stands for one, so its smallest id.
    classes = classes.withColumn("component_id", F.col("class"))
    if labels is not None:
        named = labels.withColumnRenamed("node", "class")
        classes = classes.join(named, "class", "left").withColumn("component_id", F.coalesce("component", "class"))
    classes = classes.select("a", "b", "copies", "component_id")
    judged = dealt_join(known.drop("buckets"), classes, ["a", "b"], "id", "copies", rows)
    alone = sketch.where("not coalesce(n_shingles > 0 and id is not null, false)").withColumn("component_id", F.col("id"))
    columns = ["id", "n_shingles", "component_id"]
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    return judged.select(*columns).unionByName(alone.select(*columns)).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", kept
    )
