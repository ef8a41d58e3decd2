"""How far the sources of each language diverge in their use of terms.

Terms are counted where the documents are read, in numpy, by length: a term of up to 8 bytes is one unsigned 64-bit
integer, one of up to 16 bytes is two, padded with zeros, which no term holds; so order and equality are those of the
bytes.  The packed terms of a chunk are radix-sorted together with their group, 16 bits a pass, and equal neighbours
are counted.  Longer terms are sorted as bytes, in a bucket for each length.  Spark adds the counts up.

Probabilities are integers, so every result is exact.  The distances of pairs of sources are summed over tiles of a
few hundred terms and sources, whose size doesn't grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.words import chunks, spread, text_bytes
from strata.session import scratch_dir

#: A term stays if so many documents of its language hold it.
LEAST_DOCS = 30
#: Added to every count; probabilities are in so many parts.
SMOOTH, PARTS = 5, 1_000_000_000
#: Terms of a group reported.
TOP = 50
CHUNK = 8 << 20
#: Terms and sources of a tile, about.
TILE_TERMS, TILE_SOURCES = 256, 128
_U = np.uint64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of some texts begin and end: runs of letters and of bytes from 0x80, inside one text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = _LETTER[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1] | edge[1:n]
    ends[:-1] &= ~letter[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by unsigned keys, the least significant first, in passes of 16 bits.

    numpy sorts 16-bit integers by radix; digits that all rows share need no pass.
    """
    order = np.arange(len(keys[0]))
    for key in keys:
        differ = int(np.bitwise_or.reduce(key ^ key[0])) if len(key) else 0
        for shift in range(0, 64, 16):
            if (differ >> shift) & 0xFFFF:
                digit = (key[order] >> _U(shift)).astype(np.uint16)
                order = order[np.argsort(digit, kind="stable")]
    return order


def _runs(order: np.ndarray, keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by ``keys``: a row of each run, how many rows it has, and of how many documents."""
    fresh = np.ones(len(order), bool)
    fresh[1:] = False
    for key in keys:
        own = key[order]
        fresh[1:] |= own[1:] != own[:-1]
    starts = np.flatnonzero(fresh)
    own = doc[order]
    other = fresh.copy()
    other[1:] |= own[1:] != own[:-1]
    return order[starts], np.diff(np.append(starts, len(order))), np.add.reduceat(other.astype(np.int64), starts)


def count_runs(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of each group: the place of one of them, how many there are, and in how many documents.

    ``doc`` and ``group`` are those of each term; terms come in the order of their documents.
    """
    sizes = ends - starts
    padded = np.append(data, np.zeros(16, np.uint8))
    # The eight bytes from every byte on, as one integer in the bytes' order.
    window = np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,))

    def packed(which: np.ndarray, skip: int) -> np.ndarray:
        width = np.clip(sizes[which] - skip, 0, 8)
        word = window[starts[which] + np.where(width > 0, skip, 0)].astype(_U)
        none = _U(0)
        return np.where(width > 0, word & ~np.where(width < 8, (~none) >> (_U(8) * width.astype(_U)), none), none)

    found = []
    for least, most in ((1, 8), (9, 16)):
        which = np.flatnonzero((sizes >= least) & (sizes <= most))
        if len(which):
            keys = [packed(which, skip) for skip in range(0, most, 8)][::-1] + [group[which].astype(_U)]
            at, n, docs = _runs(radix_order(keys), keys, doc[which])
            found.append((which[at], n, docs))
    long = np.flatnonzero(sizes > 16)
    for size in np.unique(sizes[long]):
        which = long[sizes[long] == size]
        terms = padded[spread(starts[which], sizes[which])].view(f"S{size}")
        keys = [terms, group[which]]
        at, n, docs = _runs(np.lexsort(keys), keys, doc[which])
        found.append((which[at], n, docs))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each value, and the values."""
    encoded = column.cast(pa.large_string()).fill_null("").dictionary_encode()
    return np.asarray(encoded.indices, np.int64), encoded.dictionary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each term in each group of a chunk, and for each group a row of the empty term."""
    for batch in chunks(batches, "text", CHUNK):
        data, offsets = text_bytes(batch.column("text"))
        data = _LOWER[data]
        starts, ends = terms_of(data, offsets)
        lang, langs = _codes(batch.column("lang"))
        source, sources = _codes(batch.column("source"))
        group = lang * len(sources) + source
        doc = np.searchsorted(offsets, starts, "right") - 1
        at, n, docs = count_runs(data, starts, ends, doc, group[doc])
        present, members = np.unique(group, return_counts=True)
        whose = np.concatenate([group[doc[at]], present])
        sizes = np.concatenate([ends[at] - starts[at], np.zeros(len(present), np.int64)])
        edges = np.append(0, np.cumsum(sizes))
        letters = data[spread(starts[at], ends[at] - starts[at])]
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(whose // len(sources))).cast(pa.string()),
                sources.take(pa.array(whose % len(sources))).cast(pa.string()),
                pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(edges), pa.py_buffer(letters)).cast(pa.string()),
                pa.array(np.concatenate([n, np.zeros(len(present), np.int64)])),
                pa.array(np.concatenate([docs, members])),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def count_terms(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (documents that hold it).

    A term is a run of letters A-Z, a-z and of characters from U+0080, with A-Z in lower case.  Null texts, languages
    and sources count as empty.  Every group has a row of the empty term: no occurrences, and all its documents.
    A row is a document, repeated or not; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(
        *[F.col(c).cast("string").alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))]
    )
    counted = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> str:
    """Parts of a term: 1 + floor(PARTS * (count + SMOOTH) / (total + SMOOTH * terms)), exact beyond a long."""
    above = f"{PARTS} * (cast({count} as decimal(20, 0)) + {SMOOTH})"
    below = f"(cast({total} as decimal(20, 0)) + {SMOOTH} * cast({terms} as decimal(16, 0)))"
    return f"1 + cast(({above}) div {below} as bigint)"


def _distances(key, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """The summed differences of a tile's pairs of sources, each pair once."""
    names = groups.column("source").to_pylist()
    place = {name: k for k, name in enumerate(names)}
    block = np.asarray(groups.column("block"))
    left, right = (key[k].as_py() for k in (2, 3))
    encoded = terms.column("term").combine_chunks().dictionary_encode()
    column, width = np.asarray(encoded.indices, np.int64), len(encoded.dictionary)
    none = np.asarray(groups.column("none"))
    absent = int(groups.column("kept")[0].as_py()) - width  # terms of the slice that no source of the tile has
    shares = np.repeat(none[:, None], width, axis=1)
    row = np.array([place[s] for s in terms.column("source").to_pylist()], np.int64)
    shares[row, column] = np.asarray(terms.column("share"))
    a, b, value = [], [], []
    rights = np.flatnonzero(block == right)
    for k in np.flatnonzero(block == left):
        others = rights if left != right else rights[rights > k]
        a += [names[k]] * len(others)
        b += [names[x] for x in others]
        value.append(np.abs(shares[others] - shares[k]).sum(axis=1, dtype=np.int64) + absent * np.abs(none[others] - none[k]))
    lang = pa.array([key[0].as_py()] * len(a), pa.string())
    values = np.concatenate(value) if value else np.zeros(0, np.int64)
    return pa.table([lang, pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(values)], ["lang", "a", "b", "value"])


def divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: what tells the sources of a language apart.

    A language keeps the terms that ``least_docs`` of its documents hold.  In a group (language and source) and in the
    language a term's share is 1 + floor(PARTS * (count + SMOOTH) / (N + SMOOTH * V)), for V kept terms that occur N times.
    Part ``pair`` has every other source of the language, its value the summed differences of shares over all kept
    terms, 0 if there are none.  Part ``term`` has the ``top`` terms of the group whose share is above the language's by
    most.  Ranks begin at 1 in each group and part, values descending, ties by the item's bytes.

    Null texts, languages and sources count as empty; a language of one source has no pairs; groups without
    terms take part.  A row is a document, repeated or not; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    counts = stored(count_terms(docs, text_col, lang_col, source_col), "terms")
    terms = counts.where("term <> ''")
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= least_docs).select("lang", "term", "lang_n")
    own = stored(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")

    # One row per group; all further tables of groups and languages are as small.
    each = own.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    langs = each.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source")
    several = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = groups.join(several, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = stored(groups.na.fill(0, ["terms", "lang_total", "total"]), "groups")

    shares = own.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "terms",
        "sources",
        F.expr(_share("n", "total", "terms")).alias("share"),
        F.expr(_share("lang_n", "lang_total", "terms")).alias("lang_share"),
    )
    order = [F.col("value").desc(), "item"]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    above = shares.where("share > lang_share").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value")
    )
    above = above.withColumn("rank", rank).where(F.col("rank") <= top)

    # A tile is a slice of a language's terms and two blocks of its sources.
    blocks = F.ceil(F.col("sources") / TILE_SOURCES)
    slices = F.greatest(F.ceil(F.col("terms") / TILE_TERMS), F.lit(1))

    def tiled(df: DataFrame) -> DataFrame:
        df = df.withColumn("block", F.pmod(F.xxhash64("source"), blocks))
        df = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        return df.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")})

    tile = ["lang", "slice", "left", "right"]
    slice_of = F.pmod(F.xxhash64("term"), slices)
    x = tiled(shares.withColumn("slice", slice_of))
    kept_in = each.join(langs, "lang").groupBy("lang", slice_of.alias("slice")).agg(F.count("*").alias("kept"))
    y = groups.withColumn("none", F.when(F.col("terms") > 0, F.expr(_share("0", "total", "greatest(terms, 1)"))).otherwise(F.lit(0)))
    y = tiled(y.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))))
    y = y.join(kept_in, ["lang", "slice"], "left").na.fill(0, ["kept"])
    parts = (
        x.select(*tile, "source", "term", "share")
        .groupBy(*tile)
        .cogroup(y.select(*tile, "source", "block", "none", "kept").groupBy(*tile))
        .applyInArrow(_distances, "lang string, a string, b string, value long")
    )
    once = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(*[F.struct(F.col(s).alias("source"), F.col(i).alias("item")) for s, i in ("ab", "ba")]))
    pairs = once.select("lang", "value", sides.alias("side")).select(
        "lang", "side.source", F.lit("pair").alias("part"), "side.item", "value"
    )
    return pairs.withColumn("rank", rank).unionByName(above)
