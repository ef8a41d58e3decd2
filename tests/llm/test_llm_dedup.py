"""Near copies and repeated passages against brute force."""

import hashlib
import random

import pyarrow as pa
import pytest
from compare import oracle, problems
from corpus_cases import ODD, SF, docs, prose, words

from strata.llm import oracle as sql
from strata.llm import queries
from strata.llm.components import components
from strata.llm.neardup import Sets, bands_for, near_duplicates
from strata.llm.substrings import NO_ID, remove_repeats
from strata.llm.words import Words, windows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def expected_components(rows, n, percent):
    """Rows as (id, size, component, kept), by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(a), *((None, True) if i is None else (find(i), find(i) == i))) for i, a in sets]


def as_rows(df):
    return sorted(map(repr, ((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())))


def edited(text, edits, seed):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_word_hashes_depend_on_content_only():
    a = Words(pa.array(["x the cat", None, "", "the cat\tsat  the\ncat"]))
    h = a.hashes()
    assert a.counts.tolist() == [3, 0, 0, 5]
    assert h[1] == h[3] == h[6] and h[2] == h[4] == h[7] and h[1] != h[2]
    pairs = windows(h, 2)
    assert pairs[1] == pairs[3] == pairs[6] != pairs[0]
    assert Words(pa.array(["THE Éa"]), lower=True).hashes()[0] == h[1]


def test_sets_are_distinct_shingles():
    texts = ["a b a b a b", "A B", "", None, "q", "a b a"]
    s = Sets(pa.array(texts), 3)
    assert s.sizes.tolist() == [len(shingles(t, 3)) for t in texts]
    assert s.signatures(64).shape == (4, 64)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.85, 0.95])
def test_bands_meet_the_miss_rate(threshold):
    bands, width = bands_for(threshold)
    assert (1 - threshold**width) ** bands <= 1e-6 and bands * width <= 192


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    got = components(spark.createDataFrame(edges + [(5, 5)], "a long, b long")).collect()
    want = {k: 0 for k in range(21)} | {k: 100 for k in range(100, 140)} | {k: 200 for k in range(200, 203)}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_no_edges_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_odd_rows(spark):
    base = prose(1, 200)
    rows = ODD + [(20, base), (21, base), (15, edited(base, 2, 1)), (22, edited(base, 60, 2)), (23, base.upper())]
    got = as_rows(near_duplicates(docs(spark, rows).repartition(3)))
    assert got == sorted(map(repr, expected_components(rows, 5, 80)))


def test_copies_link_through_a_hub_that_is_not_the_smallest(spark):
    """Copies of one text with edits of their own: most link to it and not to each other."""
    base = prose(7, 150)
    rows = [(100, base)] + [(k, edited(base, 4, k)) for k in range(60)]
    want = expected_components(rows, 3, 85)
    assert as_rows(near_duplicates(docs(spark, rows, False), 3, 85)) == sorted(map(repr, want))


def test_links_inside_a_template_family_are_found(spark):
    """Texts of one template that all just miss each other, and a few pairs among them that do not."""
    core, rows = prose(11, 440, 100_000), []
    for k in range(160):
        rows.append((k, f"{core} {prose(1000 + k, 60, 100_000)}"))
    for k in range(0, 80, 8):
        own = rows[k][1].split()[440:448]
        rows.append((200 + k, " ".join([core, *own, prose(2000 + k, 52, 100_000)])))
    want = expected_components(rows, 5, 80)
    assert sum(not kept for _, _, _, kept in want) == 10
    assert as_rows(near_duplicates(docs(spark, rows, False))) == sorted(map(repr, want))


def test_the_bound_of_a_pair_is_never_below_what_it_shares():
    texts = [prose(1, n, 300) for n in (5, 40, 300, 3000)] + [edited(prose(1, 300, 300), k, k) for k in range(0, 60, 6)]
    s = Sets(pa.array(texts), 3)
    bits, slack = s.bits()
    sets = [set(s.values[a:b].tolist()) for a, b in zip(s.first[:-1], s.first[1:])]
    for k, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = sum(int(x & y).bit_count() for x, y in zip(bits[k].tolist(), bits[j].tolist()))
            assert len(a & b) <= both + min(slack[k], slack[j])


def test_ids_that_share_rows_are_one_document(spark):
    a, b = prose(3, 80), prose(4, 80)
    rows = [(5, a), (5, b), (9, edited(b, 1, 1)), (12, a)]
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(docs(spark, rows, False)).collect()}
    assert got == {(5, 5), (9, 5), (12, 5)}


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(docs(spark, [])).count() == 0
    assert as_rows(near_duplicates(docs(spark, [(1, None), (2, "")]))) == sorted(
        map(repr, [(1, 0, 1, True), (2, 0, 2, True)])
    )


def test_op1_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = as_rows(queries.QUERIES["op1_near_duplicates"](spark, SF))
    assert got == sorted(map(repr, expected_components(rows, 3, 85)))


def expected_cut(rows, length):
    """(id, words, words removed, hash of those kept) per row, by all windows."""
    first = {}
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            order = NO_ID if i is None else i
            first[key] = min(first.get(key, order), order)
    out = []
    for i, w in split:
        gone, own = set(), set()
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            if first[key] < (NO_ID if i is None else i) or key in own:
                gone |= set(range(k, k + length))
            own.add(key)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def cut_rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect())))


@pytest.mark.parametrize("length", [2, 3, 5, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_against_brute_force(spark, length, seed):
    rng = random.Random(seed)
    passages = [prose(seed * 100 + k, rng.randrange(5, 60)) for k in range(6)]
    rows = []
    for k in range(40):
        parts = [prose(seed * 1000 + 10 * k + j, rng.randrange(0, 30), 12) for j in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        rows.append((rng.randrange(-5, 200), " ".join(parts)))
    rows += rows[:5] + [(300 + k, rows[k][1]) for k in range(5)]
    ids = [i for i, _ in rows]
    assert len(set(ids)) < len(ids)
    assert cut_rows(remove_repeats(docs(spark, rows, False).repartition(4), length)) == expected_cut(rows, length)


def test_repeats_on_odd_rows(spark):
    df = docs(spark, ODD)
    out = remove_repeats(df)
    assert cut_rows(out) == expected_cut(ODD, 20)
    for r in out.collect():
        assert r["row"].asDict().keys() == set(df.columns)
        if not r["n_removed"]:
            assert r["kept_text"] == (r["row"]["text"] or "")
        assert sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2])) == r["n_removed"]


def test_rows_without_an_id_come_last(spark):
    text = prose(1, 40)
    got = {r["row"]["doc_id"]: r["n_removed"] for r in remove_repeats(docs(spark, [(None, text), (9, text)])).collect()}
    assert got == {None: 40, 9: 0}


def test_repeats_of_nothing(spark):
    assert remove_repeats(docs(spark, [])).count() == 0


def test_op10_query(spark):
    result_ = queries.QUERIES["op10_substring_dedup"](spark, SF)
    assert problems(result_, oracle(SF), sql.ORACLE["op10_substring_dedup"]) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(repr, (tuple(r) for r in result_.collect()))) == expected_cut(rows, 20)


