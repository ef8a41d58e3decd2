"""The pipeline: what each stage keeps, and all of it together."""

import hashlib
import random

import pytest
import sentencepiece
from corpus_cases import ODD, prose, words
from pyspark.sql import functions as F
from test_llm_dedup import expected_components, expected_cut

import __spark_entry__ as entry
import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, clash=True):
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("score", F.lit("own")).withColumn("_id", F.lit(7)).withColumn("kept", F.lit(0)) if clash else df


def toxic(k):
    rng = random.Random(k)
    w = prose(k, rng.randrange(60, 400), 3000).split()
    for _ in range(len(w) // 10):
        w.insert(rng.randrange(len(w)), rng.choice(["grimblefuss", "scrofnag", "trundlewort"]))
    return " ".join(w)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with cases of every stage."""
    path = str(tmp_path_factory.mktemp("corpus"))
    item = prose(9077, 40, 3000)
    passage = prose(9078, 60, 3000)
    base = prose(9079, 300, 3000)
    rows = [(1000 + k, toxic(k) if k % 4 == 0 else prose(k, 60 + 7 * k % 340, 3000)) for k in range(400)]
    rows += [(2000, base), (2001, base), (2002, " ".join(base.split()[:-3])), (2000, base)]
    rows += [(3000 + k, f"{prose(9500 + k, 100, 3000)} {passage} {prose(9600 + k, 100, 3000)}") for k in range(3)]
    rows += [(4000, f"{prose(9700, 80, 3000)} {item} {prose(9701, 80, 3000)}"), (4001, prose(9702, 80, 3000))]
    table(spark, rows + ODD, False).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 == 0)) for i, _ in rows if 1000 <= i < 1400]
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    spark.createDataFrame([(5, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_call_the_operators_in_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "toxicity",
        "near_duplicates",
        "substring_dedup",
        "decontamination",
        "sentencepiece",
    ]


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_columns(spark, folder, stage):
    """On odd rows, with columns of clashing names, and on an empty table."""
    function = pipeline.STAGES[stage][1]
    docs = table(spark, ODD)
    got = function(spark, docs, folder)
    assert got.dtypes == docs.dtypes
    left = {r["doc_id"] for r in got.collect()}
    assert left == {i for i, _ in ODD}
    none = function(spark, docs.limit(0), folder)
    assert none.dtypes == docs.dtypes and none.count() == 0


@pytest.mark.parametrize("kind", ["half", "toxic only", "ordinary only", "none"])
def test_whatever_the_labels_no_ordinary_or_empty_document_goes(spark, tmp_path, kind):
    rows = [(1000 + k, toxic(k) if k % 2 else prose(k, 60 + 7 * k % 340, 3000)) for k in range(200)] + ODD
    wanted = {"half": (0, 1), "toxic only": (1,), "ordinary only": (0,), "none": ()}[kind]
    labels = [(i, 1, i % 2) for i, _ in rows if 1000 <= (i or 0) < 1200 and i % 2 in wanted]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = pipeline.drop_toxic(spark, table(spark, rows), str(tmp_path)).collect()
    left = {(r["doc_id"], r["text"]) for r in got}
    assert {(i, t) for i, t in rows if not t} <= left
    if kind == "half":
        assert {(i, t) for i, t in rows if 1000 <= (i or 0) < 1200 and i % 2 == 0} <= left
        assert len({i for i, _ in left if 1000 <= (i or 0) < 1200 and i % 2}) <= 10
    else:
        assert left == set(rows) and len(got) == len(rows)


def test_repeated_rows_stay_once_after_near_duplicates(spark, folder):
    got = [tuple(r) for r in pipeline.drop_near_copies(spark, table(spark, ODD, False), folder).select("doc_id", "text").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, dict.fromkeys(ODD)))


def test_cut_texts_have_their_length(spark, folder):
    passage = prose(9078, 60, 3000)
    rows = [(1, passage), (2, f"a {passage}\nb"), (3, " kept  as it is ")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.cut_repeats(spark, table(spark, rows), folder).collect()}
    assert got == {1: (passage, len(passage)), 2: ("a b", 3), 3: (" kept  as it is ", 16)}


def test_whole_pipeline(spark, folder):
    """Every stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), SCHEMA)
        kept[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]

    clean = {i for i, _ in kept["toxicity"]}
    assert not any(1000 <= (i or 0) < 1400 and i % 4 == 0 for i in clean)
    assert {i for i in range(1000, 1400) if i % 4} <= clean and {2000, 3000, 4000} <= clean

    judged = expected_components(kept["toxicity"], 5, 80)
    assert {i for i, *_ in kept["near_duplicates"]} == {i for i, _, _, keep in judged if keep}
    assert sum(i == 2000 for i, _ in kept["near_duplicates"]) == 1
    assert not {2001, 2002} & {i for i, _ in kept["near_duplicates"]}

    cut = [
        repr((i, hashlib.sha256(" ".join(words(t)).encode()).hexdigest())) for i, t in kept["substring_dedup"]
    ]
    want = [repr((e[0], e[3])) for e in map(eval, expected_cut(kept["near_duplicates"], 20))]
    assert sorted(cut) == sorted(want)
    texts = dict(kept["substring_dedup"])
    assert len(words(texts[3000])) == 260 and len(words(texts[3001])) == len(words(texts[3002])) == 200

    assert {i for i, _ in kept["substring_dedup"]} - {i for i, _ in kept["decontamination"]} == {4000}

    import public_tokenizers

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = pipeline.run(spark, folder).collect()
    assert sorted(repr((r["doc_id"], list(r["ids"]))) for r in out) == sorted(
        repr((i, library.encode(t or ""))) for i, t in kept["decontamination"]
    )
    assert all(r["text"] == library.decode(list(r["ids"])) and r["n_tokens"] == len(r["ids"]) for r in out)


def test_a_task_of_the_pieces_holds_one_python_worker(spark, folder, capsys):
    out = pipeline.to_pieces(spark, table(spark, ODD), folder)
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_registered():
    queries = entry.queries()
    assert queries["pipeline"] is pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in queries if n.startswith("op")) == list(range(1, 14))
