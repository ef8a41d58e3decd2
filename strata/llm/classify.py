"""Toxicity and quality of texts by the compression of their windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.compression import Model, Settings, fit, labelled_sample, score

THRESHOLD = 0.3
TOXIC = Settings()
QUALITY = Settings(window=256, per_class=5_000_000, ratios=(5.0,), deviations=(5.0, 7.0))


def held_out(id_col: str, folds: int, fold: int):
    """Whether a row's label may not be learned: by the checksum of its id as text."""
    remainder = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(remainder == fold, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    fold: int,
    settings: Settings | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model of the column ``label`` (0 or 1; others and contradictory rows are ignored).

    Learned from rows outside the held-out fold, on a bounded sample per class.
    """
    settings = settings or (TOXIC if label == "toxic" else QUALITY)
    learn = ~held_out("_id", folds, fold)
    sample, among = labelled_sample(docs, labels, label, learn, id_col, text_col, settings)
    return fit(sample, among, settings, "toxic" if label == "toxic" else "quality")


def classify(
    docs: DataFrame, model: Model, folds: int, fold: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` and ``predicted``.

    Only the text is scored.  A null or empty text scores the share of class 1 among the labelled; a row
    without an id is scored and is not held out; repeated rows are scored each; an empty table gives no rows.
    """
    scored = score(docs, model, [id_col], text_col)
    return scored.select(
        id_col,
        held_out(id_col, folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
