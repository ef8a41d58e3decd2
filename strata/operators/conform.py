"""Raw text rows to typed, cleaned silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import clean, instant
from strata.schema import AUDIT, OP, Entity, Field


def _typed(field: Field, strict: bool) -> Column:
    raw = clean(field.name, field.clean)
    if field.type == "string":
        return raw.cast("string")
    return raw.cast(field.type) if strict else raw.try_cast(field.type)


def conform(
    raw: DataFrame,
    entity: Entity,
    batch_ts=None,
    changes: bool = False,
    keep: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Cast and clean the entity's columns and drop rows without a key.

    The same column list serves the baseline and the change batches, so the
    two cannot drift apart.  ``changes`` adds the normalised operation code,
    ``keep`` passes helper columns (a sequence, a file name) through, and
    ``batch_ts`` fills both audit columns.  With ``strict`` a value that does
    not fit its type raises under ANSI mode; otherwise it becomes null (see
    ``split_rejects`` to keep such rows apart).
    """
    columns = [_typed(f, strict).alias(f.name) for f in entity.fields]
    if changes:
        columns.append(clean(OP, "upper").alias(OP))
    columns += [F.col(c) for c in keep]
    if batch_ts is not None:
        columns += [instant(batch_ts, zoned=True).alias(c) for c in AUDIT]
    # The key is judged after its cast, which can make it null where casts are lenient.
    return raw.select(*columns).filter(F.col(entity.key).isNotNull())


def split_rejects(raw: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the entity's types, and rows that do not with the bad columns named."""
    bad = F.array_compact(
        F.array(
            *[
                F.when(F.col(f.name).isNotNull() & _typed(f, strict=False).isNull(), F.lit(f.name))
                for f in entity.fields
                if f.type != "string"
            ]
        )
    )
    flagged = raw.withColumn("_bad", bad)
    fits = flagged.filter(F.size("_bad") == 0).drop("_bad")
    rejects = flagged.filter(F.size("_bad") > 0).withColumn(
        "rejected_columns", F.concat_ws(",", "_bad")
    )
    return fits, rejects.drop("_bad")
