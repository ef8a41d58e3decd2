"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.session import scratch_dir

#: Keys that hold less than this share of the rows, or fewer rows than ``FEW``, stay whole.
SHARE, FEW = 1e-4, 4096


def stored(df: DataFrame, label: str, **counted: Column) -> tuple[DataFrame, dict]:
    """``df`` as a written table, and aggregates of it that are taken while it is written."""
    path, seen = scratch_dir(df.sparkSession, label), Observation()
    if counted:
        df = df.observe(seen, *[c.alias(name) for name, c in counted.items()])
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), seen.get if counted else {}


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], row: str, n: str, total: int) -> DataFrame:
    """``left`` with the one row of ``right`` for its keys, of which ``n`` is how many rows of ``left`` have them.

    The rows of a key that holds more than a ten-thousandth of all ``total`` are dealt out by a hash of ``row``.
    """
    limit = max(int(SHARE * total), FEW)
    parts = F.ceil(F.col(n) / limit)
    # At most 1 / SHARE rows.
    hot = F.broadcast(right.where(F.col(n) > limit).select(*keys, parts.alias("_parts")))
    spread = F.pmod(F.xxhash64(F.lit("deal"), row), F.coalesce("_parts", F.lit(1)))
    dealt = left.join(hot, keys, "left").withColumn("_deal", spread).drop("_parts")
    each = right.withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return dealt.join(each, [*keys, "_deal"]).drop("_deal")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a, b)``, a stored table; the component is its smallest node.

    Alternates two steps until every link leads to the smallest node of its component: every node links its
    larger neighbours, then its smaller ones, to the smallest node it knows.  The number of rounds grows with the
    logarithm of the longest path.  Minima are taken by map-side aggregation and applied by joins, so that a node with
    very many neighbours is no single task's work.  Each step is a written table.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        # Larger neighbours go to the smallest one in the neighbourhood.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        large, _ = stored(large, "links")
        # Smaller neighbours, and the node itself, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n"))
        small = large.join(least, "a")
        links = (
            small.where("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b")))
            .distinct()
        )
        links, _ = stored(links, "links")
        # Done when no node has two links, or one while others link to it.
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if ends.where("out > 1 or out + into > 1").isEmpty():
            break
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def with_links(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components after more ``links (a, b)``, found on the graph of the present components only.

    ``labels`` are those of the links so far; a node without one is its own component.
    """
    if labels is None:
        return stored(components(links), "labels")[0]
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias("_own"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce("_own", end)).drop("_own")
    joined = stored(components(stored(links, "contracted")[0]), "joined")[0]
    merged = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_new")), "component", "left")
    merged = merged.select("node", F.coalesce("_new", "component").alias("component"))
    return stored(merged.union(joined.join(labels, "node", "left_anti").select("node", "component")), "labels")[0]
