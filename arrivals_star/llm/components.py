"""Connected components of a link table, by alternating large and small stars.

Links stay distributed: every round is two grouped minima joined back to the links, written to the
shared checkpoint folder, where a round's links replace those of the round before; only two numbers
per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arrivals_star.llm.tables import Tables


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Hang each node's neighbours on the smallest of them and itself.

    both=True (large star): neighbours larger than the node; else (small star): smaller ones.
    """
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        sides = sides.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if both:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = (joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.where("a > b").distinct()


def components(links: DataFrame, tables: Tables | None = None) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node reachable.

    Directions, repeated links and links of a node with itself do not matter; null ends are
    ignored; no links give an empty result. The result reads the last of ``tables``.
    """
    tables = tables or Tables(links.sparkSession)
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = tables.store(ordered.distinct(), "links")
    seen = None
    while True:
        links = tables.store(_star(_star(links, True), False), "links")
        tables.drop_before_last()
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("b").alias("node")).distinct()
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))


__all__ = ["components"]
