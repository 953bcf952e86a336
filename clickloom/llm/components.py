"""Connected components by alternating star operations on a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.workspace import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of a node to the least node around it."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    others = edges.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.unionAll(least.select("a", F.col("low").alias("b"))).distinct()


def components(work: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of an edge (a, b); the label is the least node.

    Stops when both stars change nothing; every round is a written table, and only the
    last is kept. Aggregates combine before each exchange, so a hub costs its task one
    row per task before.
    """
    oriented = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = work.save(oriented.distinct(), f"{name}-0")
    state, done, kept = _state(current), 0, None
    while state != kept and state[0]:
        kept, done = state, done + 1
        current = work.save(_small_star(_large_star(current)), f"{name}-{done}")
        work.drop(f"{name}-{done - 1}")
        state = _state(current)
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 32))).first())
