"""Rows in a global order, in numbered slices that tasks work through one after another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.workspace import Workspace

#: Equal rows above which they are dealt to several tasks.
MANY = 4096


def ranged(df: DataFrame, slices: int | None, *order: str | Column) -> DataFrame:
    """Rows sorted by ``order`` over all tasks, nulls first, with their task's ``slice``.

    Range-partitioned: the bounds are sampled, a row finds its slice by a binary search,
    and adaptive execution sets the number of slices from the size of the data unless one
    is given. Slices are ascending, and some may have no rows. Only rows equal in all of
    ``order`` are sure to share a slice. The numbers hold within a job: write them with
    what is derived from the rows.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    named = df.withColumns({f"_order_{i}": key for i, key in enumerate(keys)})
    names = [f"_order_{i}" for i in range(len(keys))]
    dealt = named.repartitionByRange(slices, *names) if slices else named.repartitionByRange(*names)
    return dealt.sortWithinPartitions(*names).drop(*names).withColumn("slice", F.spark_partition_id())


def ordered(work: Workspace, df: DataFrame, name: str, *order: str, slices: int | None = None) -> DataFrame:
    """Rows in one order as a written table with ``slice`` and ``place``.

    As :func:`ranged`; places ascend over all slices, and ``place`` divided by 2**33 is
    the slice.
    """
    numbered = ranged(df, slices, *order).withColumn("place", F.monotonically_increasing_id())
    return work.save(numbered, name)


def counted_out(df: DataFrame, *keys: str) -> DataFrame:
    """A row for each of the ``n`` rows that a row with different ``keys`` stands for.

    Adds ``number`` from 1. A row that stands for many is dealt to several tasks.
    """
    few = df.filter(F.col("n") <= MANY).withColumn("number", F.explode(F.sequence(F.lit(1), F.col("n"))))
    parts = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / MANY))
    part = df.filter(F.col("n") > MANY).withColumn("_part", F.explode(parts)).repartition(*keys, "_part")
    last = F.least(F.col("n"), (F.col("_part") + 1) * MANY)
    many = part.withColumn("number", F.explode(F.sequence(F.col("_part") * MANY + 1, last)))
    return few.unionByName(many.select(*few.columns))


def last_at_most(bounds: Column, count: int, value: Column) -> Column:
    """The place of the last of ``count`` ascending bounds that is not above a value.

    A binary search: its cost grows with the logarithm of the number of bounds. Values
    below the first bound are at 0.
    """
    start = F.struct(F.lit(0).alias("low"), F.lit(max(count, 1)).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        below = F.get(bounds, middle) <= value
        return F.when(
            at["high"] - at["low"] <= 1, at
        ).otherwise(
            F.struct(F.when(below, middle).otherwise(at["low"]).alias("low"), F.when(below, at["high"]).otherwise(middle).alias("high"))
        )

    steps = F.array_repeat(F.lit(0), max(count, 1).bit_length())
    return F.aggregate(steps, start, halve)["low"]


def count_slices(table: DataFrame) -> int:
    """How many slices a written table of :func:`ordered` has."""
    return (table.agg(F.max("slice")).first()[0] or 0) + 1


def one_task_a_slice(df: DataFrame, slices: int, *order: str | Column) -> DataFrame:
    """Rows with a ``slice``, each slice sorted in a task of its own."""
    return df.repartitionById(slices, "slice").sortWithinPartitions(*order)
