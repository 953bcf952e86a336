"""Shards by vector bin packing: bytes, tokens and rows in balance at once.

Rows with equal texts are a group and go to one shard. A group's demand is the vector of
its bytes, tokens and rows as shares of the total; it goes where the dot product of
demand and residual capacity is highest, largest groups first. Groups above a share of a
shard, of which there is a bounded number, are placed first, and those too big for
balance in several parts. All others are dealt into cells; each cell packs its groups
into its share of what the shards have left, so cells work independently.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.slices import ordered
from clickloom.llm.workspace import Workspace

SHARDS = 40
#: Bytes of a row besides its text.
ROW_BYTES = 16
#: Share of a shard, in any dimension, above which a group is placed on its own.
LARGE = 1 / 32
#: Share of a shard above which a group is split.
TOO_LARGE = 1 / 2
CELL_GROUPS = 4096
DIMENSIONS = ("bytes", "tokens", "rows")


def place(demands: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The bin of every demand vector; ``residual`` (bins x dimensions) is used up.

    Largest demands go first, ties in the order given; equal dot products go to the
    first bin.
    """
    bins = np.zeros(len(demands), np.int64)
    for i in np.argsort(-demands.max(axis=1), kind="stable") if len(demands) else ():
        bins[i] = best = int(np.argmax(residual @ demands[i]))
        residual[best] -= demands[i]
    return bins


def _place_cell(groups: pd.DataFrame, residual: np.ndarray, totals: np.ndarray) -> pd.DataFrame:
    groups = groups.sort_values(["key", "part"], ignore_index=True)
    demands = groups[list(DIMENSIONS)].to_numpy(float) / totals
    own = np.clip(residual, 1e-12, None)
    groups["shard"] = place(demands, own / own.sum(axis=0) * demands.sum(axis=0)).astype("int32")
    return groups[["key", "part", "shard"]]


def _parts(items: DataFrame, totals: np.ndarray, shards: int) -> DataFrame:
    """Items with their part: 0, or one of several for the groups above TOO_LARGE."""
    share = F.greatest(*(F.sum(d) / F.lit(float(t)) for d, t in zip(DIMENSIONS, totals))) * shards
    hot = items.groupBy("key").agg(share.alias("share")).filter(F.col("share") > TOO_LARGE)
    parts = {row.key: int(np.ceil(row.share / TOO_LARGE * 2)) for row in hot.collect()}  # at most 6 x shards
    if not parts:
        return items.withColumn("part", F.lit(0))
    table = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))
    spread = F.xxhash64("doc_id", "row")
    return items.withColumn(
        "part", F.coalesce(F.pmod(spread, F.try_element_at(table, "key")), F.lit(0)).cast("int")
    )


def assign(docs: DataFrame, shards: int = SHARDS, slices: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot.

    Size is the text's UTF-8 bytes, none if null, plus ROW_BYTES; slots count from 0 in
    a shard by doc_id, null first. Null texts are equal to one another; repeated rows
    are members of one group; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "sharding")
    blank = F.lit("")
    text = F.coalesce("text", blank)
    tokens = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long")
    items = work.save(
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("bytes"),
            tokens.alias("tokens"),
            F.lit(1).cast("long").alias("rows"),
            F.crc32(text).alias("text_crc32"),
            F.coalesce(F.md5("text"), blank).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "items",
    )
    sums = items.agg(*(F.sum(d).alias(d) for d in DIMENSIONS)).first()
    totals = np.array([max(sums[d] or 0, 1) for d in DIMENSIONS], float)
    parted = work.save(_parts(items, totals, shards), "parted")
    groups = work.save(
        parted.groupBy("key", "part").agg(*(F.sum(d).alias(d) for d in DIMENSIONS)), "groups"
    )
    share = F.greatest(*(F.col(d) / F.lit(float(t)) for d, t in zip(DIMENSIONS, totals))) * shards
    large = groups.filter(share > LARGE).orderBy("key", "part").collect()  # at most 3 x shards / LARGE
    residual = np.full((shards, len(DIMENSIONS)), 1 / shards)
    demands = np.array([[row[d] for d in DIMENSIONS] for row in large], float).reshape(-1, 3) / totals
    chosen = [(row.key, row.part, int(b)) for row, b in zip(large, place(demands, residual))]
    small = groups.filter(share <= LARGE)
    cells = max(1, -(-small.count() // CELL_GROUPS))
    kind = "key string, part int, shard int"
    placed = (
        small.withColumn("cell", F.pmod(F.xxhash64("key", "part"), F.lit(cells)))
        .groupBy("cell")
        .applyInPandas(lambda cell: _place_cell(cell, residual, totals), kind)
        .unionByName(spark.createDataFrame(chosen, kind))
    )
    found = work.save(parted.join(work.save(placed, "placed"), ["key", "part"]), "found")
    return _with_slots(found, work, slices)


def _with_slots(found: DataFrame, work: Workspace, slices: int | None) -> DataFrame:
    """Number the rows of a shard: counts of slices first, then within a slice.

    Rows with one doc_id, or equal ones, spread over slices like any others.
    """
    sliced = ordered(work, found, "ordered", "doc_id", "key", "row", slices=slices)
    earlier = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    starts = counts.select(
        "shard", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("shard", "slice").orderBy("place")
    return (
        sliced.withColumn("number", F.row_number().over(within))
        .join(starts, ["shard", "slice"])
        .select(
            "doc_id",
            F.col("bytes").alias("size"),
            "text_crc32",
            "shard",
            (F.col("before") + F.col("number") - 1).alias("slot"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
