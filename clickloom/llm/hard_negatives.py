"""Hard-negative mining by an inverted multi-index, exact.

Vectors are in blocks; within a block two half-space codebooks form cells, and an anchor
visits them by falling bounds until no cell left can change its windows. So every block
gives its own best rows, certified, and the best of those are the best of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import multi_index
from clickloom.llm.sampling import by_hash
from clickloom.llm.workspace import Workspace

POSITIVES = 5
NEGATIVES = 5
#: Percent of the positive's score that a negative must reach.
LEAST_SHARE = 80
#: Vectors that the codebooks are fitted to, and those and anchors that a task holds.
SAMPLE = 4096
BLOCK = 8192
ANCHORS = 256


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label (shifted where vec_id is divisible by 7) and integer components."""
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & parts.isNotNull() & finite)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(
        "vec_id",
        shifted.alias("label"),
        F.size(parts).alias("dim"),
        F.transform(parts, lambda x: F.floor(x * 256)).alias("parts"),
    )


def _classes(rows: DataFrame, work: Workspace, kept: int) -> DataFrame:
    """Rows equal in label and components, with the least ids that a result can hold."""
    same = ["label", "dim", "parts"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))
    least = rows.distinct().withColumn("place", place).filter(F.col("place") <= kept)
    grouped = least.groupBy(*same).agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    return work.save(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _codebooks(classes: DataFrame) -> dict[int, tuple]:
    """Codebooks of every length of vectors, from a bounded sample."""
    sample = by_hash(classes, SAMPLE, "label", "parts").select("dim", "parts").toPandas()
    return {int(dim): multi_index.fit_codebooks(np.stack(rows.to_numpy())) for dim, rows in sample.groupby("dim")["parts"]}


def _search(books, windows_of, same_label: bool):
    """A task's work: the windows of its anchors over its block of the index."""

    def search(key, anchors: pa.Table, index: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and index.num_rows:
            vectors, wanted = _matrix(index["parts"]), _matrix(anchors["parts"])
            dim = vectors.shape[1]
            none = np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))  # a length without a sample
            cells = multi_index.MultiIndex(vectors, books.get(dim, none))
            labels, members = index["label"].to_numpy(), index["members"].to_pylist()
            classes = {c: i for i, c in enumerate(index["id"].to_pylist())}
            columns = (anchors[c].to_pylist() for c in ("anchor_id", "class", "own", "highs"))
            for row, (anchor, own, label, highs) in enumerate(zip(*columns)):
                allowed = (labels == label) == same_label
                seen = members
                if own in classes:  # its own row is no candidate
                    seen = members.copy()
                    seen[classes[own]] = [m for m in members[classes[own]] if m != anchor]
                windows = windows_of(highs)
                multi_index.fill(cells, wanted[row], windows, allowed, seen)
                found += [(anchor, own, w.high, m, -s) for w in windows for s, m in w.best]
        columns = list(zip(*found)) or [[]] * 5
        names = ["anchor_id", "class", "high", "vec_id", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return search


def _blocks(classes: DataFrame, by: list[str]) -> DataFrame:
    """Classes dealt to blocks of about BLOCK, by the given columns and a hash."""
    sizes = classes.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return classes.join(sizes, by).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


def _asked(anchors: DataFrame, index: DataFrame, by: list[str]) -> DataFrame:
    """Anchors for every block of the index they are compared with, in groups."""
    blocks = index.groupBy(*by).agg(F.max("blocks").alias("blocks"))
    asking = anchors.groupBy(*by).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("askers"))
    return (
        anchors.join(blocks, by)
        .join(asking, by)
        .withColumn("asker", F.pmod(F.xxhash64("anchor_id", "class", F.lit(1)), F.col("askers")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )


def _best(anchors: DataFrame, index: DataFrame, by: list[str], search, size: int) -> DataFrame:
    """The best rows of every window over all blocks; ``anchors`` of these are written."""
    keys = [*by, "block", "asker"]
    groups = anchors.select(*(F.col(k).alias(k) for k in keys)).distinct()  # attributes of their own
    held = index.join(groups, [*by, "block"])  # a block for every group of anchors
    found = (
        anchors.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInArrow(search, "anchor_id long, class long, high long, vec_id long, score long")
    )
    order = Window.partitionBy("anchor_id", "class", "high").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def _low(high: int) -> int:
    return -(-LEAST_SHARE * high // 100)


def mine(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on vec_id. Scores are integer inner products of
    components floor(256 * x). An anchor's positives are its best other rows of the same
    label; for each the best rows of other labels whose score is between 80 and 100
    percent of the positive's. Ties go to smaller ids. Exact: nothing is left out.

    Rows without id, label or vector, and with null or non-finite components, take no
    part; vectors of another length than the anchor's are not compared with it; rows
    equal in id, label and vector count once. Equal vectors of a label are indexed once.
    Anchors without positives, and positives without negatives, have no rows; an empty
    table gives none. Inner products beyond 64 bits count as the nearest 64-bit number.
    Other columns are ignored.
    """
    work = Workspace(vectors.sparkSession, "negatives")
    rows = work.save(prepared(vectors), "rows")
    classes = _classes(rows, work, max(POSITIVES + 1, NEGATIVES))
    books = _codebooks(classes)
    same = ["label", "dim", "parts"]
    anchors = work.save(
        rows.filter(is_anchor)
        .distinct()
        .join(classes.select(*same, F.col("id").alias("class")), same)
        .select(F.col("vec_id").alias("anchor_id"), "class", F.col("label").alias("own"), *same),
        "anchors",
    )
    nothing = F.lit(None).cast("array<bigint>")
    by = ["dim", "label"]
    index = work.save(_blocks(classes, by), "by_label")
    positives = work.save(
        _best(
            work.save(_asked(anchors.withColumn("highs", nothing), index, by), "seeking"),
            index,
            by,
            _search(books, lambda highs: [multi_index.Window(None, None, POSITIVES)], True),
            POSITIVES,
        ),
        "positives",
    )
    positive = positives.select(
        "anchor_id", "class", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    highs = positive.groupBy("anchor_id", "class").agg(
        F.sort_array(F.collect_set("positive_score")).alias("highs")  # POSITIVES at most
    )
    index = work.save(_blocks(classes, ["dim"]), "by_length")
    negatives = _best(
        work.save(_asked(anchors.join(highs, ["anchor_id", "class"]), index, ["dim"]), "mining"),
        index,
        ["dim"],
        _search(books, lambda highs: [multi_index.Window(_low(h), h, NEGATIVES) for h in highs], False),
        NEGATIVES,
    ).withColumnRenamed("high", "positive_score")
    return positive.join(negatives, ["anchor_id", "class", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CASE WHEN len(a.parts) = len(v.parts) THEN list_inner_product(a.parts, v.parts)::BIGINT END AS score
  FROM a JOIN v ON a.vec_id <> v.vec_id AND len(a.parts) = len(v.parts)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
