"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by the reference points (pivots) nearest to it, in order. Vectors
that share enough of them are retrieved through inverted pivot lists and compared by
their cosine in double precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.sampling import by_hash
from clickloom.llm.workspace import Workspace

SIMILARITY = 0.93
#: Pivots for each square root of the number of vectors. With lists of k of m pivots a
#: pair of unlike vectors meets with a chance of about k * k / m, so the work grows with
#: the power 1.5 of the number of vectors, and what is sent to tasks with the power 0.5.
PIVOTS = 4
#: Share of pairs at just the similarity that must share enough pivots.
RECALL = 0.9995
#: Planted pairs at just the similarity, and linked pairs of a sample of as many vectors,
#: from which the length of descriptions is taken.
PLANTED = 4096
#: Numbers of shared pivots to choose from.
SHARED = (1, 2, 3, 4, 5)
#: Vectors of a list that are compared at once.
BLOCK = 1024


@dataclass
class Description:
    """How vectors are described: so many nearest pivots, of which so many are shared."""

    length: int
    shared: int

    @property
    def lists(self) -> int:
        """Lists a vector stands in. Vectors that share ``shared`` of their pivots share
        one at least of the rarest ``lists``, as only shared - 1 are left out."""
        return self.length - self.shared + 1


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow below
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def nearest_pivots(units: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots of every vector, nearest first."""
    near = units @ pivots.T
    length = min(length, near.shape[1])
    some = np.argpartition(-near, length - 1, axis=1)[:, :length]
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def spread(candidates: np.ndarray, similarity: float) -> np.ndarray:
    """Candidates of which no two lie within twice the angle of ``similarity``.

    Members of one dense group would each be near other pivots of that group, by chance.
    """
    least = 2 * similarity**2 - 1
    kept = candidates[:0]
    for start in range(0, len(candidates), 512):
        some = candidates[start : start + 512]
        some = some[(some @ kept.T < least).all(axis=1)]
        near = np.tril(some @ some.T >= least, -1)
        chosen = np.ones(len(some), bool)
        for i in range(len(some)):
            chosen[i] = not (near[i] & chosen).any()
        kept = np.concatenate([kept, some[chosen]])
    return kept


def _planted(sample: np.ndarray, similarity: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Pairs around sample vectors at just the similarity, in random directions."""
    one = sample[rng.integers(0, len(sample), PLANTED)]
    one = _unit(one + rng.normal(size=one.shape) * 0.3 / math.sqrt(one.shape[1]))
    away = rng.normal(size=one.shape)
    away -= (away * one).sum(axis=1, keepdims=True) * one
    size = np.sqrt((away**2).sum(axis=1, keepdims=True))
    return one, similarity * one + math.sqrt(1 - similarity**2) * away / np.where(size > 0, size, 1)


def _hardest(sample: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of the sample that are least alike, PLANTED at most."""
    cosines, pairs = np.zeros(0), np.zeros((0, 2), int)
    for start in range(0, len(sample), 512):
        near = sample[start : start + 512] @ sample.T
        rows, others = np.nonzero(near >= similarity)
        rows, others = (x[rows + start < others] for x in (rows, others))
        cosines = np.concatenate([cosines, near[rows, others]])
        pairs = np.concatenate([pairs, np.stack([rows + start, others], axis=1)])
        least = np.argsort(cosines, kind="stable")[:PLANTED]
        cosines, pairs = cosines[least], pairs[least]
    return sample[pairs[:, 0]], sample[pairs[:, 1]]


def choose(sample: np.ndarray, pivots: np.ndarray, similarity: float, recall: float = RECALL, seed: int = 0):
    """The description with the shortest lists that keeps the recall.

    Measured on planted pairs at just the similarity, and on the linked pairs that the
    sample itself has: closer pairs share more.
    """
    met = []
    for pair in (_planted(sample, similarity, np.random.default_rng(seed)), _hardest(sample, similarity)):
        if len(pair[0]):
            ranks = (np.argsort(np.argsort(-(u @ pivots.T), axis=1, kind="stable"), axis=1) for u in pair)
            met.append(np.sort(np.maximum(*ranks), axis=1))  # a pivot is shared from this length on
    best = None
    for shared in SHARED:
        if shared <= len(pivots):
            needed = (np.sort(later[:, shared - 1]) for later in met)
            length = 1 + max(int(n[math.ceil(recall * len(n)) - 1]) for n in needed)
            if best is None or length - shared + 1 < best.lists:
                best = Description(length, shared)
    return best


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _described(batches, pivots: dict, descriptions: dict):
    """id and its nearest pivots, in order; batches hold vectors of one length each."""
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes):
            rows = pa.array(np.flatnonzero(sizes == dim))
            ids = batch.column("id").take(rows)
            if dim in pivots:
                units = _unit(_matrix(batch.column("embedding").take(rows)))
                near = nearest_pivots(units, pivots[dim], descriptions[dim].length).astype(np.int32)
            else:  # a length of which the sample has none: one list for all
                near = np.full((len(ids), 1), -1, np.int32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), near.shape[1]).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, lists], names=["id", "near"])


def _local_labels(linked: np.ndarray) -> np.ndarray:
    """The least position reachable from every one."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _membership(lists: list[list[int]], number: dict[int, int]) -> np.ndarray:
    found = np.zeros((len(lists), len(number)), np.float32)
    for row, pivots in enumerate(lists):
        for pivot in pivots:
            found[row, number[pivot]] = 1
    return found


def _compare(similarity: float, descriptions: dict):
    """Compare two blocks of a pivot list, or one with itself."""

    def compare(key, table):
        pivot_rank, dim, first, second = (key[i].as_py() for i in (2, 1, 3, 4))
        shared = descriptions[dim].shared if dim in descriptions else 1
        left = np.flatnonzero(table["block"].to_numpy() == first)
        right = np.flatnonzero(table["block"].to_numpy() == second)
        ranks = table["ranks"].to_pylist()
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        vectors = _matrix(table["embedding"].combine_chunks())
        sizes = np.sqrt((vectors**2).sum(axis=1))
        number = {pivot: i for i, pivot in enumerate(sorted({p for some in ranks for p in some}))}
        whole = _membership(ranks, number)
        lists = descriptions[dim].lists if dim in descriptions else 1
        before = _membership([[p for p in some[:lists] if p < pivot_rank] for some in ranks], number)
        # enough pivots in common, and none of an earlier list: that one has the pair
        met = (whole[left] @ whole[right].T >= shared) & (before[left] @ before[right].T == 0)
        if first == second:
            np.fill_diagonal(met, False)
        rows, columns = np.flatnonzero(met.any(axis=1)), np.flatnonzero(met.any(axis=0))
        some, others = left[rows], right[columns]
        cosine = (vectors[some] @ vectors[others].T) / sizes[some][:, None] / sizes[others][None, :]
        near = (cosine >= similarity) & met[np.ix_(rows, columns)]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, some, near @ copies[others])
        if first != second:
            np.add.at(links, others, near.T @ copies[some])
        linked = np.zeros((len(ids), len(ids)), bool)
        linked[np.ix_(some, others)] = near
        label = _local_labels(linked | linked.T)
        kept = links > 0
        return pa.table({"id": ids[kept], "links": links[kept], "root": ids[label][kept]})

    return compare


def _valid():
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & parts.isNotNull()
        & finite
        & F.exists(parts, lambda x: x != 0)
    )


def _pairs_of_lists(classes: DataFrame, work: Workspace, similarity: float) -> DataFrame:
    """id, links (rows of other classes linked) and root, from every block pair met."""
    count = classes.count()
    wanted = max(math.ceil(PIVOTS * math.sqrt(count)), 16)
    # bounded: about 4 * sqrt(rows) vectors, 130,000 of 10^9
    chosen = by_hash(classes, wanted, "label", "embedding").select("dim", "embedding").toPandas()
    tried = by_hash(classes, PLANTED, "label", "embedding", seed=1).select("dim", "embedding").toPandas()
    of_length = lambda found: found.groupby("dim")["embedding"]
    sampled = {int(d): _unit(np.stack(g.to_numpy()).astype(float)) for d, g in of_length(tried)}
    pivots = {int(d): spread(_unit(np.stack(g.to_numpy()).astype(float)), similarity) for d, g in of_length(chosen)}
    descriptions = {d: choose(sampled.get(d, p), p, similarity) for d, p in pivots.items()}
    near = classes.select("id", "dim", "embedding").mapInArrow(
        lambda b: _described(b, pivots, descriptions), "id long, near array<int>"
    )
    described = work.save(classes.join(near, "id"), "described")
    held = described.select("dim", F.explode("near").alias("pivot")).groupBy("dim", "pivot").count()
    rarest: dict[int, dict[int, int]] = {}  # a row for each pivot
    for row in held.orderBy("dim", "count", "pivot").collect():
        places = rarest.setdefault(row.dim, {})
        places[row.pivot] = len(places)

    def ranked(batches):
        for batch in batches:
            rows = zip(batch.column("dim").to_pylist(), batch.column("near").to_pylist())
            ranks = pa.array([sorted(rarest[d][p] for p in some) for d, some in rows], pa.list_(pa.int32()))
            kept = [n for n in batch.schema.names if n != "near"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), ranks], names=[*kept, "ranks"])

    lists = F.lit(1)
    for dim, found in descriptions.items():
        lists = F.when(F.col("dim") == dim, found.lists).otherwise(lists)
    kinds = "id long, dim int, label long, embedding array<double>, copies long, ranks array<int>"
    members = described.select("id", "dim", "label", "embedding", "copies", "near").mapInArrow(ranked, kinds)
    posted = work.save(members.withColumn("pivot", F.explode(F.slice("ranks", F.lit(1), lists))), "posted")
    by = ["label", "dim", "pivot"]
    long = posted.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        posted.join(long, by, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
    )
    keys = [*by, "first", "second"]
    # a list with one vector has no pairs
    columns = ["id", "copies", "ranks", "embedding", "block"]
    return (
        dealt.select(*keys, *columns)
        .groupBy(*keys)
        .applyInArrow(_compare(similarity, descriptions), "id long, links long, root long")
    )


def link(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id and kept: one row for each row of ``vectors``.

    Rows are linked when their labels are equal and not null and their cosine is at least
    ``similarity`` (above 0). Vectors null, zero, or with null or non-finite components,
    rows without id or label, and vectors of different lengths link with nothing; such
    rows have no links and are kept, with their own id as component. Repeated rows are
    vectors of their own, linked with each other. Equal vectors of a label are compared
    once. An empty table gives no rows. Other columns are ignored.

    Pairs are verified, so no link is false. Links that the index misses are those that
    share too few pivots: fewer than 1 in 1,000 of pairs at just the similarity.
    """
    if not 0 < similarity < 1:
        raise ValueError("the similarity must lie between 0 and 1")
    work = Workspace(vectors.sparkSession, "pivots")
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    same = ["label", "embedding"]
    classes = work.save(
        rows.filter(_valid())
        .groupBy(*same)
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
        .withColumn("dim", F.size("embedding"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    found = work.save(_pairs_of_lists(classes, work, similarity), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct()
    labels = components(work, work.save(edges, "edges"), "component")
    grouped = labels.select(F.col("node").alias("id"), F.col("label").alias("component"))
    lows = classes.select("id", "low").join(grouped, "id")
    least = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    facts = (
        classes.join(links, "id", "left")
        .join(grouped.join(least, "component").select("id", "component_id"), "id", "left")
        .select(
            *same,
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "low").alias("component_id"),
        )
    )
    whole = rows.withColumn("valid", _valid())
    linked = whole.filter("valid").join(facts, same).select("vec_id", "n_links", "component_id")
    alone = whole.filter(F.coalesce(~F.col("valid"), F.lit(True))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS n, vec_id, label,
         CASE WHEN vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e
  FROM embeddings),
l AS (
  SELECT a.n AS a, b.n AS b FROM v a JOIN v b
  ON a.label = b.label AND a.n <> b.n
  AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.93 END),
r AS (SELECT n AS a, n AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.n) AS n_links,
       (SELECT min(w.vec_id) FROM r JOIN v w ON r.b = w.n WHERE r.a = v.n) AS component_id,
       v.vec_id IS NOT DISTINCT FROM (SELECT min(w.vec_id) FROM r JOIN v w ON r.b = w.n WHERE r.a = v.n) AS kept
FROM v
"""
