"""Nearest neighbours by inner product through learned partitions.

Every distinct vector is indexed in its most probable part; parts that are large are cut
again, so their size stays the same as the table grows. A query goes to its several most
probable parts and is compared there with every vector, in double precision.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import neighbour_router
from clickloom.llm.sampling import by_hash
from clickloom.llm.workspace import Workspace

NEAREST = 20
#: The router is fitted to about so many distinct vectors, chosen by hash.
SAMPLE = 8192
#: Vectors of a part above which it is cut again, and the most parts of one cut.
LEAF = 65_536
FANOUT = 64
#: Recall on left-out sample vectors that sets the number of parts a query searches.
RECALL = 0.95
#: Vectors, and queries, that a task holds.
BLOCK = 4096


def _valid(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a finite vector that isn't zero, of the most common length."""
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.filter(F.col("vec_id").isNotNull() & parts.isNotNull() & finite)
    rows = rows.filter(F.exists(parts, lambda x: x != 0))
    lengths = rows.groupBy(F.size(parts).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(parts) == (lengths.n if lengths else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _child(code: int, part: int) -> int:
    """The number of a part of a node; the root is 0."""
    return code * FANOUT + part + 1


def _totals(sizes: dict[int, int]) -> dict[int, int]:
    """Vectors below every node, from those of the leaves."""
    found: dict[int, int] = {}
    for code, count in sizes.items():
        found[code] = found.get(code, 0) + count
        while code:
            code = (code - 1) // FANOUT
            found[code] = found.get(code, 0) + count
    return found


def routes(vectors: np.ndarray, routers: dict, held: dict[int, int] | None = None):
    """(rows, leaves): every vector's most probable leaf, or with ``held`` those it searches.

    ``routers`` are the inner nodes of a tree by number. A search goes from each node to
    as many parts as its router's recall asks for, and on until they hold enough vectors.
    """
    rows_found, leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    work = [(0, np.arange(len(vectors)))]
    while work:
        code, rows = work.pop()
        router = routers.get(code)
        if router is None:
            rows_found.append(rows)
            leaves.append(np.full(len(rows), code, np.int64))
            continue
        chances = router.chances(vectors[rows])
        order = np.argsort(-chances, axis=1, kind="stable")
        width = np.full(len(order), 1 if held is None else router.probes)
        if held is not None:
            counts = np.array([held.get(_child(code, part), 0) for part in range(order.shape[1])])
            width = np.maximum(width, (np.cumsum(counts[order], axis=1) < NEAREST + 1).sum(axis=1) + 1)
        taken = np.arange(order.shape[1])[None, :] < width[:, None]
        for part in range(order.shape[1]):
            some = rows[((order == part) & taken).any(axis=1)]
            if len(some):
                work.append((_child(code, part), some))
    return np.concatenate(rows_found), np.concatenate(leaves)


def _routed(batches, routers, held=None):
    """id, embedding and part; a row for each of the leaves that are searched."""
    for batch in batches:
        if batch.num_rows:
            rows, leaves = routes(_matrix(batch.column("embedding")), routers, held)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("embedding").take(at), pa.array(leaves)],
                names=["id", "embedding", "part"],
            )


def _fit_part(recall: float):
    def fit(key, table):
        router = neighbour_router.fit(_matrix(table["embedding"]).astype(np.float32), recall)
        return pa.table({"part": pa.array([key[0].as_py()]), "router": pa.array([pickle.dumps(router)], pa.binary())})

    return fit


def _tree(classes: DataFrame, recall: float) -> tuple[dict, dict[int, int]]:
    """(routers by node, sizes of leaves): parts are cut again while they are large.

    A part above LEAF is cut like the whole: a bounded sample of its vectors, its own
    neighbour graph and router, fitted by a task of its own. What comes to the driver
    are the routers, one for some sixteen leaves or more, of about 50 KB.
    """
    sample = by_hash(classes, SAMPLE, "embedding").select("embedding").orderBy(F.xxhash64("embedding")).toArrow()
    if not sample.num_rows:
        return {}, {}
    levels = 1 + max(0, math.ceil(math.log(max(classes.count() / LEAF / 16, 1), 16)))
    each = recall ** (1 / levels)
    routers = {0: neighbour_router.fit(_matrix(sample.column("embedding")).astype(np.float32), each)}
    whole: set[int] = set()  # large parts that their sample does not cut
    while True:
        kind = "id long, embedding array<double>, part long"
        homes = classes.select("id", "embedding").mapInArrow(lambda b: _routed(b, dict(routers)), kind)
        counts = homes.groupBy("part").count()
        sizes = {row.part: row["count"] for row in counts.collect()}  # a row for each leaf
        large = {part: n for part, n in sizes.items() if n > LEAF and part not in whole}
        if not large:
            return routers, sizes
        shares = [(part, int(SAMPLE / n * 2**31)) for part, n in large.items()]
        drawn = F.pmod(F.xxhash64(F.lit(len(routers)), "embedding"), F.lit(2**31)) < F.col("share")
        chosen = homes.join(classes.sparkSession.createDataFrame(shares, "part long, share long"), "part").filter(drawn)
        fitted = chosen.select("part", "embedding").groupBy("part").applyInArrow(_fit_part(each), "part long, router binary")
        found = {row.part: pickle.loads(row.router) for row in fitted.collect()}
        cut = {part: router for part, router in found.items() if router.layers[-1].size > 1}
        whole |= set(large) - set(cut)
        routers |= cut


def _compare(key, queries: pd.DataFrame, index: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The best of a block of the index for each query of a block, copies among them."""
    found = []
    if len(queries) and len(index):
        vectors = np.stack(index["embedding"].to_numpy())
        members = index["members"].to_numpy()
        for row in range(0, len(queries), 256):
            some = queries.iloc[row : row + 256]
            wanted = np.stack(some["embedding"].to_numpy())
            scores = wanted @ vectors.T
            kept = min(nearest, scores.shape[1])
            least = -np.partition(-scores, kept - 1, axis=1)[:, kept - 1]
            close = scores >= (least - 1e-9 * (1 + np.abs(least)))[:, None]
            for query, vector, near in zip(some["id"], wanted, close):
                at = np.flatnonzero(near)
                exact = (vectors[at] * vector).sum(axis=1)
                rows = [(-s, int(m)) for s, i in zip(exact, at) for m in members[i]]
                found += [(query, member, -s) for s, member in sorted(rows)[:nearest]]
    return pd.DataFrame(found, columns=["id", "vec_id", "score"]).astype(
        {"id": "int64", "vec_id": "int64", "score": "float64"}
    )


def search(vectors: DataFrame, is_query, nearest: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found for each query row.

    ``is_query`` is a condition on vec_id. Rows without an id, and vectors null, zero or
    with null or non-finite components, take no part, nor do vectors of another length
    than the most common one. Equal vectors are indexed once, with the least ids that a
    result can hold; rows equal in id and vector count once. Rows with one id and different
    vectors are queries of their own, and no candidates for each other. A query without other
    candidates has no rows, as has an empty table. Other columns are ignored.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "partitions")
    rows = work.save(_valid(vectors), "rows")
    lists = nearest + 1
    first = Window.partitionBy("embedding").orderBy("vec_id")
    classes = work.save(
        rows.distinct()
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= lists)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    routers, sizes = _tree(classes, recall)
    if not routers:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "id long, embedding array<double>, part long"
    homes = classes.select("id", "embedding").mapInArrow(lambda b: _routed(b, routers), kind)
    index = work.save(homes.join(classes.select("id", "members"), "id"), "index")
    held = _totals(sizes)
    asked = work.save(rows.filter(is_query).distinct().join(classes.select("embedding", "id"), "embedding"), "asked")
    routed = work.save(
        asked.select("id", "embedding")
        .dropDuplicates(["id"])
        .mapInArrow(lambda b: _routed(b, routers, held), kind),
        "queries",
    )
    asking = {row.part: row["count"] for row in routed.groupBy("part").count().collect()}
    plan = spark.createDataFrame(
        [(p, -(-sizes[p] // BLOCK), -(-asking.get(p, 1) // BLOCK)) for p in sizes], "part long, blocks int, askers int"
    )
    own = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")
    other = F.pmod(F.xxhash64("id", F.lit(2)), F.col("askers")).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    members = index.join(plan, "part").withColumn("block", own).withColumn("asker", every("askers"))
    sent = routed.join(plan, "part").withColumn("asker", other).withColumn("block", every("blocks"))
    keys = ["part", "block", "asker"]
    compared = (
        sent.select("id", "embedding", *keys)
        .groupBy(*keys)
        .cogroup(members.select("id", "embedding", "members", *keys).groupBy(*keys))
        .applyInPandas(lambda key, q, i: _compare(key, q, i, lists), "id long, vec_id long, score double")
    )
    best = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    top = compared.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= lists)
    entry = F.struct("place", "vec_id", "score")
    lists_ = top.groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("near"))
    queries = asked.select(F.col("vec_id").alias("query_id"), "id")
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        queries.join(work.save(lists_, "nearest"), "id")
        .select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("place", "found"))
        .select(
            "query_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            "found.vec_id",
            "found.score",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
