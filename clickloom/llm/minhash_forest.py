"""N-gram Jaccard join: a MinHash LSH forest of sorted prefix tries, then verification.

1. Texts with equal sets of word shingles are one class; all else is done per class.
2. A class has one label of MinHash values in each of several prefix tries. Classes that
   share the shortest prefix of the search stand together, sorted by the rest of their
   labels. The shortest prefix is the longest at which a pair at the least similarity is
   found with the target recall.
3. A class is matched at its whole label first. Its matched prefix is then shortened value
   by value, as long as the shorter prefix adds classes that it is not yet connected with
   and down to the shortest one. Pairs that the whole signatures rule out are dropped;
   the others are kept as spanning edges, not as pairs, and connected into candidate
   groups.
4. In a group of at most a block, every pair is verified on its whole shingle sets. Of two
   blocks of a larger group only those classes are, that met a likely partner of the other
   block in some node, so a chain of half-similar texts costs about its number of such
   meetings. Counts of links and spanning edges of the verified links leave the task, again
   no pairs.

Crowded nodes and groups are split into blocks, and a task compares two blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.batches import portions, releasing
from clickloom.llm.components import components
from clickloom.llm.workspace import Workspace

WORDS = 5
SIMILARITY = 0.8
TREES, LABEL = 20, 6
#: Chance that a pair at the least similarity meets in a node of some trie.
RECALL = 0.9999
#: Chance that the signatures of a pair at the least similarity agree in too few values.
MISS = 1e-6
#: Classes of a block.
BLOCK = 512

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(5).integers(0, 2**63, TREES * LABEL, np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_length(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The longest prefix of a label that reaches the recall; none is shortened further."""
    for length in range(LABEL, 0, -1):
        if 1 - (1 - similarity**length) ** TREES >= recall:
            return length
    raise ValueError(f"{TREES} trees do not reach a recall of {recall} at similarity {similarity}")


def least_agreeing(similarity: float = SIMILARITY, miss: float = MISS) -> int:
    """Values of a signature in which all but a share ``miss`` of pairs at the similarity agree."""
    n, below = TREES * LABEL, 0.0
    for agreeing in range(n + 1):
        below += math.comb(n, agreeing) * similarity**agreeing * (1 - similarity) ** (n - agreeing)
        if below > miss:
            return agreeing
    return n


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of runs of words, sorted; a shorter text is one run."""
    parts = (text or "").split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    length = min(words, len(parts))
    runs = np.zeros(len(parts) - length + 1, np.uint64)
    for i in range(length):
        runs = runs * np.uint64(0x100000001B3) + hashed[i : i + len(runs)]
    return np.unique(_mixed(runs))


def signature(found: np.ndarray) -> np.ndarray:
    """The least value under each of the hash functions, 32 bits."""
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (found[at : at + 2048, None] * _ODD).min(axis=0), out=least)
    return least >> np.uint64(32)


def nodes_of(values: np.ndarray, length: int) -> np.ndarray:
    """A number for the trie node of each tree's prefix."""
    labels = values.reshape(TREES, LABEL)
    at = np.arange(1, TREES + 1, dtype=np.uint64)
    for i in range(length):
        at = _mixed(at * np.uint64(0x100000001B3) + labels[:, i])
    return at.view(np.int64)


def rests_of(values: np.ndarray, length: int) -> np.ndarray:
    """The values of each tree's label behind the prefix: (trees, LABEL - length)."""
    return values.reshape(TREES, LABEL)[:, length:]


def class_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _sketch(batches, words: int, length: int):
    for batch in portions(batches):
        keys, sizes, nodes, rests, signs = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text, words)
            sizes.append(len(found))
            keys.append(class_key(found) if len(found) else None)
            values = signature(found)
            nodes.append(nodes_of(values, length).tolist() if len(found) else [])
            rest = rests_of(values, length).astype(">u4")
            rests.append([row.tobytes() for row in rest] if len(found) else [])
            signs.append(values.astype(np.uint8).tobytes())
        types = [pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary()]
        made = [pa.array(v, t) for v, t in zip((keys, sizes, nodes, rests, signs), types)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("at"), *made],
            names=["doc_id", "at", "key", "size", "nodes", "rests", "sign"],
        )


def _runs(batches, keys: int) -> Iterator[pa.Table]:
    """Whole groups, several at once, of rows sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        last = batch.num_rows
        while last and all(c[last - 1] == c[-1] for c in columns):
            last -= 1
        if last == 0 and held and all(
            held[-1].column(i)[-1].as_py() == batch.column(i)[0].as_py() for i in range(keys)
        ):
            held.append(batch)
            continue
        held.append(batch.slice(0, last))
        yield pa.Table.from_batches(held)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _borders(columns: list[np.ndarray]) -> np.ndarray:
    changed = np.zeros(max(0, len(columns[0]) - 1), bool)
    for column in columns:
        changed |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [len(columns[0])]])


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the given edges connect, each to the first of its part."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(left.tolist(), right.tolist()):
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    return [(i, find(i)) for i in range(n) if find(i) != i]


def descend(rests: np.ndarray, signs: np.ndarray, sides: np.ndarray | None, least: int) -> list[tuple[int, int, int]]:
    """Spanning edges (i, j, values) between the classes of a node that may be similar.

    ``rests`` has the values of the labels behind the node's prefix, a row for each class,
    sorted. Classes are matched at whole labels, then at ever shorter ones; ``values`` is
    the number behind the prefix at which an edge was found. Classes that are connected
    already are not compared again, so a class whose company is all connected with it
    is not shortened further. With ``sides`` only classes of different sides are compared.
    """
    n, width = rests.shape
    part = np.arange(n)
    edges = []
    for values in range(width, -1, -1):
        borders = _borders([rests[:, v] for v in range(values)]) if values else np.array([0, n])
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
            if b - a < 2 or (part[a:b] == part[a]).all():
                continue
            for i in range(a, b - 1):
                apart = part[i + 1 : b] != part[i]
                if sides is not None:
                    apart &= sides[i + 1 : b] != sides[i]
                others = np.flatnonzero(apart) + i + 1
                if not len(others):
                    continue
                near = others[(signs[others] == signs[i]).sum(axis=1) >= least]
                for j in near.tolist():
                    if part[i] != part[j]:
                        edges.append((i, j, values))
                        part[part == part[j]] = part[i]
    return edges


def _likely(table_runs, least: int):
    """Spanning edges between classes of a node whose signatures may be similar."""
    for table in table_runs:
        if not table.num_rows:
            continue
        node, pair, own, other, ids = (table.column(i).to_numpy() for i in range(5))
        signs = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8)
        signs = signs.reshape(len(ids), -1)
        rests = np.frombuffer(b"".join(table.column(6).to_pylist()), ">u4")
        rests = rests.reshape(len(ids), len(rests) // len(ids))
        edges = []
        borders = _borders([node, pair])
        for a, b in zip(borders[:-1], borders[1:]):
            sides = own[a:b] if own[a] != other[a] else None
            found = descend(rests[a:b], signs[a:b], sides, least)
            edges += [(int(ids[a + i]), int(ids[a + j])) for i, j, _ in found]
        names = ["a", "b"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*edges) if edges else ((), ()))], names=names
        )


def _block_of(blocks) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(7)), blocks).cast("int")


def _pair_of(own: str, other: str) -> Column:
    return F.least(own, other).cast("long") * 2**31 + F.greatest(own, other)


def _block_pairs(rows: DataFrame, count: str) -> DataFrame:
    """Send a row to all pairs of blocks of its group that hold its block."""
    blocks = F.ceil(F.col(count) / BLOCK).cast("int")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("own", _block_of(blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("pair", _pair_of("own", "other"))
    )


def _crowded(classes: DataFrame, work: Workspace) -> DataFrame:
    """Rows (node, id, rest, members) of all nodes with more than one class."""
    at = F.explode(F.arrays_zip("nodes", "rests")).alias("at")
    placed = classes.select("id", at).select("id", F.col("at.nodes").alias("node"), F.col("at.rests").alias("rest"))
    crowded = placed.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1")
    return work.save(placed.join(crowded, "node"), "members")


def _candidate_edges(classes: DataFrame, members: DataFrame, least: int) -> DataFrame:
    """Edges (a, b) that connect all classes which may be similar."""
    signed = members.join(classes.select("id", "sign"), "id")
    paired = _block_pairs(signed, "members").select("node", "pair", "own", "other", "id", "sign", "rest")
    sorted_ = paired.repartition("node", "pair").sortWithinPartitions("node", "pair", "rest", "id")
    return sorted_.mapInArrow(lambda batches: releasing(_likely(_runs(batches, 2), least)), "a long, b long")


def meetings(signs, sizes, blocks, sides, least: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a node, by place, and the blocks in which they have a likely partner.

    Partners agree in ``least`` values, and their sizes allow the similarity. With ``sides``
    they are of different sides. Each class and block comes once, however many partners.
    """
    names, place = np.unique(blocks, return_inverse=True)
    met = np.zeros((len(signs), len(names)), bool)
    for i in range(len(signs) - 1):
        likely = np.minimum(sizes[i + 1 :], sizes[i]) >= similarity * np.maximum(sizes[i + 1 :], sizes[i]) - 1e-9
        if sides is not None:
            likely &= sides[i + 1 :] != sides[i]
        others = np.flatnonzero(likely) + i + 1
        others = others[(signs[others] == signs[i]).sum(axis=1) >= least]
        met[i, place[others]] = True
        met[others, place[i]] = True
    at, block = np.nonzero(met)
    return at, names[block]


def _meeting(table_runs, least: int, similarity: float):
    """Rows (label, id, own, other): a class, its block and one that holds a likely partner."""
    for table in table_runs:
        if not table.num_rows:
            continue
        label, node, pair, own, other, ids, block, sizes = (table.column(i).to_numpy() for i in range(8))
        signs = np.frombuffer(b"".join(table.column(8).to_pylist()), np.uint8).reshape(len(ids), -1)
        found = []
        borders = _borders([label, node, pair])
        for a, b in zip(borders[:-1], borders[1:]):
            sides = own[a:b] if own[a] != other[a] else None
            at, there = meetings(signs[a:b], sizes[a:b], block[a:b], sides, least, similarity)
            found.append((label[a + at], ids[a + at], block[a + at], there))
        columns = [np.concatenate(column) for column in zip(*found)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["label", "id", "own", "other"])


def _block_members(chosen, classes, members, work, least, similarity) -> DataFrame:
    """Rows (label, pair, own, other, id): the classes to be compared in a pair of blocks."""
    whole = chosen.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    zero = F.lit(0)
    small = chosen.join(whole.filter("blocks = 1"), "label")
    small = small.select("label", zero.cast("long").alias("pair"), zero.alias("own"), zero.alias("other"), "id")
    large = chosen.join(whole.filter("blocks > 1"), "label").select("label", "id", _block_of(F.col("blocks")).alias("block"))
    large = large.join(classes.select("id", "size", "sign"), "id")
    together = large.select("label", "id").join(members.select("node", "id"), "id")
    together = together.groupBy("label", "node").agg(F.count("*").alias("together")).filter("together > 1")
    placed = large.join(members.select("node", "id"), "id").join(together, ["label", "node"])
    paired = _block_pairs(placed, "together").select(
        "label", "node", "pair", "own", "other", "id", "block", "size", "sign"
    )
    sorted_ = paired.repartition("label", "node", "pair").sortWithinPartitions("label", "node", "pair", "id")
    met = sorted_.mapInArrow(
        lambda batches: releasing(_meeting(_runs(batches, 3), least, similarity)),
        "label long, id long, own int, other int",
    ).distinct()
    large = met.select("label", _pair_of("own", "other").alias("pair"), "own", "other", "id")
    return work.save(small.unionByName(large), "compared")


def _with_shingles(batches, words: int):
    """Replace the text of a row by its shingles, where it is the text of its class."""
    for batch in portions(batches):
        found = [shingles(text, words) for text in batch.column("text").to_pylist()]
        own = [
            class_key(s) == key if len(s) else False for s, key in zip(found, batch.column("key").to_pylist())
        ]
        kept = batch.drop_columns(["text", "key"])
        kept = kept.append_column("shingles", pa.array([s.tobytes() for s in found], pa.binary()))
        yield kept.filter(pa.array(own, pa.bool_()))


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    names, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[place] > 1
    column = (np.cumsum(often > 1) - 1)[place[shared]]
    owner, width = owner[shared], int((often > 1).sum())
    result = np.zeros((n, n), np.float64)
    step = max(256, 8_000_000 // max(1, n))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, width, step):
        a, b = np.searchsorted(column, [at, at + step])
        marks = np.zeros((n, min(step, width - at)), np.float32)
        marks[owner[a:b], column[a:b] - at] = 1
        result += marks @ marks.T
    return result


def _verified(table_runs, similarity: float):
    """Per class of a block pair: its links there, and an edge to the first class it reaches."""
    for table in table_runs:
        if not table.num_rows:
            continue
        group, pair, own, other, ids, copies = (table.column(i).to_numpy() for i in range(6))
        raw = table.column(6).to_pylist()
        rows = []
        borders = _borders([group, pair])
        for a, b in zip(borders[:-1], borders[1:]):
            keep = np.concatenate([[True], ids[a + 1 : b] != ids[a : b - 1]])
            at = np.flatnonzero(keep) + a
            sets = [np.frombuffer(raw[i], np.uint64) for i in at]
            sizes = np.array([len(s) for s in sets], float)
            both = common(sets)
            linked = both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            side = own[at]
            if own[a] != other[a]:
                linked &= side[:, None] != side[None, :]
            links = linked @ copies[at]
            left, right = np.nonzero(np.triu(linked))
            reach = dict(spanning(len(at), left, right))
            rows += [
                (int(ids[i]), int(ids[at[reach.get(k, k)]]), int(links[k])) for k, i in enumerate(at)
            ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((),) * 3)], names=["a", "b", "links"]
        )


def _verify(docs, classes, groups, members, work, words, similarity, least) -> DataFrame:
    """Rows (a, b, links) of all verified block pairs."""
    chosen = groups.join(classes.select("id", "first", "key", "copies"), groups.node == classes.id)
    chosen = work.save(chosen.select("label", "id", "first", "key", "copies"), "chosen")
    compared = _block_members(chosen.select("label", "id"), classes, members, work, least, similarity)
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("at") == F.col("first.at"))
    # chosen classes grow with the documents, so their number must not decide the plan
    texts = docs.join(chosen.select("first", "key", "id", "copies").hint("merge"), same)
    sets = work.save(
        texts.select("id", "copies", "key", "text").mapInArrow(
            lambda b: releasing(_with_shingles(b, words)), "id long, copies long, shingles binary"
        ),
        "shingles",
    ).dropDuplicates(["id"])
    sorted_ = (
        compared.join(sets, "id")
        .select("label", "pair", "own", "other", "id", "copies", "shingles")
        .repartition("label", "pair")
        .sortWithinPartitions("label", "pair", "own", "id")
    )
    return work.save(
        sorted_.mapInArrow(lambda b: releasing(_verified(_runs(b, 2), similarity)), "a long, b long, links long"),
        "verified",
    )


def _linked(docs: DataFrame, words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The sketch of every row, and (key, label, n_links) of every class of equal sets."""
    work = Workspace(docs.sparkSession, "forest")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    length, least = prefix_length(similarity), least_agreeing(similarity)
    kind = "doc_id long, at long, key binary, size int, nodes array<long>, rests array<binary>, sign binary"
    hashed = rows.select("doc_id", "text", F.xxhash64("text").alias("at"))
    sketch = work.save(hashed.mapInArrow(lambda b: releasing(_sketch(b, words, length)), kind), "sketch")
    known = sketch.filter("key IS NOT NULL")
    first = F.min(F.struct("doc_id", "at")).alias("first")
    heads = known.groupBy("key").agg(F.count("*").alias("copies"), first)
    one = known.dropDuplicates(["key"]).select("key", "size", "nodes", "rests", "sign")
    found = heads.join(one, "key").select("key", "copies", "first", "size", "nodes", "rests", "sign")
    classes = work.save(found.withColumn("id", F.monotonically_increasing_id()), "classes")
    members = _crowded(classes, work)
    groups = work.save(components(work, _candidate_edges(classes, members, least), "candidate"), "groups")
    verified = _verify(hashed, classes, groups, members, work, words, similarity, least)
    labels = work.save(components(work, verified.select("a", "b"), "linked"), "linked")
    links = verified.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    found = (
        classes.select("id", "key", "copies")
        .join(labels.select(F.col("node").alias("id"), "label"), "id", "left")
        .join(links, "id", "left")
    )
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    per_class = found.select("key", F.coalesce("label", "id").alias("label"), n_links.alias("n_links"))
    return sketch, work.save(per_class, "per_class")


def join(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id and n_links.

    ``n_links`` is the number of other documents whose shingle set has a Jaccard
    similarity of at least ``similarity``, copies counted one by one. ``class_id`` is the
    least doc_id that links connect a document with. Documents of less than ``words``
    words are one run of words; those without words (null, empty, blank) link to nothing.
    A null doc_id takes part; a class of such rows alone has a null class_id. Repeated
    rows are documents of their own; an empty table gives no rows; other columns are
    ignored. A similarity at which one value a tree misses RECALL (below 0.37) is an error.
    """
    sketch, per_class = _linked(docs, words, similarity)
    rows = sketch.select("doc_id", "key").join(per_class, "key", "left")
    least = sketch.select("doc_id", "key").join(per_class, "key").groupBy("label")
    least = least.agg(F.min("doc_id").alias("class_id")).withColumnRenamed("label", "of")
    return rows.join(least, F.col("label") == F.col("of"), "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The document with the least id of every class, all columns.

    Rows equal in id and text are one document, and which of them stays follows from all
    columns; documents without words all stay.
    """
    sketch, per_class = _linked(docs, words, similarity)
    of = F.coalesce(F.col("label").cast("string"), F.concat_ws("/", F.lit("none"), "doc_id", "at"))
    chosen = sketch.join(per_class, "key", "left").groupBy(of.alias("of"))
    chosen = chosen.agg(F.min(F.struct("doc_id", "at")).alias("first"))
    # keys without null, so that the texts are dealt once for both the join and the copies
    keys = ["id", "missing", "at"]
    named = lambda doc_id, at: [
        F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"),
        doc_id.isNull().alias("missing"),
        at.alias("at"),
    ]
    chosen = chosen.select(*named(F.col("first.doc_id"), F.col("first.at")))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, *named(F.col("doc_id"), F.xxhash64("text")))
    kept = rows.join(chosen.hint("merge"), keys, "left_semi")
    return kept.groupBy(*keys).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '\S+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS run
  FROM d),
n AS (SELECT r, count(*) AS runs FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.run = b.run AND a.r < b.r GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b
  WHERE 10 * shared >= 8 * (x.runs + y.runs - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT r, r AS root FROM d UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.r),
k AS (SELECT c.r, min(d.doc_id) AS class_id FROM c JOIN d ON d.r = c.root GROUP BY c.r),
m AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY a)
SELECT d.doc_id, k.class_id, coalesce(m.n_links, 0)::BIGINT AS n_links
FROM d JOIN k USING (r) LEFT JOIN m USING (r)
"""
