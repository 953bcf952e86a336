"""Near-duplicate vectors and hard negatives against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import hard_negatives, multi_index, pivot_links
from oddities import CLASHING

LAYOUT = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [
    (0, [1.0, 0.0, 0.5], 0),
    (0, [1.0, 0.0, 0.5], 0),
    (100, [1.0, 0.1, 0.5], 0),
    (100, [0.9, 0.1, 0.5], 0),
    (200, [0.9, 0.1, 0.5], 1),
    (1, [0.0, 0.0, 0.0], 0),
    (2, None, 0),
    (3, [1.0, None, 0.5], 0),
    (4, [1.0, NAN, 0.5], 0),
    (5, [1.0, INF, 0.5], 0),
    (6, [1.0, 0.0, 0.5], None),
    (None, [1.0, 0.0, 0.5], 0),
    (7, [1.0, 0.0], 0),
    (8, [1.0, 0.01], 0),
    (9, [], 0),
    (10, [1e30, 0.0, 5e29], 0),
    (-14, [-1.0, 0.0, -0.5], 3),
    (300, [1.0, 0.0, 0.5], 2),
    (11, [0.9, 0.0, 0.4], 2),
]


def table(spark, rows, folder):
    df = spark.createDataFrame(rows, LAYOUT)
    names = [*CLASHING, "class", "rank", "pivot", "near", "ranks", "dim", "parts", "first", "valid"]
    df = df.withColumns({n: F.lit("x") for n in names if n not in df.columns})
    df.write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def by_sql(sql, rows, columns):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    if rows:
        con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    return sorted(con.execute(f"SELECT {columns} FROM ({sql})").fetchall(), key=str)


def made(rows, seed=0, labels=3, groups=()):
    """Random unit vectors with dense groups of (size, noise)."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(rows, 32))
    at = 0
    for size, noise in groups:
        vectors[at : at + size] = vectors[at] / np.linalg.norm(vectors[at]) * 5 + rng.normal(size=(size, 32)) * noise
        at += size
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    marks = rng.integers(0, labels, rows)
    marks[:at] = 0
    return [(i, v.tolist(), int(m)) for i, (v, m) in enumerate(zip(vectors, marks))]


LINKS = "vec_id, n_links, component_id, kept"
TABLES = {
    "odd": ODD,
    "none": [],
    "one": ODD[:1],
    "even": made(700),
    "dense": made(900, 1, groups=[(300, 0.3), (60, 0.2), (30, 0.05)]),
    "copies": made(40) * 9,
}


@pytest.mark.parametrize("name", TABLES)
def test_links_equal_sql(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(pivot_links, "BLOCK", 64)
    rows = TABLES[name]
    found = pivot_links.query(spark, table(spark, rows, tmp_path))
    assert sorted(map(tuple, found.select(*LINKS.split(", ")).collect()), key=str) == by_sql(pivot_links.SQL, rows, LINKS)


def test_most_links_are_found_at_any_size(spark, monkeypatch):
    """Recall against brute force, on pairs around the similarity."""
    rows = made(6000, 3, labels=2, groups=[(1500, 0.24), (400, 0.25)] + [(4, 0.24)] * 500)
    df = spark.createDataFrame(rows, LAYOUT)
    found = {r.vec_id: r.n_links for r in pivot_links.link(df).collect()}
    vectors = np.array([r[1] for r in rows])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    near = (vectors @ vectors.T >= pivot_links.SIMILARITY) & (labels[:, None] == labels)
    links = near.sum(axis=1) - 1
    assert links.sum() > 10_000 and sorted(found) == list(range(6000))
    assert all(found[i] <= n for i, n in enumerate(links))
    assert sum(found.values()) >= 0.999 * links.sum()


def test_descriptions_are_short_and_pivots_apart():
    vectors = np.array([r[1] for r in made(4000, groups=[(1000, 0.2)])])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    pivots = pivot_links.spread(vectors[::10], 0.93)
    near = pivots @ pivots.T - 2 * np.eye(len(pivots))
    assert near.max() < 2 * 0.93**2 - 1 and len(pivots) < 320
    chosen = pivot_links.choose(vectors, pivots, 0.93)
    assert chosen.lists <= chosen.length < len(pivots) / 4


def test_similarity_must_be_a_cosine(spark):
    with pytest.raises(ValueError):
        pivot_links.link(spark.createDataFrame([], LAYOUT), 1.5)


NEGATIVES = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"


@pytest.mark.parametrize("name", TABLES)
@pytest.mark.parametrize("block", [16, 8192])
def test_negatives_equal_brute_force(spark, tmp_path, monkeypatch, name, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rows = TABLES[name]
    found = hard_negatives.query(spark, table(spark, rows, tmp_path))
    found = sorted(map(tuple, found.select(*NEGATIVES.split(", ")).collect()), key=str)
    assert found == mined(rows)


def mined(rows):
    parts = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        parts[(vec_id, label, tuple(int(np.clip(np.floor(256.0 * np.float32(x)), -(2**63), 2**63 - 1)) for x in vector))] = None
    found = []
    for anchor in [p for p in parts if p[0] % 100 == 0]:
        scores = []
        for other in parts:
            if other != anchor and len(other[2]) == len(anchor[2]):
                whole = sum(a * b for a, b in zip(anchor[2], other[2]))
                scores.append((-min(max(whole, -(2**63)), 2**63 - 1), other[0], other[1]))
        scores.sort()
        for score, positive, _ in [s for s in scores if s[2] == anchor[1]][:5]:
            inside = [s for s in scores if s[2] != anchor[1] and 80 * -score <= 100 * -s[0] <= 100 * -score][:5]
            found += [(anchor[0], positive, r, n, -score, -s) for r, (s, n, _) in enumerate(inside, 1)]
    return sorted(found, key=str)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_queries_equal_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    for module, columns in ((hard_negatives, NEGATIVES), (pivot_links, LINKS)):
        found = module.query(spark, folder).select(*columns.split(", ")).collect()
        assert sorted(map(tuple, found), key=str) == by_sql(module.SQL, rows, columns)


def test_cells_come_in_falling_order_and_hold_every_row():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-200, 200, (500, 8))
    index = multi_index.MultiIndex(vectors, multi_index.fit_codebooks(vectors[:100]))
    for query in rng.integers(-200, 200, (20, 8)):
        visited = list(index.visit(query))
        bounds = [b for b, _, _ in visited]
        assert bounds == sorted(bounds, reverse=True)
        assert sorted(np.concatenate([r for _, r, _ in visited])) == list(range(500))
        for bound, rows, scores in visited:
            assert (scores == vectors[rows] @ query).all() and scores.max() <= bound


def test_a_certified_window_leaves_cells_out():
    """Where vectors are in groups, most of them are never scored."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 300
    vectors = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 16)) * 5).astype(int)
    index = multi_index.MultiIndex(vectors, multi_index.fit_codebooks(vectors[::7]))
    members = [[i] for i in range(4000)]
    scored = 0
    for query in vectors[::250]:
        window = multi_index.Window(None, None, 5)
        scored += multi_index.fill(index, query, [window], np.ones(4000, bool), members)
        exact = sorted((-int(s), i) for i, s in enumerate(vectors @ query))[:5]
        assert window.best == exact
    assert scored < 0.5 * 16 * 4000
