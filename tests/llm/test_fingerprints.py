"""Merkle fingerprints and vector sharding against plain computations."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from clickloom.llm import merkle, vector_sharding


@pytest.mark.parametrize("which, slices", [("documents", 8), ("odd", 3), ("odd", 1)])
def test_fingerprints(which, slices, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = map(merkle.fingerprint, (text, changed, following))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        expected.append((doc_id, len(text), digest, a, b, merkle.likeness(a, b), merkle.likeness(a, c)))
    found = [tuple(r) for r in merkle.fingerprints(docs, slices).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_single_row_and_no_row(spark, empty):
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    row = merkle.fingerprints(one).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert merkle.fingerprints(empty).count() == 0


def test_tree_locates_edits():
    lines = [f"paragraph number {i} of the text\n" for i in range(60)]
    changed = lines.copy()
    changed[31] = "another paragraph altogether\n"
    a, b = merkle.fingerprint("".join(lines)), merkle.fingerprint("".join(changed))
    found = merkle.edits(a, b)
    sections = merkle.tree(a)[1]
    place = [sum(len(leaves) for _, leaves in sections[:s]) + p for s, p in found]
    assert place == [31]
    assert 0.9 < merkle.likeness(a, b) < 1 and merkle.likeness(a, b) == merkle.likeness(b, a)
    inserted = merkle.fingerprint("".join(lines[:10] + ["new line\n"] + lines[10:]))
    assert merkle.edits(a, inserted) == [] and len(merkle.edits(inserted, a)) == 1
    assert merkle.likeness(a, merkle.fingerprint("nothing in common")) == 0.0
    assert merkle.fingerprint(None) == merkle.fingerprint("")
    text = "a line\r\nlong " + "sentence one. Two? three! " * 40 + "\n\nend"
    assert "".join(merkle.paragraphs(text)) == text


def test_edits_of_long_lines_move_few_leaves():
    draw = np.random.default_rng(2)
    chinese = "".join(map(chr, draw.integers(0x4E00, 0x9FA0, 6000)))
    stops = "。".join(chinese[at : at + 23] for at in range(0, 6000, 23))
    log = " ".join(f"{n:x}=[{n % 97}]" for n in draw.integers(0, 2**40, 400))
    code = "".join(f"f{n}(x{n % 7});" for n in draw.integers(0, 10**6, 500))
    for text in (chinese, stops, log, code, "x" * 6000):
        assert "".join(merkle.paragraphs(text)) == text
        assert max(map(len, merkle.paragraphs(text))) <= merkle.LONG_LINE
        for at in (0, 1000, 3000):
            changed = text[:at] + "y" + text[at:]
            a, b = merkle.fingerprint(text), merkle.fingerprint(changed)
            assert merkle.likeness(a, b) > 0.9
            assert len(merkle.edits(a, b)) <= 8


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_shards(which, request):
    docs = request.getfixturevalue(which)
    rows = vector_sharding.assign(docs).collect()
    expected = sorted(
        str((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))) for r in docs.collect()
    )
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_balanced_and_split_hot_groups(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same text' ELSE repeat(concat('w', id, ' '), 1 + id % 40) END AS text"
    )
    rows = vector_sharding.assign(docs).collect()
    size, count, of = defaultdict(int), defaultdict(int), defaultdict(set)
    for r in rows:
        size[r.shard] += r.size
        count[r.shard] += 1
        of[r.text_crc32].add(r.shard)
    assert len(size) == 40
    assert max(size.values()) < 1.05 * sum(size.values()) / 40
    assert max(count.values()) < 1.1 * 6000 / 40
    assert sum(len(shards) > 1 for shards in of.values()) == 1


def test_placement_equals_a_plain_loop():
    draw = np.random.default_rng(6)
    for _ in range(20):
        demands = draw.random((int(draw.integers(1, 80)), 3)) / 40
        residual = np.full((5, 3), 0.2)
        left, expected = residual.tolist(), {}
        for i in sorted(range(len(demands)), key=lambda i: (-max(demands[i]), i)):
            dots = [sum(float(a) * b for a, b in zip(demands[i], room)) for room in left]
            expected[i] = max(range(5), key=lambda b: (round(dots[b], 12), -b))
            left[expected[i]] = [b - float(a) for a, b in zip(demands[i], left[expected[i]])]
        assert vector_sharding.place(demands, residual).tolist() == [expected[i] for i in range(len(demands))]


def test_bytes_of_shards_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    size = defaultdict(int)
    for r in vector_sharding.assign(docs).collect():
        size[r.shard] += r.size
    mean = sum(size.values()) / 40
    print(f"shards of {min(size.values()) / mean:.3f} to {max(size.values()) / mean:.3f} of the mean")
    assert len(size) == 40 and max(size.values()) < 1.1 * mean and min(size.values()) > 0.9 * mean


def test_fingerprint_equals_a_plain_computation():
    """Leaves, sections and root from their definition, on texts of short lines."""
    digest = lambda data: hashlib.blake2b(data, digest_size=16)
    draw = np.random.default_rng(8)
    for n in (0, 1, 7, 200):
        lines = [f"line {draw.integers(0, 50)}\n" for _ in range(n)]
        sections, leaves = [], []
        for line in lines:
            leaves.append((digest(line.encode()), len(line)))
            if leaves[-1][0].digest()[0] % merkle.SECTION_CYCLE == 0:
                sections.append(leaves)
                leaves = []
        sections += [leaves] if leaves else []
        marks = [digest(b"".join(leaf.digest() for leaf, _ in some)) for some in sections]
        body = ";".join(
            f"{mark.hexdigest()[: merkle.DIGITS]}="
            + ",".join(f"{leaf.hexdigest()[: merkle.DIGITS]}:{size}" for leaf, size in some)
            for mark, some in zip(marks, sections)
        )
        root = digest(b"".join(mark.digest() for mark in marks)).hexdigest()
        assert merkle.fingerprint("".join(lines)) == f"{root}/{body}"


def test_no_rows_no_shards(empty):
    assert vector_sharding.assign(empty).count() == 0
