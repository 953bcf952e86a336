"""Encoder, token store and packing against the tokenizers library itself."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickloom.llm import ffd_packing, slices, token_store
from clickloom.llm.tokens import encoder
from clickloom.llm.workspace import Workspace

NAMES = (token_store.TOKENIZER, ffd_packing.TOKENIZER)


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def ids_of(encode, text, end):
    return np.array(encode(text or "") + [end], "<u4")


@pytest.mark.parametrize("name", NAMES)
def test_encoder_equals_library(name):
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab A.,'s!?\n \té1²-_ñ́ßΣİ") for _ in range(draw.randint(1, 30))) for _ in range(4000)]
    texts += ["<|endoftext|> a <|endoftext|>", "x" * 5000, "", " ", "\n", "a. b? c!", "ΑΣ ΑΣ. İstanbul"]
    encode = library(name)
    for text in texts:
        assert np.frombuffer(encoder(name).encode(text), "<u4").tolist() == encode(text), text


def test_store_of_documents(spark, documents):
    path = f"{Workspace(spark, 'test').path}/store"
    token_store.write_store(documents, path)
    found = sorted(map(tuple, token_store.token_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    start, expected, encode = 0, [], library(token_store.TOKENIZER)
    for row in documents.orderBy("doc_id").collect():
        ids = ids_of(encode, row.text, 0)
        expected.append((row.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected
    assert token_store.read_document(spark, path, 17) == [ids_of(encode, documents.filter("doc_id = 17").first().text, 0).tolist()]


def test_store_of_odd_rows(spark, odd, empty):
    path = f"{Workspace(spark, 'test').path}/store"
    token_store.write_store(odd, path, slices=3)
    rows = token_store.token_index(spark, path).orderBy("start").collect()
    encode = library(token_store.TOKENIZER)
    ordered = odd.collect()
    ordered.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    assert [r.doc_id for r in rows] == [r.doc_id for r in ordered]
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(ids_of(encode, r.text, 0).tobytes()) for r in ordered]
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    none = f"{Workspace(spark, 'test').path}/store"
    token_store.write_store(empty, none)
    assert token_store.token_index(spark, none).count() == 0


def test_block_refuses_another_dictionary():
    block = next(token_store._write([], b"", token_store.TOKENIZER, 0), None)
    assert block is None
    with pytest.raises(ValueError):
        token_store.document_ids({"dictionary": "0", "offsets": [0], "payload": b""}, 0, b"")


def test_first_fit_equals_plain_search():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 300):
        lengths = draw.integers(1, 101, n)
        bins, offsets = ffd_packing.first_fit_decreasing(lengths, 100)
        room, expected = [], np.zeros(n, int)
        for i in np.argsort(-lengths, kind="stable"):
            at = next((b for b, free in enumerate(room) if free >= lengths[i]), len(room))
            room += [100] if at == len(room) else []
            room[at] -= lengths[i]
            expected[i] = at
        assert bins.tolist() == expected.tolist()


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_packing(which, request):
    docs = request.getfixturevalue(which)
    rows = ffd_packing.pack(docs, group_pieces=64).collect()
    encode = library(ffd_packing.TOKENIZER)
    made, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        made[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(int)
    for row in docs.collect():
        ids = ids_of(encode, row.text, 1)
        for at in range(0, len(ids), 2048):
            piece = ids[at : at + 2048]
            expected[(row.doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert made == expected
    for pieces in sequences.values():
        pieces.sort()
        ends = np.cumsum([length for _, length in pieces])
        assert [offset for offset, _ in pieces] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    if which == "documents":
        assert sum(r.length for r in rows) / (2048 * len(sequences)) > 0.95
    again = ffd_packing.pack(docs.repartition(5), group_pieces=64).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_equal_pieces_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(slices, "MANY", 100)
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, 1, id) AS doc_id", "IF(id % 3 = 0, 'the same', 'word ' || id) AS text")
    rows = ffd_packing.pack(docs, group_pieces=256).collect()
    assert len(rows) == 3000
    groups = Counter(r.sequence_id >> 32 for r in rows if r.doc_id == 1)
    assert len(groups) == 12 and max(groups.values()) < 200
