"""The byte network, language identification and the toxicity chain."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import byte_gru, language_gru, toxicity_chain


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = {k: v.astype(float) for k, v in byte_gru.init(3, 3).items()}
    codes, labels = rng.integers(0, 5, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    weights = np.array([1.0, 2, 1, 0.5])
    _, found = byte_gru.gradients(model, codes, labels, weights)
    for name, value in model.items():
        for _ in range(5):
            at = tuple(int(rng.integers(0, min(n, 5))) for n in value.shape)
            losses = []
            for step in (1e-3, -2e-3):
                value[at] += step
                losses.append(byte_gru.gradients(model, codes, labels, weights)[0])
            value[at] += 1e-3
            assert found[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-5)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_gru.query(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(langs[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_of_odd_rows(odd, empty, documents):
    langs, model = language_gru.fit(documents)
    assert langs == ["de", "en", "es", "fr"]
    rows = language_gru.predict(odd, langs, model).collect()
    assert len(rows) == odd.count()
    letters = {r.doc_id: any(map(str.isalpha, r.text or "")) for r in odd.collect()}
    assert all((r.lang_pred == "und") == (not letters[r.doc_id]) for r in rows)
    kept = language_gru.keep_identified(odd, langs, model, 0.0)
    assert kept.schema == odd.schema and kept.count() == sum(r.lang_pred != "und" for r in rows)
    assert language_gru.fit(empty) == ([], {})
    assert language_gru.predict(empty, langs, model).count() == 0
    assert {r.lang_pred for r in language_gru.predict(odd, [], {}).collect()} == {"und"}
    assert {r.lang_pred for r in language_gru.predict(odd, ["en"], {}).collect()} == {"und", "en"}


def test_language_sample_is_the_least_hashes(documents, monkeypatch):
    """The bounded search for the sample finds what sorting all hashes would."""
    monkeypatch.setattr(language_gru, "SAMPLE_DOCS", 7)
    taught = []
    monkeypatch.setattr(byte_gru, "train", lambda codes, labels, *rest: taught.append((codes, labels)))
    langs, _ = language_gru.fit(documents.union(documents))
    rows = documents.select("doc_id", "text", "lang", F.xxhash64("text").alias("at")).collect()
    known = {(r.lang, r.at, r.text) for r in rows if r.text and r.lang and zlib.crc32(str(r.doc_id).encode()) % 5}
    wanted = set()
    for lang in langs:
        for _, _, text in sorted(x for x in known if x[0] == lang)[:7]:
            data = text.lower().encode()
            at = np.linspace(0, max(0, len(data) - language_gru.SAMPLE_BYTES), language_gru.SAMPLE_CHUNKS).astype(int)
            wanted |= {(lang, data[i : i + language_gru.SAMPLE_BYTES].ljust(language_gru.SAMPLE_BYTES)) for i in at}
    codes, labels = taught[0]
    assert {(langs[k], codes[:, i].tobytes()) for i, k in enumerate(labels)} == wanted


def test_share_of_hashes():
    assert language_gru._share_of_hashes(1.0) == language_gru._share_of_hashes(3.0) == 2**63 - 1
    assert language_gru._share_of_hashes(0.5) == 0 and language_gru._share_of_hashes(0.25) == -(2**62)


def test_chunks_lose_no_accuracy(spark):
    """Fresh states every CHUNK bytes label held-out texts as well as states kept far longer."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, model = language_gru.fit(docs)
    held = docs.filter(language_gru.fold_of(F.col("doc_id")) == 0).filter("text <> '' AND lang IS NOT NULL")
    rows = held.select("text", "lang").collect()
    right = {}
    for chunk in (language_gru.CHUNK, 4096):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(language_gru, "CHUNK", chunk)
            found = language_gru._label([r.text for r in rows], langs, model)
        right[chunk] = sum(lang == r.lang for (lang, *_), r in zip(found, rows)) / len(rows)
    assert right[language_gru.CHUNK] >= right[4096] - 0.005


def test_positions_cover_the_text(documents):
    _, model = language_gru.fit(documents)
    texts = [b"", b"a", b"x" * 128, b"the words of a text " * 50]
    rows = language_gru.position_probabilities(model, texts)
    assert [len(r) for r in rows] == [len(t) for t in texts]
    assert all(np.allclose(r.sum(axis=1), 1, atol=1e-4) for r in rows)


def test_toxicity_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity_chain.query(spark, folder).join(labels.select("doc_id", "toxic").withColumnRenamed("toxic", "y"), "doc_id")
    rows = found.select("toxic", "y").collect()
    toxic, clean = [r.toxic for r in rows if r.y == 1], [r.toxic for r in rows if r.y == 0]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.005


def test_toxicity_on_documents_that_it_was_not_fitted_to(spark):
    """Five folds by doc_id: each fifth is judged by a chain fitted to the others."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    judged = []
    for fold in range(5):
        own = F.crc32(F.col("doc_id").cast("string")) % 5 == fold
        chain = toxicity_chain.fit(docs, labels.filter(~own))
        found = toxicity_chain.score(docs.filter(own), chain).select("doc_id", "toxic")
        marks = labels.filter(own).select("doc_id", F.col("toxic").alias("y"))
        judged += found.join(marks, "doc_id").select("toxic", "y").collect()
    toxic, clean = [r.toxic for r in judged if r.y == 1], [r.toxic for r in judged if r.y == 0]
    print(f"held out: {np.mean(toxic):.4f} of {len(toxic)} toxic, {np.mean(clean):.4f} of {len(clean)} clean found toxic")
    assert len(toxic) > 100 and np.mean(toxic) > 0.9 and np.mean(clean) < 0.01


def test_network_equals_a_plain_computation():
    """Every position's probabilities, step by step in plain Python."""
    model = byte_gru.init(3, 2, seed=4)
    codes = np.random.default_rng(1).integers(0, 256, (6, 2))
    found = byte_gru.probabilities(model, codes)
    gate = lambda x: 1 / (1 + math.exp(-2 * x))  # noqa: E731  0.5 + 0.5 tanh(x)
    for column in range(2):
        logits = [[float(b) for b in model["bias"][:, 0]] for _ in range(6)]
        for way, order in (("forward", range(6)), ("backward", range(5, -1, -1))):
            table, weights, output = (model[f"{way}_{part}"].tolist() for part in ("input", "state", "output"))
            state = [0.0] * 3
            for t in order:
                given = [row[codes[t, column]] for row in table]
                moved = [sum(w * s for w, s in zip(row, state)) for row in weights]
                reset = [gate(given[i] + moved[i]) for i in range(3)]
                update = [gate(given[3 + i] + moved[3 + i]) for i in range(3)]
                new = [math.tanh(given[6 + i] + reset[i] * moved[6 + i]) for i in range(3)]
                state = [u * s + (1 - u) * n for u, s, n in zip(update, state, new)]
                for c in range(2):
                    logits[t][c] += sum(w * s for w, s in zip(output[c], state))
        for t in range(6):
            whole = [math.exp(x) for x in logits[t]]
            assert np.allclose(found[t, :, column], [w / sum(whole) for w in whole], atol=1e-4)


def test_toxic_passage_in_a_long_clean_text(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    chain = toxicity_chain.fit(docs, labels)
    rows = docs.join(labels, "doc_id").orderBy("doc_id").select("lang", "text", "toxic").collect()
    for lang in ("en", "de", "fr", "es"):
        passages = [r.text for r in rows if r.lang == lang and r.toxic and 300 < len(r.text.split()) < 700]
        longer = (r.text for r in rows if r.lang == lang and not r.toxic and len(r.text.split()) > 300)
        clean = next(text for text in longer if chain.score(text)[-1] < 0.01).split()
        around = " ".join((clean * (10_000 // len(clean) + 1))[:10_000])
        assert chain.score(f"{around} {around}")[-1] < 0.05
        found = [chain.score(f"{around} {passage} {around}")[-1] for passage in passages[:8]]
        assert np.mean(np.array(found) >= toxicity_chain.THRESHOLD) > 0.6


def test_chain_learns_from_unseen_documents_only(spark):
    rng = np.random.default_rng(0)
    words = ["good", "bad", "vile"] + [f"w{i}" for i in range(30)]
    rows, marks = [], []
    for i in range(400):
        rude = i % 4 == 0
        text = " ".join(rng.choice(words[3:], 20)) + (" vile bad" if rude else " good")
        rows.append((i, text))
        marks.append((i, int(not rude), int(rude)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    chain = toxicity_chain.fit(docs, labels)
    assert chain.categories == ("quality", "toxic") and len(chain.weights) == 2
    # the later model has one more input, the probability of the earlier category
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    found = {r.doc_id: r.toxic for r in toxicity_chain.score(docs, chain).collect()}
    assert found == {i: bool(y) for i, _, y in marks}


def test_toxicity_of_odd_rows(spark, odd, empty, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    chain = toxicity_chain.fit(spark.read.parquet(f"{small}/documents.parquet"), labels)
    rows = toxicity_chain.score(odd, chain).collect()
    assert len(rows) == odd.count() and not any(r.toxic for r in rows if r.doc_id in (2, 3))
    kept = toxicity_chain.keep_clean(odd, chain)
    assert kept.schema == odd.schema and kept.count() == sum(not r.toxic for r in rows)
    assert toxicity_chain.score(empty, chain).count() == 0
    nothing = toxicity_chain.fit(empty, labels)
    assert not any(r.toxic for r in toxicity_chain.score(odd, nothing).collect())
    nulls = spark.createDataFrame([(1, None, None), (None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity_chain.fit(odd, nulls).weights == []
