"""The pipeline stage by stage, against the operators' definitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from clickloom.llm import fair_mixing, language_gru, minhash_forest, registry, toxicity_chain


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_duplicates", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, small)
        after = after.cache() if name == "packing" else after
        if name != "packing":
            assert after.columns == docs.columns
        ids = sorted(r.doc_id for r in after.select("doc_id").collect())
        given = sorted(r.doc_id for r in before.select("doc_id").collect())
        if name == "language_id":
            rows = language_gru.predict(before, *language_gru.fit(before)).collect()
            assert ids == sorted(r.doc_id for r in rows if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SCORE)
            assert len(ids) > 0.95 * len(given)
        elif name == "toxicity":
            labels = spark.read.parquet(f"{small}/labels.parquet")
            rows = toxicity_chain.score(before, toxicity_chain.fit(before, labels)).collect()
            assert ids == sorted(r.doc_id for r in rows if not r.toxic)
        elif name == "near_duplicates":
            assert ids == sorted({r.class_id for r in minhash_forest.join(before).collect()})
        elif name == "mixing":
            rows = fair_mixing.mix(before).collect()
            assert ids == sorted(r.doc_id for r in rows if r.size for _ in range(r.taken // r.size))
        else:
            starts = sorted(r.doc_id for r in after.filter("start = 0").select("doc_id").collect())
            assert starts == given
        before = after


def test_run_and_registration(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
    names = set(contract.queries())
    assert {"pipeline", *registry.OPERATORS} <= names and len(registry.OPERATORS) == 13
    assert set(registry.oracle_sql()) == {
        "op1_chat_prefix",
        "op3_minhash_forest",
        "op10_fair_mixing",
        "op11_conversation_repair",
        "op12_pivot_links",
        "op13_hard_negatives",
    }


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_run_on_odd_and_empty_tables(spark, small, tmp_path, which, request):
    docs = request.getfixturevalue(which)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{small}/labels.parquet").withColumns({"text": F.lit("x"), "marks": F.lit("x")})
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    first = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(first) == (which == "odd")
    assert {r.doc_id for r in first} <= {r.doc_id for r in docs.select("doc_id").collect()}
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
