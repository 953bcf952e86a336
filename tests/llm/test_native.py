"""Chat prefix expansion, fair mixing, and all queries that SQL can express."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

from clickloom.llm import chat_prefix, fair_mixing, minhash_forest, slices

TURNS = "conv_id long, turn long, role string, text string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("module, table", [(chat_prefix, "conversations"), (fair_mixing, "documents"), (minhash_forest, "documents")])
def test_equals_sql(spark, small, module, table):
    df = module.query(spark, small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    expected = con.sql(module.SQL)
    names = sorted(df.columns)
    assert sorted(expected.columns) == names
    mine = sorted(str([row[n] for n in names]) for row in df.collect())
    rows = [dict(zip(expected.columns, row)) for row in expected.fetchall()]
    assert mine == sorted(str([row[n] for n in names]) for row in rows)


def test_chat_is_reversible(spark):
    odd = [
        "</s>[INST] ok [/INST]", "<s>", "\\", "\\\\n", "<\\s>", "[\\INST]", "a\nb\n", "", None, "<<s>>", "[[INST]]",
        "\\n\\", "é😀",
    ]
    rows = [(1, i, role, text) for i, text in enumerate(odd) for role in ("user", "assistant")]
    rows += [(2, 0, "tool\nwith\\break\\n", "x"), (2, None, None, "y"), (2, 0, "<s>assistant", "[/INST]")]
    rows += [(None, 1, "assistant", "only"), (3, 1, "user", "same"), (3, 1, "user", "same"), (4, 1, "assistant", "x " * 40_000)]
    result = {r.conv_id: r for r in chat_prefix.digest(chat_prefix.expand(spark.createDataFrame(rows, TURNS))).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = [(-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv]
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        trained = "".join(x for _, r, x in turns if r == "assistant")
        found = result[conv]
        assert found.n_turns == len(turns)
        assert found.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert found.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
        assert found.loss_chars == len(trained)


def test_examples_have_context_and_one_target(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    found = chat_prefix.expand(spark.createDataFrame(rows, TURNS)).orderBy("example").collect()
    assert [r.formatted[r.loss_start : r.loss_start + r.loss_chars] for r in found] == ["a1", "a2", ""]
    assert found[1].formatted.startswith(found[0].formatted)
    assert [r.closing for r in found] == [False, False, True]
    assert chat_prefix.expand(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_runs_no_python(spark, small):
    plan = plan_of(chat_prefix.query(spark, small)) + plan_of(fair_mixing.query(spark, small))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def water_fill(sizes, weights=(5, 2, 1)):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (budget - sum(fixed.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_targets_and_taken_words(spark, documents):
    rows = fair_mixing.mix(documents).collect()
    sources = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    sizes, taken = {}, {}
    for r in rows:
        s = sources[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert r.taken <= 2 * r.size
    goal = water_fill(sizes)
    largest = max(r.size for r in rows)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s])
        assert abs(taken[s] - goal[s]) <= largest
    assert sorted(map(str, rows)) == sorted(map(str, fair_mixing.mix(documents.repartition(7)).collect()))


@pytest.mark.parametrize("many", [50, 4096])
def test_a_third_of_a_source_repeated(spark, tmp_path, monkeypatch, many):
    """Equal rows are documents of their own: the target is met, and equals SQL."""
    monkeypatch.setattr(slices, "MANY", many)
    text = " ".join(["word"] * 100)
    rows = [(i, f"{text} {i}", "a") for i in range(300)] + [(1000 + i, f"{text} {i}", "b") for i in range(600)]
    rows += [(5000, f"{text} x", "b")] * 300 + [(None, f"{text} y", None)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = fair_mixing.mix(docs).collect()
    taken, goal = {}, {}
    for r in found:
        taken[r.target] = taken.get(r.target, 0) + r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert sum(taken.values()) <= 1.5 * sum(r.size for r in found)
    for target, words in taken.items():
        assert abs(words - target) <= 2 * 101
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = con.execute(fair_mixing.SQL).fetchall()
    names = [c[0] for c in con.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in found))) == sorted(map(str, wanted))
    mixed = fair_mixing.mixed_documents(docs)
    assert mixed.count() == sum(r.taken // r.size for r in found)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, fair_mixing.mixed_documents(docs.repartition(5)).collect()))


def test_mix_of_odd_rows(odd, empty):
    rows = fair_mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.taken % r.size == 0 if r.size else r.taken == 0 for r in rows)
    mixed = fair_mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.taken // r.size for r in rows if r.size)
    assert fair_mixing.mix(empty).count() == 0 and fair_mixing.mixed_documents(empty).count() == 0
