from __future__ import annotations

import hashlib
import itertools
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from clickloom.llm import conversation_repair as repair
from clickloom.llm import repair_steps as steps
from oddities import CLASHING

LAYOUT = "conv_id long, turn long, role string, text string"


def cheapest(turns):
    """(cost, audit, lines) by trying every way. ``turns`` are (role, text)."""
    seen, faults = set(), []
    for role, text in turns:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "b" if not visible else "d" if (role, text) in seen else "t" if visible[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    ways = {0: [(0, "", ())]}  # by initials of what is kept, as a state
    follow = {0: 2, 1: 2, 2: 3, 3: 2}
    names = {2: "user", 3: "assistant"}

    def with_inserts(found):
        best = {}
        for _ in range(3):
            for state, some in list(found.items()):
                best.setdefault(state, []).extend(some)
                best.setdefault(follow[state], []).extend(
                    (c + 3, a + "I", (*kept, (names[follow[state]], ""))) for c, a, kept in some
                )
            found = {s: [min(set(w))] for s, w in best.items()}
        return found

    for (role, text), fault in zip(turns, faults):
        found = {}
        for state, some in with_inserts(ways).items():
            for cost, audit, kept in some:
                found.setdefault(state, []).append((cost + 4, audit + "D", kept))
                if fault in "bd" and fault:
                    continue
                more = 3 * (fault == "t")
                own = {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)
                if (own == 1 and state == 0) or (own > 1 and follow[state] == own):
                    found.setdefault(own, []).append((cost + more, audit + "K", (*kept, (role, text))))
                to = follow[state]
                found.setdefault(to, []).append((cost + 3 + more, audit + "R", (*kept, (names[to], text))))
        ways = {s: [min(set(w))] for s, w in found.items()}
    ends = with_inserts(ways)
    return min(w for s in (0, 3) for w in ends.get(s, []))


def expected(turns):
    cost, audit, kept = cheapest(turns)
    text = "\n".join(f"{role}:{text}" for role, text in kept)
    return cost, audit, hashlib.sha256(text.encode()).hexdigest()


def report(spark, rows, layout=LAYOUT):
    df = spark.createDataFrame(rows, layout)
    return {r.conv_id: r for r in repair.repair_report(df, df).collect()}


WORDS = [("system", "Be kind."), ("user", "Hi."), ("user", "No end"), ("assistant", "Yes!"), ("tool", "x?"), ("user", " ")]


def test_every_short_conversation_against_brute_force(spark):
    """All sequences of up to four turns of six kinds, as conversations of one table."""
    sequences = [s for n in range(1, 5) for s in itertools.product(WORDS, repeat=n)]
    rows = [(i, t, role, text) for i, s in enumerate(sequences) for t, (role, text) in enumerate(s)]
    found = report(spark, rows)
    assert len(found) == len(sequences)
    for i, sequence in enumerate(sequences):
        assert (found[i].cost, found[i].audit, found[i].repaired_sha256) == expected(sequence), sequence


@pytest.mark.parametrize("slices", [1, 8])
def test_a_conversation_over_many_slices(spark, slices):
    """A third of all rows is one conversation; its edits do not depend on how it is cut."""
    kinds = [w for w in WORDS if w[1] != " "]
    chosen = lambda i: kinds[(i * i + i // 7) % len(kinds)]
    long = [(role, f"{i % 90} {text}") for i, (role, text) in enumerate(map(chosen, range(600)))]
    rows = [(5, t, role, text) for t, (role, text) in enumerate(long)]
    rows += [(100 + i, t, *kinds[(i + t) % 5]) for i in range(300) for t in range(4)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "true" if slices == 1 else "false")
    try:
        found = report(spark, rows)
    finally:
        spark.conf.unset(key)
    assert (found[5].cost, found[5].audit, found[5].repaired_sha256) == expected(long)
    assert found[5].duplicate == 600 - len(set(long)) and found[5].gaps == 0
    for i in range(300):
        want = expected([kinds[(i + t) % 5] for t in range(4)])
        assert (found[100 + i].cost, found[100 + i].audit, found[100 + i].repaired_sha256) == want


def test_runs_pass_by_binary_powers():
    for sign in range(9):
        one = ((0,), (1,), (2,), (3,))
        for count in range(40):
            assert steps.passed(sign, count, ((0,), (1,), (2,), (3,))) == one
            one = steps.times(steps.power(sign, 0), one)
    assert len(steps.runs_of([(1, 1), (1, 1), (0, 5), (0, 1), (1, 2)])) == 3


ODD = [
    (1, 0, "user", "Hello."),
    (1, 0, "user", "Hello."),
    (1, 3, None, None),
    (1, None, "assistant", "First, without a turn."),
    (2, None, None, None),
    (None, 7, "user", "No id!\n\t "),
    (None, 9, "assistant", "Yes"),
    (3, 1, "", "An empty role?"),
    (3, 2, "u\n:x", "snow ☃ 雪 😀 ." + " " * 50_000),
    (4, 5, "system", "Only this."),
    (6, -4, "user", "x." * 30_000),
    (6, 2**40, "assistant", "y."),
]


def sql_rows(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    columns = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    return sorted(con.execute(f"SELECT {columns} FROM ({repair.SQL})").fetchall(), key=str)


@pytest.mark.parametrize("rows", [ODD, ODD * 3, [(9, t, "user", "same.") for t in range(60)], []])
def test_odd_rows_equal_sql(spark, tmp_path, rows):
    """Nulls, ties, repeated rows, clashing columns; queried through a written table."""
    table = spark.createDataFrame(rows, LAYOUT)
    names = [*CLASHING, "place", "letters", "first", "copies", "digest", "slice", "fault", "copy", "entry", "_conv"]
    table = table.withColumns({n: F.lit("x") for n in names if n not in table.columns})
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    found = sorted(map(tuple, repair.query(spark, str(tmp_path)).collect()), key=str)
    assert found == sql_rows(rows)


def test_equals_sql(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = sorted(map(tuple, repair.query(spark, small).collect()), key=str)
    assert found == sql_rows([tuple(r) for r in rows])


def test_repaired_turns_follow_the_pattern(spark, small):
    conversations = spark.read.parquet(f"{small}/conversations.parquet")
    rows = repair.damage(conversations)
    work = repair.Workspace(spark, "test")
    lines = repair.repaired(rows, repair.plan_repair(rows, work)[1])
    turns = lines.select("conv_id", "place", F.posexplode("lines").alias("at", "turn"))
    initials = {}
    for r in turns.orderBy("conv_id", "place", "at").collect():
        initials[r.conv_id] = initials.get(r.conv_id, "") + r.turn.role[:1]
    assert initials and all(re.fullmatch("(s?(ua)+)?", text) for text in initials.values())
