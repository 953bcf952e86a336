"""Conversation structure repair by a run-length dynamic program.

Turns are put into one order over all conversations and cut into slices. A slice gives
the min-plus matrix of each of its stretches (a stretch is a conversation's part in a
slice); a conversation's matrices give the costs to go behind each stretch; and each
stretch unrolls its own edits. So a conversation of any length is spread over slices.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import repair_steps as steps
from clickloom.llm.slices import count_slices, one_task_a_slice, ordered
from clickloom.llm.workspace import Workspace

# White space and the ends of sentences.
WHITE = r"\x20\x09-\x0D"
ENDS = ".!?"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by a hash of their conversation and turn."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    fault = F.crc32(F.encode(key, "UTF-8")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        fault.alias("fault"),
    ).filter("fault <> 0")
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _normal(rows: DataFrame) -> DataFrame:
    """Rows with their key: the text stands for itself only in the last step."""
    space = F.lit(" ")
    text = F.coalesce("text", space)
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", space).alias("role"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        text.alias("text"),
    )


def _turns(rows: DataFrame, work: Workspace) -> DataFrame:
    """A row for each different (conversation, turn, role, text), in slices, without text.

    Columns: copies; first (no earlier turn has this role and text); blank; cut (the last
    visible character ends no sentence); place, which orders all turns; slice.
    """
    text = F.col("text")
    facts = rows.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (~text.rlike(f"[^{WHITE}]")).alias("blank"),
        (~text.rlike(rf"[{ENDS}][{WHITE}]*\z")).alias("cut"),
    )
    key = ["conv_id", "turn", "role", "digest"]
    turns = work.save(facts.groupBy(*key, "blank", "cut").agg(F.count("*").alias("copies")), "turns")
    # every row is joined with at most one, so a text that is often said is no hot key
    said = turns.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
    earliest = said.select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")), "at.turn")
    earliest = earliest.withColumnRenamed("turn", "_turn").withColumn("first", F.lit(True))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    marked = turns.join(earliest, same, "left").select(
        *turns.columns, F.coalesce("first", F.lit(False)).alias("first")
    )
    return ordered(work, marked, "ordered", *key)


_TURN = ["conv_id", "turn", "role", "copies", "first", "blank", "cut", "place"]


def _stretches(batches, columns):
    """(key columns, lists of the other columns) of neighbours in one conversation."""
    held, key = None, None
    for batch in batches:
        data = batch.to_pydict()
        for row in zip(*(data[c] for c in columns)):
            if held is None or row[0] != key:
                if held:
                    yield key, held
                held, key = [], row[0]
            held.append(row[1:])
    if held:
        yield key, held


def _signs(turns) -> list[list[tuple[int, int]]]:
    """(symbol, count) of the copies of every turn: all but a first one are duplicates."""
    found = []
    for _, role, copies, first, blank, cut, *_ in turns:
        sign = steps.symbol(role[:1], blank or not first, cut)
        found.append([(sign, copies)] if sign == steps.GONE else [(sign, 1)])
        if sign != steps.GONE and copies > 1:
            found[-1].append((steps.GONE, copies - 1))
    return found


def _flat(signs) -> list[tuple[int, int]]:
    return [pair for some in signs for pair in some]


_LEGAL = {"su", "ua", "au"}
_SUMMARY = (
    "conv_id long, start long, matrix array<double>, blank long, duplicate long, truncated long, illegal long, "
    "opens string, closes string, first_turn long, last_turn long, turns long"
)


def _summaries(batches):
    """The matrix and the counts of each stretch of a slice."""
    found = []
    for conv, turns in _stretches(batches, _TURN):
        matrix = steps.matrix_of(steps.runs_of(_flat(_signs(turns))))
        blank = sum(t[2] for t in turns if t[4])
        duplicate = sum(t[2] - t[3] for t in turns if not t[4])
        truncated = sum(1 for t in turns if t[3] and not t[4] and t[5])
        initials = [t[1][:1] for t in turns]
        illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        illegal += sum(t[2] - 1 for t in turns)  # a turn and its copy have one role
        known = [t[0] for t in turns if t[0] is not None]
        found.append(
            (conv, turns[0][6], [c for row in matrix for c in row], blank, duplicate, truncated, illegal)
            + (initials[0], initials[-1], known[0] if known else None, known[-1] if known else None, len(set(known)))
        )
        if len(found) >= 1000:
            yield _batch(found, _SUMMARY)
            found = []
    if found:
        yield _batch(found, _SUMMARY)


_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "array<double>": pa.list_(pa.float64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in kind.split(", ")))
    arrays = [pa.array(column, _KINDS[k]) for column, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


_PLAN = (
    "conv_id long, start long, to_go array<double>, entry int, last int, "
    "blank long, duplicate long, truncated long, illegal long, gaps long, cost long"
)


def _plans(batches):
    """Per stretch the costs to go behind it; per conversation, at its first, the counts."""
    for batch in batches:
        found = []
        for conv, parts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "parts"))):
            to_go, costs = steps.LAST, []
            for part in reversed(parts):
                costs.append(to_go)
                matrix = [part["matrix"][i : i + 4] for i in range(0, 16, 4)]
                to_go = steps.apply(matrix, to_go)
            costs.reverse()
            illegal = sum(p["illegal"] for p in parts)
            illegal += sum(a["closes"] + b["opens"] not in _LEGAL for a, b in zip(parts, parts[1:]))
            known = [p for p in parts if p["turns"]]
            gaps = 0
            if known:
                distinct = sum(p["turns"] for p in known)
                distinct -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:]))
                gaps = known[-1]["last_turn"] - known[0]["first_turn"] + 1 - distinct
            sums = [sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")]
            for i, part in enumerate(parts):
                alone = steps.START if len(parts) == 1 or i == 0 else None
                counts = (*sums, illegal, gaps, int(to_go[steps.START])) if i == 0 else (None,) * 6
                found.append((conv, part["start"], list(costs[i]), alone, int(i == len(parts) - 1), *counts))
        if found:
            yield _batch(found, _PLAN)


def _exits(batches):
    """The state behind a stretch for every state before it."""
    for _, turns in _stretches(batches, [*_TURN, "to_go", "start", "last"]):
        signs = _flat(_signs(turns))
        to_go, start, last = turns[0][7:10]
        behind = [steps.walk(signs, tuple(to_go), s, last)[0] for s in range(4)]
        yield _batch([(start, behind)], "start long, behind array<int>")


_EDIT = (
    "conv_id long, place long, letters string, before array<string>, role_kept string, after array<string>"
)


def _edits(batches):
    """Letters and roles of every turn."""
    found = []
    for conv, turns in _stretches(batches, [*_TURN, "to_go", "entry", "last"]):
        signs = _signs(turns)
        to_go, entry, last = turns[0][7:10]
        edits = iter(steps.walk(_flat(signs), tuple(to_go), entry, last)[1])
        for turn, own in zip(turns, signs):
            letters, before, kept, after = next(edits)
            if len(own) > 1:  # copies behind a first one
                more = next(edits)
                letters, after = letters + more[0], more[3]
            role = turn[1] if kept == "" else kept
            found.append((conv, turn[6], letters, list(before), role, list(after)))
        if len(found) >= 4000:
            yield _batch(found, _EDIT)
            found = []
    if found:
        yield _batch(found, _EDIT)


def _with_plan(turns: DataFrame, plan: DataFrame, *columns: str) -> DataFrame:
    """Turns with their stretch's plan: it is the one of the slice and the conversation."""
    stretch = plan.select(
        F.col("conv_id").alias("_conv"), F.shiftright("start", 33).cast("int").alias("_slice"), *columns
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice"))
    return turns.join(stretch, same).drop("_conv", "_slice")


def plan_repair(rows: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(report, edits) of conversations, both written.

    The report has a row for each conversation: conv_id, blank, duplicate, truncated,
    illegal, gaps, cost. The edits have a row for each different turn: conv_id, turn,
    role, digest (of the text), copies, place, letters (an initial for each edit, those
    of insertions before it, of its copies and, at the end, of insertions behind it),
    before and after (roles of inserted turns), role_kept (null: deleted).
    """
    turns = _turns(_normal(rows), work)
    narrow, slices = turns.select(*_TURN, "slice"), count_slices(turns)
    parts = work.save(one_task_a_slice(narrow, slices, "place").mapInArrow(_summaries, _SUMMARY), "stretches")
    columns = [c for c in parts.columns if c not in ("conv_id", "start")]
    # a conversation has a stretch in a slice at most
    lists = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", *columns))).alias("parts"))
    plan = work.save(lists.mapInArrow(_plans, _PLAN), "plan")
    parted = plan.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1")
    if not parted.isEmpty():
        plan = _entered(narrow, slices, plan, parted, work)
    planned = _with_plan(narrow, plan, "to_go", "entry", "last")
    edits = work.save(one_task_a_slice(planned, slices, "place").mapInArrow(_edits, _EDIT), "edits")
    whole = turns.select("turn", "role", "digest", "copies", "place").join(edits, "place")
    report = plan.filter("cost IS NOT NULL").drop("start", "to_go", "entry", "last")
    return report, work.save(whole, "whole")


def _entered(turns: DataFrame, slices: int, plan: DataFrame, parted: DataFrame, work: Workspace) -> DataFrame:
    """The plan with the states before the later stretches of conversations in several.

    There are fewer such conversations than slices.
    """
    ids = parted.select(F.col("conv_id").alias("_id"))
    long = plan.join(ids, F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi")
    walked = _with_plan(turns, long, "to_go", "start", "last")
    behind = work.save(
        one_task_a_slice(walked, slices, "place").mapInArrow(_exits, "start long, behind array<int>"), "exits"
    )
    keyed = long.join(behind, "start").groupBy("conv_id")
    entries = keyed.agg(F.sort_array(F.collect_list(F.struct("start", "behind"))).alias("parts")).select(
        F.explode(
            F.transform(
                "parts",
                lambda part, i: F.struct(
                    part["start"].alias("_start"),
                    F.aggregate(
                        F.slice("parts", F.lit(1), i), F.lit(steps.START), lambda at, p: F.get(p["behind"], at)
                    ).alias("_entry"),
                ),
            )
        ).alias("at")
    ).select("at.*")
    joined = plan.join(entries, F.col("start") == F.col("_start"), "left")
    return work.save(joined.withColumn("entry", F.coalesce("_entry", "entry")).drop("_start", "_entry"), "entered")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, place, letters and lines: the edits with the turns they leave.

    ``lines`` holds the repaired turns that stand at a place, inserted ones among them, as
    structs of role and text. Of equal turns one text is taken.
    """
    key = ["conv_id", "turn", "role", "digest"]
    texts = _normal(rows).groupBy(*key).agg(F.first("text").alias("text"))
    texts = texts.select("text", *(F.col(c).alias(f"_{c}") for c in key))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key] + [F.col("role_kept").isNotNull()]
    added = lambda column: F.transform(column, lambda role: F.struct(role.alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("role_kept").isNotNull(), F.array(F.struct(F.col("role_kept").alias("role"), "text")))
    none = F.array().cast("array<struct<role:string,text:string>>")
    return edits.join(texts, same, "left").select(
        "conv_id", "place", "letters", F.concat(added("before"), F.coalesce(own, none), added("after")).alias("lines")
    )


def _digests(batches):
    """Streams conversations turn by turn; only the letters of one are held."""
    key, letters, digest, empty, found = None, None, None, True, []

    def close():
        found.append((key, "".join(letters), digest.hexdigest()))

    for batch in batches:
        data = batch.to_pydict()
        for conv, more, lines in zip(data["conv_id"], data["letters"], data["lines"]):
            if letters is None or conv != key:
                if letters is not None:
                    close()
                key, letters, digest, empty = conv, [], hashlib.sha256(), True
            letters.append(more)
            for line in lines:
                digest.update(("" if empty else "\n").encode() + f"{line['role']}:{line['text']}".encode())
                empty = False
        if found:
            yield _batch(found, "conv_id long, audit string, repaired_sha256 string")
            found.clear()
    if letters is not None:
        close()
        yield _batch(found, "conv_id long, audit string, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``, of the repair of ``rows``.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256. Rows are ordered by turn (null first), then role and the digest of
    the text; a null role or text is one space; rows with a null conv_id are one
    conversation. A row's first fault counts: blank, duplicate (role and text of an
    earlier row; repeated rows), truncated. A conversation without rows has zeros, no
    edits and the hash of nothing; an empty table gives no rows. Other columns are
    ignored.
    """
    work = Workspace(conversations.sparkSession, "repair")
    report, edits = plan_repair(rows, work)
    turns = repaired(rows, edits)
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    digests = dealt.mapInArrow(_digests, "conv_id long, audit string, repaired_sha256 string")
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()

    def on(other: DataFrame, name: str) -> tuple[DataFrame, Column, str]:
        renamed = other.withColumnRenamed("conv_id", name)
        return renamed, F.col("_id").eqNullSafe(F.col(name)), "left"

    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated")]
    return (
        ids.join(*on(report, "_a"))
        .join(*on(work.save(digests, "digests"), "_b"))
        .select(
            F.col("_id").alias("conv_id"),
            *zero,
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("illegal", "cost")),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(conversations, damage(conversations))


SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
c AS (  -- crc32 of the key, bit by bit
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(key, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                               ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 20 AS fault
  FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM c WHERE fault <> 0),
o AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
r AS (
  SELECT *, CASE WHEN blank THEN 'b' WHEN again THEN 'd' WHEN cut THEN 't' ELSE '' END AS fault,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial, 'su') AS pair
  FROM o),
f AS (  -- per state the cheapest (cost, audit, lines); insertions behind every turn
  SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': '', 'l': ''} AS f0, {'c': 1000000000, 'a': '', 'l': ''} AS f1,
         {'c': 3, 'a': 'I', 'l': 'user:' || chr(10)} AS f2,
         {'c': 6, 'a': 'II', 'l': 'user:' || chr(10) || 'assistant:' || chr(10)} AS f3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, g0, g1, h2,
         list_min([g3, {'c': h2.c + 3, 'a': h2.a || 'I', 'l': h2.l || 'assistant:' || chr(10)}])
  FROM (
    SELECT *, list_min([g2] || list_transform([g0, g1, g3], lambda g:
             {'c': g.c + 3, 'a': g.a || 'I', 'l': g.l || 'user:' || chr(10)})) AS h2
    FROM (
      SELECT f.conv_id, r.i,
             {'c': f0.c + 4, 'a': f0.a || 'D', 'l': f0.l} AS g0,
             CASE WHEN initial = 's' AND fault NOT IN ('b', 'd') THEN list_min([
               {'c': f1.c + 4, 'a': f1.a || 'D', 'l': f1.l},
               {'c': f0.c + CASE fault WHEN 't' THEN 3 ELSE 0 END, 'a': f0.a || 'K',
                'l': f0.l || role || ':' || text || chr(10)}])
             ELSE {'c': f1.c + 4, 'a': f1.a || 'D', 'l': f1.l} END AS g1,
             CASE WHEN fault NOT IN ('b', 'd') THEN list_min(
               [{'c': f2.c + 4, 'a': f2.a || 'D', 'l': f2.l}] || list_transform([f0, f1, f3], lambda g:
               {'c': g.c + CASE initial WHEN 'u' THEN 0 ELSE 3 END + CASE fault WHEN 't' THEN 3 ELSE 0 END,
                'a': g.a || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END,
                'l': g.l || CASE initial WHEN 'u' THEN role ELSE 'user' END || ':' || text || chr(10)}))
             ELSE {'c': f2.c + 4, 'a': f2.a || 'D', 'l': f2.l} END AS g2,
             CASE WHEN fault NOT IN ('b', 'd') THEN list_min([
               {'c': f3.c + 4, 'a': f3.a || 'D', 'l': f3.l},
               {'c': f2.c + CASE initial WHEN 'a' THEN 0 ELSE 3 END + CASE fault WHEN 't' THEN 3 ELSE 0 END,
                'a': f2.a || CASE initial WHEN 'a' THEN 'K' ELSE 'R' END,
                'l': f2.l || CASE initial WHEN 'a' THEN role ELSE 'assistant' END || ':' || text || chr(10)}])
             ELSE {'c': f3.c + 4, 'a': f3.a || 'D', 'l': f3.l} END AS g3
      FROM f JOIN r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i + 1))),
e AS (
  SELECT conv_id, i, list_min([f0, f3]) AS best FROM f
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(left(best.l, greatest(length(best.l) - 1, 0))) AS repaired_sha256
FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""
