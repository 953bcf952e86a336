"""Mix sources to target weights by weighted fair queueing. DataFrame functions only.

Documents of a source stand in a shuffled order. A document's virtual finish time is the
number of words of its source up to and including it, divided by the source's target; a
second pass over the source goes on counting. All passes of all documents are ranged by
finish time and taken until the total budget is used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.slices import counted_out, ordered
from clickloom.llm.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Ranges of shuffle keys within a source, and of finish times among all documents.
RANGES = 4096
#: The order in which rows leave the queue.
ORDER = ("finish", "source_rank", "pass", "key", "number")


def size_of(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """A document's place in the shuffled order of its source, as 32 hex digits."""
    blank = F.lit("")
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), blank), F.coalesce(text, blank)))


def targets(
    sources: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES
) -> DataFrame:
    """Add ``source_rank`` and ``target`` to rows of (source, source_size).

    Weights repeat over the sources in code-point order, null last. A target stops at
    ``passes`` times its source's size; the excess goes to the others by weight. In the
    order of limit over weight the stopped sources come first, so the level of the
    others follows from running sums.
    """
    everything = Window.partitionBy()
    ranked = sources.withColumn(
        "source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("source_rank") % len(weights) + 1)
    weighed = ranked.withColumns(
        {"weight": weight.cast("double"), "limit": F.col("source_size") * F.lit(float(passes))}
    )
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "source_rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(share)
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    stopped = weighed.withColumn("level", level).withColumn(
        "stopped", F.col("limit") / F.col("weight") <= F.col("level")
    )
    common = F.max(F.when(~F.col("stopped"), F.col("level"))).over(everything)
    return stopped.withColumn(
        "target", F.when(F.col("stopped"), F.col("limit")).otherwise(common * F.col("weight"))
    ).select("source", "source_size", "source_rank", "target")


def _range_of(key: Column) -> Column:
    """The first three hex digits of a key as a number."""
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def _finish_times(sizes: DataFrame, goals: DataFrame, passes: int) -> DataFrame:
    """One row per document and pass: source_rank, key, number, pass, size, finish.

    Rows equal in id and text share a key and are numbered from 1; each stands in the
    queue on its own. Running sums go over ranges of keys first and then within a range,
    so the documents of one source are never in one task; equal rows are counted before
    they are dealt, and dealt to several tasks where they are many.
    """
    keyed = (
        sizes.filter("size > 0")
        .groupBy("source", "key")
        .agg(F.max("size").alias("size"), F.count("*").alias("n"))
        .withColumn("words", F.col("size") * F.col("n"))
        .withColumn("range", _range_of(F.col("key")))
    )
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        keyed.groupBy("source", "range")
        .agg(F.sum("words").alias("in_range"))
        .withColumn("before", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
    )
    starts = ranges.join(goals, ranges.source.eqNullSafe(goals.source)).select(
        ranges.source.alias("of"), F.col("range").alias("at"), "before", "source_size", "source_rank", "target"
    )
    running = F.sum("words").over(Window.partitionBy("source", "range").orderBy("key"))
    placed = keyed.withColumn("behind", running - F.col("words"))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
    done = F.col("pass") * F.col("source_size") + F.col("before") + F.col("behind") + F.col("number") * F.col("size")
    rows = counted_out(placed, "source", "key").withColumn("pass", F.explode(F.array(*map(F.lit, range(passes)))))
    return rows.select("source_rank", "key", "number", "pass", "size", (done / F.col("target")).alias("finish"))


def _last_taken(items: DataFrame, budget: float):
    """The last row, by finish time, that the budget still holds; None if there is none."""
    slot = F.least(F.floor(F.col("finish") * (RANGES // 2)), F.lit(RANGES * 4)).cast("int")
    ranged = items.withColumn("slot", slot)
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        ranged.groupBy("slot")
        .agg(F.sum("size").alias("in_slot"))
        .withColumn("before", F.coalesce(F.sum("in_slot").over(earlier), F.lit(0)))
    )
    crossing = slots.filter(F.col("before") <= F.lit(budget))
    crossing = crossing.orderBy(F.desc("slot")).limit(2).collect()  # at most two rows
    if not crossing:
        return None
    lowest = min(row.slot for row in crossing)
    before = min(row.before for row in crossing)
    last = ranged.filter(F.col("slot").between(lowest, max(row.slot for row in crossing)))
    total = F.lit(before) + F.sum("size").over(Window.partitionBy().orderBy(*ORDER))
    held = last.withColumn("total", total).filter(F.col("total") <= F.lit(budget))
    row = held.agg(F.max(F.struct(*ORDER)).alias("last")).first().last
    if row is not None:
        return row
    return ranged.filter(F.col("slot") < lowest).agg(F.max(F.struct(*ORDER)).alias("last")).first().last


def cutoffs(
    spark: SparkSession, sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES
) -> DataFrame:
    """One row per source: source, source_size, target, and ``last_<pass>``.

    ``sizes`` has source, key and size. A document is taken in a pass if its key and its
    number among equal rows are at or before the pass's last (key, number); null: the
    pass takes none.
    """
    work = Workspace(spark, "mixing")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = work.save(targets(totals, weights, share, passes), "targets")
    items = work.save(_finish_times(sizes, goals, passes), "finish_times")
    budget = share * (goals.agg(F.sum("source_size")).first()[0] or 0)
    last = _last_taken(items, budget)
    taken = items.filter("false")
    if last is not None:
        bound = F.struct(*(F.lit(last[c]).cast(items.schema[c].dataType).alias(c) for c in ORDER))
        taken = items.filter(F.struct(*ORDER) <= bound)
    per_pass = [
        F.max(F.when(F.col("pass") == p, F.struct("key", "number"))).alias(f"last_{p}") for p in range(passes)
    ]
    ends = taken.groupBy("source_rank").agg(*per_pass)
    return work.save(goals.join(ends, "source_rank", "left"), "cutoffs")


def _with_copies(rows: DataFrame, ends: DataFrame, passes: int, work: Workspace) -> DataFrame:
    """Rows (of, key, taking and others) with ``copies``, the passes that take them.

    Only rows at a pass's last key depend on their number: these are put in order over
    all tasks and counted by slices, so many equal rows are no single task's. Which of
    them are taken follows from all columns.
    """
    lasts = [F.col(f"last_{p}") for p in range(passes)]
    found = rows.join(F.broadcast(ends), F.col("of").eqNullSafe(F.col("source_")))  # a row for each source
    border = F.coalesce(F.greatest(*((F.col("key") == last["key"]) for last in lasts)), F.lit(False)) & F.col("taking")

    def copies(taken_in) -> Column:
        some = sum((F.coalesce(taken_in(last).cast("int"), F.lit(0)) for last in lasts), F.lit(0))
        return F.when(F.col("taking"), some).otherwise(F.lit(0))

    inner = found.filter(~border).withColumn("copies", copies(lambda last: F.col("key") < last["key"]))
    at_end = found.filter(border).withColumns(
        {"same": F.xxhash64(*rows.columns), "any": F.monotonically_increasing_id()}
    )
    placed = ordered(work, at_end, "border", "of", "key", "same", "any")
    earlier = Window.partitionBy("of", "key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("of", "key", "slice").agg(F.count("*").alias("held"))
    starts = counts.withColumn("ahead", F.coalesce(F.sum("held").over(earlier), F.lit(0))).select(
        F.col("of").alias("of_"), F.col("key").alias("key_"), F.col("slice").alias("slice_"), "ahead"
    )
    own = F.col("of").eqNullSafe(F.col("of_")) & (F.col("key") == F.col("key_")) & (F.col("slice") == F.col("slice_"))
    within = F.row_number().over(Window.partitionBy("of", "key", "slice").orderBy("place"))
    numbered = placed.withColumn("within", within).join(starts, own)
    numbered = numbered.withColumn("row_number", F.struct("key", (F.col("ahead") + F.col("within")).alias("number")))
    outer = numbered.withColumn("copies", copies(lambda last: F.col("row_number") <= last))
    return inner.unionByName(outer.select(*inner.columns))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """Size, source_size, target and taken words of every document.

    Null texts, blank texts and sources without words have size 0 and take nothing; a
    null source is a source of its own, last in order; repeated rows are documents of
    their own, each taken or not; an empty table gives an empty result. Extra columns
    are ignored.
    """
    work = Workspace(docs.sparkSession, "sizes")
    sizes = work.save(
        docs.select(
            "doc_id",
            "source",
            size_of(F.col("text")).alias("size"),
            shuffle_key(F.col("doc_id"), F.col("text")).alias("key"),
        ),
        "sizes",
    )
    ends = cutoffs(docs.sparkSession, sizes, weights, share, passes).withColumnRenamed("source", "source_")
    rows = sizes.select("doc_id", "size", "key", F.col("source").alias("of"), (F.col("size") > 0).alias("taking"))
    return _with_copies(rows, ends, passes, work).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES
) -> DataFrame:
    """The mix itself: every document once for each pass that takes it, same columns.

    Documents without words are never taken.
    """
    work = Workspace(docs.sparkSession, "sizes")
    key, size = shuffle_key(F.col("doc_id"), F.col("text")), size_of(F.col("text"))
    sizes = work.save(docs.select("source", size.alias("size"), key.alias("key")), "sizes")
    ends = cutoffs(docs.sparkSession, sizes, weights, share, passes).withColumnRenamed("source", "source_")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("source").alias("of"),
        key.alias("key"),
        F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("taking"),
    )
    found = _with_copies(rows, ends, passes, work)
    return found.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH x AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS key
  FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY source, key) AS number FROM x),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1)::INT AS source_rank
  FROM d GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][source_rank % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_rank
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source_rank
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size, source_rank,
         CASE WHEN cap / weight <= level THEN cap
              ELSE max(CASE WHEN cap / weight > level THEN level END) OVER () * weight END AS target
  FROM l),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, number) AS running FROM d WHERE size > 0),
i AS (
  SELECT t.source_rank, c.key, c.number, p.pass, c.size, c.source,
         (p.pass * t.source_size + c.running)::DOUBLE / t.target AS finish
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) p(pass)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, source_rank, pass, key, number) AS total FROM i),
n AS (
  SELECT source, key, number, count(*) AS copies FROM r
  WHERE total <= 1.5 * (SELECT sum(size) FROM d) GROUP BY ALL)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (CASE WHEN d.size > 0 THEN d.size * coalesce(n.copies, 0) ELSE 0 END)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN n ON n.key = d.key AND n.number = d.number AND n.source IS NOT DISTINCT FROM d.source
"""
