"""Toxicity by a classifier chain over labelled categories.

Categories are predicted one after another by logistic models over the words a text has,
the word beginnings it has often, and a few measures of its form. A later model also gets
the probabilities of the earlier categories; in training these come from models that have
not seen the document (out of fold), so it learns to use predictions, not labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.batches import portions, releasing
from clickloom.llm.workspace import Workspace

#: Chain order: columns of 0 and 1 in ``labels``; the last decides.
CATEGORIES = ("quality", "toxic")
THRESHOLD = 0.5
#: The models are fitted to the labelled texts with the least hashes.
SAMPLE_DOCS = 8_000
#: Marks a model looks at, for each category those that tell most.
WORDS, LEAST_DOCS = 200, 4
FOLDS = 5
RIDGE = 0.3
_WORD = re.compile(r"\w+")


#: Letters of a word's beginning, for languages that inflect and compound.
STEMS = (4, 5)
#: A beginning counts from one in so many words of the text or of some stretch of it.
STEM_RARITY = 200
#: Words of a stretch, wherever it starts.
STRETCH = 800


def marks_of(text: str, words=None, stems=None) -> tuple[set[str], int]:
    """What a text shows, and its number of different words.

    That is its words in lower case, and the beginnings of longer words that are frequent
    in it or in any stretch of it: ``stem*`` from one occurrence and ``stem**`` from two. ``words`` and ``stems``
    limit both, where given.
    """
    found = _WORD.findall(text.lower())
    counts = Counter(found)
    marks = set(counts) if words is None else counts.keys() & words
    least = len(found) / STEM_RARITY
    for size in STEMS:
        often: dict[str, int] = {}
        for word, n in counts.items():
            stem = word[:size]
            if (stems is None or stem in stems) and len(word) > size:
                often[stem] = often.get(stem, 0) + n
        dense = _dense_in_a_stretch(found, size, often)
        for stem, n in often.items():
            if n >= least or stem in dense:
                marks.add(f"{stem}*")
                if n > 1:
                    marks.add(f"{stem}**")
    return marks, len(counts)


def _dense_in_a_stretch(found: list[str], size: int, often: dict[str, int]) -> set[str]:
    """Beginnings frequent in some stretch of a text longer than that."""
    least = STRETCH // STEM_RARITY
    several = {stem for stem, n in often.items() if n >= least} if len(found) > STRETCH else set()
    where: dict[str, list[int]] = {stem: [] for stem in several}
    if several:
        for place, word in enumerate(found):
            if len(word) > size and word[:size] in several:
                where[word[:size]].append(place)
    return {
        stem
        for stem, places in where.items()
        if any(last - first < STRETCH for first, last in zip(places, places[least - 1 :]))
    }


def form_of(text: str, words: int) -> list[float]:
    """Length, different words, and shares of capitals, digits and ASCII signs."""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / max(1, len(data))
    signs = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    return [
        math.log1p(len(text)) / 10,
        words / (1 + len(text) / 6),
        float(counts[65:91].sum()),
        float(counts[48:58].sum()),
        float(signs),
    ]


FORMS = 5


@dataclass
class Chain:
    """Marks by column, and one row of weights per category: intercept, form, earlier, marks."""

    categories: tuple[str, ...]
    words: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        self.plain = {mark for mark in self.words if not mark.endswith("*")}
        self.stems = {mark.rstrip("*") for mark in self.words if mark.endswith("*")}

    def score(self, text: str | None) -> list[float]:
        """Probabilities in chain order; 0 without text or without a fitted model."""
        if not text or not self.weights:
            return [0.0] * len(self.categories)
        marks, different = marks_of(text, self.plain, self.stems)
        columns = [self.words[mark] for mark in marks & self.words.keys()]
        form, found = form_of(text, different), []
        for weights in self.weights:
            dense = np.array([1.0, *form, *map(_logit, found)])
            at = float(dense @ weights[: len(dense)])
            at += float(sum(weights[len(dense) + c] for c in sorted(columns)))
            found.append(_chance(at))
        return found


def _chance(at: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, at))))


def _logit(chance: float) -> float:
    return math.log((chance + 1e-6) / (1 - chance + 1e-6)) / 10


class Rows:
    """Training rows: a dense part and the columns of a 0/1 part."""

    def __init__(self, dense: np.ndarray, marks: list[np.ndarray], width: int):
        self.dense, self.marks, self.width = dense, marks, width
        self.columns = np.concatenate([np.zeros(0, np.int64), *marks])
        self.owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])

    def times(self, weights: np.ndarray) -> np.ndarray:
        split = self.dense.shape[1]
        marked = np.bincount(self.owner, weights[split:][self.columns], len(self.dense))
        return self.dense @ weights[:split] + marked

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        marked = np.bincount(self.columns, values[self.owner], self.width)
        return np.concatenate([self.dense.T @ values, marked])

    def where(self, chosen: np.ndarray) -> Rows:
        return Rows(self.dense[chosen], [self.marks[i] for i in np.flatnonzero(chosen)], self.width)


def fit_logistic(rows: Rows, labels: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; column 0 is not shrunk."""
    shrink = np.full(rows.dense.shape[1] + rows.width, RIDGE)
    shrink[0] = 0
    at = np.ones(len(shrink))
    for _ in range(20):  # the largest eigenvalue bounds the step
        at = rows.transposed_times(rows.times(at))
        size = float(np.linalg.norm(at)) or 1.0
        at /= size
    bound = 0.26 * size + RIDGE
    weights = ahead = np.zeros(len(shrink))
    for step in range(1, rounds + 1):
        chance = 1 / (1 + np.exp(-np.clip(rows.times(ahead), -30, 30)))
        moved = ahead - (rows.transposed_times(chance - labels) + shrink * ahead) / bound
        ahead = moved + (step - 1) / (step + 2) * (moved - weights)
        weights = moved
    return weights


def fit_chain(forms: np.ndarray, marks: list[np.ndarray], labels: np.ndarray, words, categories) -> Chain:
    """Models in chain order; ``marks`` has each row's columns, ``labels`` one column a category."""
    n = len(forms)
    folds = np.arange(n) % FOLDS
    chain = Chain(tuple(categories), {w: i for i, w in enumerate(words)})
    earlier = np.zeros((n, 0))
    for k in range(len(categories)):
        rows = Rows(np.concatenate([np.ones((n, 1)), forms, earlier], axis=1), marks, len(words))
        chain.weights.append(fit_logistic(rows, labels[:, k]))
        unseen = np.zeros(n)
        for fold in range(FOLDS):
            held = folds == fold
            if held.any():
                weights = fit_logistic(rows.where(~held), labels[~held, k])
                unseen[held] = rows.where(held).times(weights)
        chance = 1 / (1 + np.exp(-np.clip(unseen, -30, 30)))
        logit = np.log((chance + 1e-6) / (1 - chance + 1e-6)) / 10
        earlier = np.concatenate([earlier, logit[:, None]], axis=1)
    return chain


def _describe(batches: Iterable, categories):
    """Labels, form and marks of sampled texts."""
    for batch in portions(batches):
        rows = batch.to_pylist()
        shown = [marks_of(row["text"]) for row in rows]
        arrays = [pa.array([row["at"] for row in rows], pa.int64())]
        arrays += [pa.array([row[c] for row in rows], pa.int32()) for c in categories]
        arrays += [
            pa.array([form_of(row["text"], n) for row, (_, n) in zip(rows, shown)], pa.list_(pa.float64())),
            pa.array([sorted(marks) for marks, _ in shown], pa.list_(pa.string())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["at", *categories, "form", "words"])


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES) -> Chain:
    """Fit a chain to at most SAMPLE_DOCS labelled texts.

    Rows without text or with a missing label do not teach; copies of a text count once,
    with their largest labels; of several label rows of a document the largest count.
    Without a document of either kind in a category its probability is constant.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "toxicity")
    known = labels.dropna(subset=["doc_id", *categories]).groupBy("doc_id")
    known = known.agg(*(F.max(c).cast("int").alias(c) for c in categories))
    texts = docs.filter("text <> ''").select("doc_id", "text", F.xxhash64("text").alias("at"))
    hashes = texts.select("doc_id", "at").join(known, "doc_id").select("at").distinct()
    last = hashes.orderBy("at").limit(SAMPLE_DOCS).agg(F.max("at")).first()[0]
    if last is None:
        return Chain(tuple(categories))
    sample = texts.filter(F.col("at") <= last).join(known, "doc_id")
    sample = sample.groupBy("at").agg(F.min("text").alias("text"), *(F.max(c).alias(c) for c in categories))
    kind = f"at long, {', '.join(f'{c} int' for c in categories)}, form array<double>, words array<string>"
    described = work.save(
        sample.mapInArrow(lambda batches: _describe(batches, categories), kind), "sample"
    )
    words = _telling_words(described, categories)
    chosen = F.array_intersect("words", F.lit(words) if words else F.array().cast("array<string>"))
    rows = described.select("at", *categories, "form", chosen.alias("words")).orderBy("at").collect()
    place = {w: i for i, w in enumerate(words)}
    marks = [np.array(sorted(place[w] for w in row.words), np.int64) for row in rows]
    forms = np.array([row.form for row in rows], float).reshape(-1, FORMS)
    values = np.array([[row[c] for c in categories] for row in rows], float)
    return fit_chain(forms, marks, values, words, categories)


def _telling_words(described: DataFrame, categories) -> list[str]:
    """For each category the marks with the largest chi-square against its label."""
    sums = described.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories)).first()
    word = described.select(F.explode("words").alias("word"), *categories)
    counts = word.groupBy("word").agg(F.count("*").alias("with"), *(F.sum(c).alias(c) for c in categories))
    counts = counts.filter(F.col("with") >= LEAST_DOCS)
    found = set()
    for c in categories:
        positive = sums[c] / sums.n
        if not 0 < positive < 1:
            continue
        off = F.col(c) - F.col("with") * F.lit(positive)
        spread = F.col("with") * F.lit(positive * (1 - positive)) * (1 - F.col("with") / F.lit(sums.n + 1))
        best = counts.orderBy(F.desc(off * off / spread), "word").limit(WORDS)
        found |= {row.word for row in best.collect()}
    return sorted(found)


def _scores(batches, chain: Chain):
    for batch in portions(batches):
        found = [chain.score(text) for text in batch.column(1).to_pylist()]
        columns = list(zip(*found)) or [()] * len(chain.categories)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.float64()) for c in columns)],
            names=["doc_id", *(f"{c}_score" for c in chain.categories)],
        )


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, a score for each category, and whether the last is at the threshold.

    A null or empty text has scores 0 and is not toxic, as is every text if no label
    could teach; repeated rows are scored alike; other columns are ignored.
    """
    kind = ", ".join(f"{c}_score double" for c in chain.categories)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _scores(batches, chain), f"doc_id long, {kind}"
    )
    last = chain.categories[-1]
    return found.withColumn(last, F.col(f"{last}_score") >= threshold)


def _clean(batches, chain, place, threshold):
    for batch in portions(batches):
        texts = batch.column(place).to_pylist()
        yield batch.filter(pa.array([chain.score(text)[-1] < threshold for text in texts], pa.bool_()))


def keep_clean(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, that are below the threshold."""
    place = docs.columns.index("text")
    return docs.mapInArrow(lambda batches: releasing(_clean(batches, chain, place, threshold)), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(docs, labels))
