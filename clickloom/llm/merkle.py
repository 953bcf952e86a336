"""Merkle trees over the paragraphs and sections of a text.

Leaves are paragraphs: lines, and of long lines runs of sentences or of code points that
end where the last few of them say so; an edit moves the borders near it only. A section is a run of
paragraphs; where it ends depends on the text of its last paragraph alone, so an edit
moves no other section's borders. A section's hash is over its leaves' hashes, the root
over the sections'. A fingerprint is the whole tree as a string:

    root/section=leaf:chars,leaf:chars;section=...

Hashes are of 128 bits; below the root 48 of them are written. Equal roots mean equal
texts. Comparing goes down only into sections that differ.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.slices import last_at_most, one_task_a_slice, ordered
from clickloom.llm.workspace import Workspace

#: Code points of a line above which it is cut, behind sentences where it has any. All
#: leaves of such a line but its last have from LEAST_PART to LONG_LINE code points.
LONG_LINE, LEAST_PART = 64, 32
#: Code points that decide whether a long line is cut behind them.
REACH = 4
#: Hexadecimal digits of a leaf or section in a fingerprint.
DIGITS = 12
#: A section ends behind a leaf whose hash has this remainder; eight leaves on average.
SECTION_CYCLE = 8
_SENTENCE_END = re.compile(r"[.!?…؟۔।॥։።။]+\s+|[。．｡！？]+[」』”’）】]*\s*")
_SENTENCE_BIT = np.uint64(1 << 63)


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _ranks(line: str) -> np.ndarray:
    """How much the text speaks for a cut behind each code point; sentence ends come first."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ranks = codes.copy()
    for back in range(1, REACH):
        ranks[back:] += codes[:-back] * np.uint64(0x100000001B3**back % 2**64)
    ranks *= np.uint64(0x9E3779B97F4A7C15)
    ranks ^= ranks >> np.uint64(29)
    ranks = ranks * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)
    for end in _SENTENCE_END.finditer(line):
        ranks[end.end() - 1] |= _SENTENCE_BIT
    return ranks


def paragraphs(text: str) -> list[str]:
    """The leaves; joined they are the text."""
    leaves = []
    for line in text.splitlines(keepends=True):
        if len(line) <= LONG_LINE:
            leaves.append(line)
            continue
        ranks, at = _ranks(line), 0
        while len(line) - at > LONG_LINE:
            # the last of equal ranks, so that leaves of a repeated character are long
            behind = ranks[at + LEAST_PART - 1 : at + LONG_LINE][::-1].argmax()
            cut = at + LONG_LINE - int(behind)
            leaves.append(line[at:cut])
            at = cut
        leaves.append(line[at:])
    return leaves


def fingerprint(text: str | None) -> str:
    """The tree of a text; a null text is empty and has a root without sections."""
    sections, hashes, written = [], [], []

    def close():
        section = _hash(b"".join(hashes))
        sections.append((section, f"{section.hex()[:DIGITS]}={','.join(written)}"))
        hashes.clear()
        written.clear()

    for leaf in paragraphs(text or ""):
        digest = _hash(leaf.encode("utf-8", "surrogatepass"))
        hashes.append(digest)
        written.append(f"{digest.hex()[:DIGITS]}:{len(leaf)}")
        if digest[0] % SECTION_CYCLE == 0:
            close()
    if hashes:
        close()
    root = _hash(b"".join(section for section, _ in sections)).hex()
    return f"{root}/{';'.join(node for _, node in sections)}"


def tree(print_: str) -> tuple[str, list[tuple[str, list[tuple[str, int]]]]]:
    """A fingerprint as its root and sections of (hash, leaves of (hash, chars))."""
    root, _, body = print_.partition("/")
    sections = []
    for section in filter(None, body.split(";")):
        name, _, leaves = section.partition("=")
        pairs = (leaf.split(":") for leaf in leaves.split(","))
        sections.append((name, [(digest, int(chars)) for digest, chars in pairs]))
    return root, sections


def _apart(left, right):
    """Sections of either side that the other doesn't have, repeats counted."""
    have, own = Counter(name for name, _ in right), []
    for index, (name, leaves) in enumerate(left):
        if have[name] > 0:
            have[name] -= 1
        else:
            own.append((index, leaves))
    return own


def likeness(a: str, b: str) -> float:
    """The share of code points in leaves that both texts have, 0 to 1."""
    if a.partition("/")[0] == b.partition("/")[0]:
        return 1.0
    left, right = tree(a)[1], tree(b)[1]
    total = sum(chars for side in (left, right) for _, leaves in side for _, chars in leaves)
    own, other = _apart(left, right), _apart(right, left)
    mine = Counter(leaf for _, leaves in own for leaf in leaves)
    theirs = Counter(leaf for _, leaves in other for leaf in leaves)
    common = sum(chars * n for (_, chars), n in (mine & theirs).items())
    apart = sum(chars * n for side in (mine, theirs) for (_, chars), n in side.items())
    return (total - apart + 2 * common) / total if total else 1.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of every leaf of the first text that the second lacks."""
    left, right = tree(a)[1], tree(b)[1]
    there = Counter(leaf for _, leaves in _apart(right, left) for leaf in leaves)
    found = []
    for section, leaves in _apart(left, right):
        for place, leaf in enumerate(leaves):
            if there[leaf] > 0:
                there[leaf] -= 1
            else:
                found.append((section, place))
    return found


def edited(text: str, following: str) -> str:
    """The last half replaced by as many first code points of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(rows):
    """Result columns for rows of (own, doc_id, text) in order; the last row is a guest."""
    before = None
    for own, doc_id, text in rows:
        text = text or ""
        now = (own, doc_id, text, fingerprint(text))
        if before is not None and before[0]:
            changed = edited(before[2], text)
            mark = fingerprint(changed)
            yield (
                before[1],
                len(before[2]),
                hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                before[3],
                mark,
                likeness(before[3], mark),
                likeness(before[3], now[3]),
            )
        before = now


def _in_batches(batches, size: int = 256):
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    done = []

    def batch():
        columns = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for row in _compare(rows()):
        done.append(row)
        if len(done) == size:
            yield batch()
            done = []
    if done:
        yield batch()


def fingerprints(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Fingerprints of all texts and edited texts, and their likeness, one row per row.

    The next document is the next row by doc_id, null first, ties by a hash of the text;
    the last row is followed by the first; a single row follows itself. A null text is
    empty; an empty table gives no rows; other columns are ignored. Each task goes
    through one slice of the order and holds two texts; the first row of a slice also
    goes to the slice before it as a guest. Rows with one doc_id spread over slices;
    rows equal in id and text share one.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "merkle")
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash")).alias("key"), "text")
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ordered(work, rows.select("key"), "keys", "key", slices=slices)
    firsts = keys.groupBy("slice").agg(F.min("key").alias("key")).orderBy("slice").collect()  # a row for each slice
    bounds = F.array(*(F.struct(F.lit(r.key.id).cast("long").alias("id"), F.lit(r.key.hash).alias("hash")) for r in firsts))
    if not firsts:
        bounds = F.array(F.struct(F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("hash")))
    placed = rows.withColumn("slice", last_at_most(bounds, len(firsts), F.col("key")))
    opens = F.get(bounds, F.col("slice")) == F.col("key")
    guest = F.when(opens, F.pmod(F.col("slice") - 1, F.lit(max(len(firsts), 1))))
    places = F.array(
        F.struct(F.lit(True).alias("own"), F.col("slice")), F.struct(F.lit(False).alias("own"), guest.alias("slice"))
    )
    dealt = (
        placed.withColumn("place", F.explode(places))
        .filter("place.slice IS NOT NULL")
        .select("place.slice", "place.own", "key", "text")
    )
    sorted_ = one_task_a_slice(dealt, max(len(firsts), 1), F.desc("own"), "key")
    return sorted_.select("slice", "own", "key.id", "text").mapInArrow(_in_batches, COLUMNS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
