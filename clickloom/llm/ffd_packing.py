"""Pack documents into sequences: first-fit decreasing with a tournament tree.

A document's ids, with an end id, are cut into pieces of at most a sequence; whole
sequences are done, and the rest is packed. Pieces are dealt at random into groups, each
packed on its own, so that no task sees more than a group.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.batches import releasing
from clickloom.llm.slices import counted_out
from clickloom.llm.tokens import encoder
from clickloom.llm.workspace import Workspace

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 2048
#: Pieces of a group on average; sequences of a group leave less than a percent unused.
GROUP_PIECES = 8192

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, each at most the capacity.

    The tree's leaves are the free space of the bins, in order; a node holds the larger
    of its children. The descent to the left wherever the left child has room finds the
    first bin that fits in logarithmic time. Ties in length keep their order.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    leaves = 1 << max(n - 1, 0).bit_length()
    room = [capacity] * (2 * leaves)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= length
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left > right else right
    return bins, offsets


def _pieces(batches, tokenizer: str, capacity: int, end_id: int):
    encode_all, end = encoder(tokenizer).encode_all, np.uint32(end_id).tobytes()
    step = 4 * capacity
    for batch in batches:
        rows = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), encode_all(batch.column(1))):
            ids += end
            total = len(ids) // 4
            for at in range(0, len(ids), step):
                piece = ids[at : at + step]
                rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), total))
        columns = list(zip(*rows)) or [()] * 5
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _pack_group(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    order = ["doc_id", "start", "ids_crc32", "length", "doc_tokens", "number"]
    pieces = pieces.sort_values(order, kind="stable", ignore_index=True)
    bins, offsets = first_fit_decreasing(pieces["length"].to_numpy(), capacity)
    pieces["sequence_id"] = (pieces["group"].to_numpy() << 32) + bins
    pieces["offset"] = offsets
    return pieces.drop(columns=["group", "number"])


def pack(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty, and an empty text is its end id; a null doc_id stays null;
    repeated rows are documents of their own; no rows give no rows. Other columns are
    ignored. Sequence ids are unique and not contiguous.

    Groups are of pieces. A piece's group is a hash of the piece and of its number among
    equal ones, which are counted, so rows with one doc_id, and equal ones, spread like
    any others, and the result does not depend on how rows are partitioned.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "packing")
    rows = docs.select("doc_id", "text")
    pieces = work.save(
        rows.mapInArrow(lambda batches: releasing(_pieces(batches, tokenizer, capacity, end_id)), PIECES), "pieces"
    )
    groups = max(1, -(-pieces.count() // group_pieces))
    columns = pieces.columns
    counted = pieces.groupBy(*columns).agg(F.count("*").alias("n"))
    place = F.xxhash64(*columns, F.col("number").cast("long"))
    dealt = counted_out(counted, *columns).withColumn("group", F.pmod(place, F.lit(groups)))
    return dealt.select(*columns, "number", "group").groupBy("group").applyInPandas(
        lambda group: _pack_group(group, capacity), f"{PIECES}, sequence_id long, offset long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
