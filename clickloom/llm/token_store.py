"""Token ids in compressed binary blocks with a shared dictionary and an offset index.

A store is a folder of two tables. ``dictionary`` has one row: a zstandard dictionary
trained on the serialized ids of a sample of documents, and its SHA-256. ``blocks`` has
rows of up to a few MB: the frames of consecutive documents, each compressed on its own
with the dictionary, one behind another; the index arrays (doc_id, byte offset, number
of ids); and the dictionary's hash. A reader takes the frame of one document out of its
block without touching the others, and refuses a block of another dictionary.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.sampling import by_hash
from clickloom.llm.slices import ranged
from clickloom.llm.tokens import encoder
from clickloom.llm.workspace import Workspace

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: The dictionary is a model: it is fitted to the documents with the least hashes.
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 32 * 1024 * 1024
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
BLOCK_BYTES = 4 * 1024 * 1024
#: Words that a task remembers, and bytes of text whose words are looked up together.
REMEMBERED = 1_000_000
PORTION = 10 * 1024 * 1024

BLOCKS = (
    "slice int, block int, doc_ids array<long>, offsets array<long>, counts array<long>, "
    "tokens long, dictionary string, payload binary"
)
DOCUMENTS = "doc_id long, slice int, block int, place int, n_tokens long, ids binary"


def train_dictionary(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> bytes:
    """A dictionary from the ids of at most SAMPLE_DOCS whole documents, to SAMPLE_BYTES.

    A share of the documents is chosen by hash, repeated ones once, so a task ships its
    share of SAMPLE_DOCS texts only. With too little to train on the dictionary is raw
    content, maybe empty.
    """
    chosen = by_hash(docs.select("doc_id", "text"), SAMPLE_DOCS, "doc_id", "text").filter("text <> ''")
    sample = (
        chosen.groupBy(F.xxhash64("doc_id", "text").alias("at"))
        .agg(F.min("text").alias("text"))
        .orderBy("at")
        .limit(SAMPLE_DOCS)
    )
    encode, end = encoder(tokenizer).encode, np.uint32(end_id).tobytes()
    ids, size = [], 0
    for row in sample.toLocalIterator():
        ids.append(encode(row.text) + end)
        size += len(ids[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, ids).as_bytes()
    except zstandard.ZstdError:
        return b"".join(ids)[:DICTIONARY_BYTES]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    if not content:
        return None
    dictionary = zstandard.ZstdCompressionDict(content)
    dictionary.precompute_compress(level=LEVEL)
    return dictionary


def _write(batches, content: bytes, tokenizer: str, end_id: int):
    """Blocks from rows of (slice, doc_id, text) in order."""
    encode_all, end = encoder(tokenizer, REMEMBERED, PORTION).encode_all, np.uint32(end_id).tobytes()
    compress = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(content)).compress
    digest = hashlib.sha256(content).hexdigest()
    at, block, doc_ids, counts, frames, size = None, 0, [], [], [], 0

    def flush():
        nonlocal block, doc_ids, counts, frames, size
        offsets = np.cumsum([0, *map(len, frames)])[:-1].tolist()
        row = [at, block, doc_ids, offsets, counts, sum(counts), digest, b"".join(frames)]
        types = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.int64(), pa.string(), pa.binary()]
        names = ["slice", "block", "doc_ids", "offsets", "counts", "tokens", "dictionary", "payload"]
        arrays = [pa.array([v], t) for v, t in zip(row, types)]
        block, doc_ids, counts, frames, size = block + 1, [], [], [], 0
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for part, doc_id, ids in zip(*columns, encode_all(batch.column(2))):
            if frames and (part != at or size >= BLOCK_BYTES):
                yield flush()
            if part != at:
                at, block = part, 0
            ids += end
            doc_ids.append(doc_id)
            counts.append(len(ids) // 4)
            frames.append(compress(ids))
            size += len(frames[-1])
    if frames:
        yield flush()


def write_store(
    docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, slices: int | None = None
) -> None:
    """Write all documents in ascending doc_id order, null first, ties by a hash of the text.

    A null text is empty; every document ends with ``end_id``; repeated rows are
    documents of their own; an empty table gives a store without blocks. Other columns
    are ignored. One task works through one slice of the order and holds one block; rows
    with one doc_id, equal ones too, spread over slices like any others.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    content = train_dictionary(rows, tokenizer, end_id)
    spark.createDataFrame(
        [(hashlib.sha256(content).hexdigest(), bytearray(content))], "dictionary string, content binary"
    ).write.parquet(f"{path}/dictionary")
    in_order = ranged(rows, slices, "doc_id", F.xxhash64("text"), F.monotonically_increasing_id())
    numbered = in_order.select("slice", "doc_id", "text")
    blocks = numbered.mapInArrow(lambda batches: _write(batches, content, tokenizer, end_id), BLOCKS)
    blocks.write.parquet(f"{path}/blocks")


@cache
def _decompressor(content: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(content))


def document_ids(block: dict, place: int, content: bytes) -> bytes:
    """The ids of one document of a block; the other frames are not read."""
    if hashlib.sha256(content).hexdigest() != block["dictionary"]:
        raise ValueError("the block was compressed with another dictionary")
    offsets = block["offsets"]
    end = offsets[place + 1] if place + 1 < len(offsets) else len(block["payload"])
    return _decompressor(content).decompress(block["payload"][offsets[place] : end])


def _content(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first().content)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id, from their blocks alone."""
    content = _content(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks").filter(F.array_contains("doc_ids", F.lit(doc_id)))
    found = []
    for row in blocks.orderBy("slice", "block").toLocalIterator():
        block = row.asDict()
        for place, owner in enumerate(block["doc_ids"]):
            if owner == doc_id:
                found.append(np.frombuffer(document_ids(block, place, content), "<u4").tolist())
    return found


def _read(batches, content: bytes, digest_only: bool):
    for batch in batches:
        for block in batch.to_pylist():
            rows = []
            for place, doc_id in enumerate(block["doc_ids"]):
                ids = document_ids(block, place, content)
                value = zlib.crc32(ids) if digest_only else ids
                rows.append((doc_id, block["slice"], block["block"], place, len(ids) // 4, value))
            last = pa.int64() if digest_only else pa.binary()
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), last]
            names = ["doc_id", "slice", "block", "place", "n_tokens", "ids_crc32" if digest_only else "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
            )


def read_store(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Every document of a store: doc_id, its place, n_tokens and ids (or their crc32)."""
    content = _content(spark, path)
    kind = DOCUMENTS.replace("ids binary", "ids_crc32 long") if digest_only else DOCUMENTS
    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks.mapInArrow(lambda batches: _read(batches, content, digest_only), kind)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """The number of ids before each block: sums over slices, then within a slice."""
    blocks = spark.read.parquet(f"{path}/blocks").select("slice", "block", "tokens")
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = blocks.groupBy("slice").agg(F.sum("tokens").alias("in_slice"))
    slices = slices.withColumn("before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
    within = Window.partitionBy("slice").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return inside.join(slices, "slice").select(
        "slice", "block", (F.col("before") + F.col("inside")).alias("block_start")
    )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    documents = read_store(spark, path, digest_only=True)
    starts = block_starts(spark, path)
    earlier = Window.partitionBy("slice", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return documents.join(starts, ["slice", "block"]).select(
        "doc_id",
        (F.col("block_start") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Workspace(spark, 'tokens').path}/store"
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return token_index(spark, path)
