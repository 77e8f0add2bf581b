"""Token files: patched frame-of-reference blocks with indexed block starts (operator 6).

A shard of a token file is a run of documents in ascending ``doc_id`` order,
cut into chunks of whole documents. A chunk is one binary stream:

====================  ======================================================
``PFR1``              4 bytes
number of ids         unsigned 64-bit
number of blocks      unsigned 32-bit
index                 for each block, unsigned 32-bit: where it begins in the stream's body
body                  the blocks
====================  ======================================================

A block holds 128 ids (the last one is filled up with its minimum): the
minimum (unsigned 32-bit), the width w, the number of exceptions, then the
differences from the minimum, w bits each, in four lanes of 32-bit words,
then the exceptions' places (a byte each) and whole differences (32 bits
each). The width is the bit length of a percentile of the block's
differences; longer ones are exceptions. All integers are little-endian.

The streams are binary values of a Parquet table that Spark writes (any file
system Spark knows; a lost task's part is written again), beside the ids'
places: shard, chunk and the documents of the chunk with their numbers of ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.llm import bpe
from narrata.llm.batches import map_texts, row_chunks
from narrata.sources import io as IO

MAGIC = b"PFR1"
BLOCK = 128
#: Share of a block's differences that fit the packed width.
PERCENTILE = 0.9
#: Ids of a chunk, up to the end of the document that reaches it.
CHUNK_IDS = 1 << 18
#: Chunks of a Parquet row group (about 4 MB), and after each the writer looks at its page: by default it looks after
#: 100 rows, and all chunks of a task are one page, which writer and readers hold several times.
ROW_GROUP_CHUNKS = 8
END_ID = 2
FILE_SCHEMA = ("shard int, chunk int, first_doc_id long, first_hash long, n_ids long, "
               "doc_ids array<long>, counts array<long>, payload binary")


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 32, 4) values below 2**width to (blocks, width, 4) words."""
    words = np.zeros((len(values), width, 4), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        words[:, word] |= values[:, i] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= values[:, i] >> np.uint32(32 - shift)
    return words


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    values = np.zeros((len(words), 32, 4), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        v = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            v = v | (words[:, word + 1] << np.uint32(32 - shift))
        values[:, i] = v & mask
    return values


def encode_ids(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One chunk's stream of any unsigned 32-bit ids."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    head = MAGIC + np.uint64(n).tobytes() + np.uint32(n_blocks).tobytes()
    if n == 0:
        return head
    table = np.empty(n_blocks * BLOCK, np.uint32)
    table[:n] = ids
    table[n:] = table[(n_blocks - 1) * BLOCK:n].min()
    table = table.reshape(n_blocks, BLOCK)
    low = table.min(axis=1)
    diff = table - low[:, None]
    bits = _bit_length(diff)
    rank = int(percentile * (BLOCK - 1))
    width = np.partition(bits, rank, axis=1)[:, rank].astype(np.int64)
    patched = bits > width[:, None]
    n_exc = patched.sum(axis=1)
    size = 6 + 16 * width + 5 * n_exc
    begin = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    body[begin[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    body[begin + 4], body[begin + 5] = width, n_exc
    for w in np.unique(width).tolist():
        if w:
            own = np.flatnonzero(width == w)
            values = (diff[own] & np.uint32((1 << w) - 1)).reshape(-1, 32, 4)
            body[begin[own][:, None] + 6 + np.arange(16 * w)] = (
                _pack(values, w).astype("<u4").reshape(len(own), -1).view(np.uint8))
    block, place = np.nonzero(patched)
    at = begin[block] + 6 + 16 * width[block]
    nth = np.arange(len(block)) - (np.cumsum(n_exc) - n_exc)[block]
    body[at + nth] = place
    body[(at + n_exc[block] + 4 * nth)[:, None] + np.arange(4)] = (
        diff[block, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return head + begin.astype("<u4").tobytes() + body.tobytes()


def decode_ids(stream: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a chunk's stream, or of its blocks ``first`` to ``last`` only (through the index)."""
    if stream[:4] != MAGIC:
        raise ValueError("not a token chunk")
    n, n_blocks = int(np.frombuffer(stream, "<u8", 1, 4)[0]), int(np.frombuffer(stream, "<u4", 1, 12)[0])
    last = n_blocks if last is None else min(last, n_blocks)
    if first >= last:
        return np.zeros(0, np.uint32)
    begin = np.frombuffer(stream, "<u4", n_blocks, 16).astype(np.int64)[first:last]
    body = np.frombuffer(stream, np.uint8)[16 + 4 * n_blocks:]
    low = body[begin[:, None] + np.arange(4)].view("<u4")[:, 0]
    width, n_exc = body[begin + 4].astype(np.int64), body[begin + 5].astype(np.int64)
    diff = np.zeros((len(begin), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        if w:
            own = np.flatnonzero(width == w)
            words = body[begin[own][:, None] + 6 + np.arange(16 * w)].view("<u4").reshape(-1, w, 4)
            diff[own] = _unpack(words, w).reshape(-1, BLOCK)
    block = np.repeat(np.arange(len(begin)), n_exc)
    at = begin[block] + 6 + 16 * width[block]
    nth = np.arange(len(block)) - (np.cumsum(n_exc) - n_exc)[block]
    values = body[(at + n_exc[block] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0] if len(block) else []
    diff[block, body[at + nth]] = values
    return (diff + low[:, None]).reshape(-1)[:n - first * BLOCK]


def _encode_partition(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk = TaskContext.get().partitionId(), 0
        enc = bpe.encoder(path)
        ids, doc_ids, counts, hashes, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            payload = encode_ids(np.concatenate(ids))
            columns = [[shard], [chunk], [doc_ids[0]], [hashes[0]], [held], [doc_ids], [counts], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        names = ["shard", "chunk", "first_doc_id", "first_hash", "n_ids", "doc_ids", "counts", "payload"]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for rows in row_chunks(batches, "text"):
            flat, sizes = enc.encode(rows.column("text").to_pylist())
            at = 0
            for doc_id, h, n in zip(rows.column("doc_id").to_pylist(), rows.column("h").to_pylist(),
                                    sizes.tolist(), strict=True):
                ids += [flat[at:at + n].astype(np.uint32), np.array([end_id], np.uint32)]
                doc_ids.append(doc_id)
                counts.append(n + 1)
                hashes.append(h)
                at, held = at + n, held + n + 1
                if held >= CHUNK_IDS:
                    yield flush()
                    ids, doc_ids, counts, hashes, held, chunk = [], [], [], [], 0, chunk + 1
        if doc_ids:
            yield flush()
    return run


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``text`` of every document and write token files under ``path``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. Texts
    go through one range exchange by ``doc_id`` (then a hash of the text, which
    also spreads repeated or null ids over tasks and orders them), and are
    tokenised, packed and written by the tasks that receive them. A null text
    is empty: its document holds the end id alone. Null ids come first. An
    empty table writes no chunk.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    files = map_texts(ordered, _encode_partition(vocabulary, end_id), FILE_SCHEMA)
    (files.write.mode("overwrite").option("parquet.block.row.count.limit", ROW_GROUP_CHUNKS)
     .option("parquet.page.size.row.check.min", 1).parquet(path))


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): ids of all shards before it, in the order of their first documents.

    One row for each writing task, so the window over all of them stays small.
    """
    shards = (spark.read.parquet(path).groupBy("shard")
              .agg(F.sum("n_ids").alias("n_ids"), F.min(F.struct("first_doc_id", "first_hash", "chunk")).alias("first")))
    before = Window.orderBy(F.col("first.first_doc_id").asc_nulls_first(), "first.first_hash", "shard")
    return shards.select("shard", (F.sum("n_ids").over(before) - F.col("n_ids")).alias("base"))


DOC_SCHEMA = "shard int, chunk int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            doc_ids = one.column("doc_ids").flatten()
            counts = one.column("counts").flatten().to_numpy(zero_copy_only=False)
            ids = memoryview(decode_ids(one.column("payload")[0].as_py()).astype("<u4").tobytes())
            end = np.cumsum(counts)
            crc = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip((end - counts).tolist(), end.tolist(), strict=True)]
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, one.column("shard")[0].as_py()), pa.int32()),
                 pa.array(np.full(n, one.column("chunk")[0].as_py()), pa.int32()),
                 doc_ids, pa.array(end - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                names=["shard", "chunk", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def _read_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            counts = one.column("counts").flatten().to_numpy(zero_copy_only=False)
            ids = decode_ids(one.column("payload")[0].as_py()).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [one.column("doc_ids").flatten(), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                names=["doc_id", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids): the decoded ids of every document."""
    return map_texts(spark.read.parquet(path).select("doc_ids", "counts", "payload"),
                     _read_ids, "doc_id long, ids array<long>")


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: within the chunk from
    its counts, plus the chunks before it in the shard, plus the shards before.
    """
    files = spark.read.parquet(path)
    in_shard = Window.partitionBy("shard").orderBy("chunk")
    chunks = files.select("shard", "chunk", (F.sum("n_ids").over(in_shard) - F.col("n_ids")).alias("in_shard"))
    places = chunks.join(shard_starts(spark, path), "shard").select(
        "shard", "chunk", (F.col("base") + F.col("in_shard")).alias("base"))
    places = IO.materialize(places, spark, f"token-places-{uuid.uuid4().hex}")  # small: a row for each chunk
    docs = map_texts(files.select("shard", "chunk", "doc_ids", "counts", "payload"), _read_chunks, DOC_SCHEMA)
    return docs.join(places, ["shard", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of ``documents``, written and read back."""
    path = IO.scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return token_file_digest(spark, path)
