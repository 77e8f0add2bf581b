"""Mixture-controlled packing by deficit round-robin over source queues (operator 3).

Every source is a queue of token ids. A window (sequence) of 2048 ids takes
from each queue its target share; what a share leaves over as a fraction is
the queue's deficit and is carried to the next window. Carried deficits have a
closed form: after M ids in all, queue j has given a whole number Q_j(M) of
ids that depends only on M and the queue totals (see :class:`Mixture`). So a
task that knows where its ids lie in their queues can fill its part of every
window alone, and windows and deficits run on across partitions without a
shuffle of ids:

1. one pass encodes the documents and writes ids and each document's place in
   its task's part of its queue;
2. totals by (task, queue), a small table, give each part's place in its queue;
3. a second pass over the written ids cuts each document at the windows'
   borders.

With the queues' own totals as the target (the default), every window holds
the mixture of the whole corpus and all queues end together; with other
weights a queue that is empty leaves the round and the rest share on.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.llm import bpe
from narrata.llm.batches import as_arrays, binary_column, map_texts, row_chunks
from narrata.sources import io as IO

WINDOW = 2048
END_ID = 1
#: Every source is a queue of its own; the tasks hold a total for each (32 MB at most), more sources are an error.
MAX_SOURCES = 1 << 22
ENCODED_SCHEMA = "part int, queue string, doc_id long, n long, local_start long, ids binary"
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, queue string")


class Mixture:
    """How many ids each queue has given after M ids of the packed stream.

    ``phases`` holds, for each phase, the queues that give in it (in order) and
    the running sum of what they give. In a phase the first half of its queues
    has given floor(M * its share) ids and the other half the rest, and so on
    within the halves: whole numbers that never fall as M grows, add up to M,
    end at the queues' totals and stay within a few ids of the exact shares.
    A queue's number follows from its path through the halves alone, so the
    work doesn't grow with the number of queues.

    ``weights`` are shares, of all queues or by queue number; queues without
    one come last, in proportion to their totals.
    """

    def __init__(self, totals, weights: list[float] | dict[int, float] | None = None):
        totals = np.asarray(totals, np.int64)
        weights = dict(enumerate(weights)) if isinstance(weights, list) else weights
        self.total, self.queues, self.phases = int(totals.sum()), len(totals), []
        left = totals.copy()
        share = {j: Fraction(w) for j, w in (weights or {}).items()}
        if any(w < 0 for w in share.values()):
            raise ValueError("weights must not be negative")
        while active := sorted(j for j, w in share.items() if w and left[j]):
            ends = min(Fraction(int(left[j])) / share[j] for j in active)
            self._phase(np.array(active), [min(int(left[j]), round(share[j] * ends)) for j in active], left)
        rest = np.flatnonzero(left)
        if len(rest):  # all that is left in one phase: shares as the totals end together
            self._phase(rest, left[rest], left)

    def _phase(self, queues: np.ndarray, gives, left: np.ndarray) -> None:
        gives = np.asarray(gives, np.int64)
        left[queues] -= gives
        self.phases.append((queues, np.concatenate([[0], np.cumsum(gives)])))

    def given(self, m: np.ndarray, queue: np.ndarray | None = None):
        """Ids given by ``queue``, and by all queues before it, after ``m`` ids in all, for each pair.

        Without ``queue``: (len(m), queues), the ids given by each queue.
        """
        if queue is None:
            n = self.queues
            return self.given(np.repeat(m, n), np.tile(np.arange(n), len(m)))[0].reshape(len(m), n)
        own, earlier = np.zeros(len(m), np.int64), np.zeros(len(m), np.int64)
        before = 0
        for queues, upto in self.phases:
            size = int(upto[-1])
            rest = np.clip(m - before, 0, size)
            if size >= 1 << 31:  # products beyond 64 bits: whole numbers of any size
                rest, upto = rest.astype(object), upto.astype(object)
            place = np.searchsorted(queues, queue)  # the queue's leaf, or the one behind its place
            behind = place == len(queues)
            place = np.minimum(place, len(queues) - 1)
            passed = np.zeros(len(m), rest.dtype)
            low, high = np.zeros(len(m), np.int64), np.full(len(m), len(queues), np.int64)
            while (whole := high - low > 1).any():  # into the half that holds the place
                mid = np.where(whole, (low + high) // 2, high)
                part = rest * (upto[mid] - upto[low]) // np.maximum(upto[high] - upto[low], 1)
                right = whole & (place >= mid)
                passed = passed + np.where(right, part, 0)
                rest = np.where(right, rest - part, np.where(whole, part, rest))
                low, high = np.where(right, mid, low), np.where(whole & ~right, mid, high)
            mine = ~behind & (queues[place] == queue)
            own += np.where(mine, rest, 0).astype(np.int64)
            earlier += (passed + np.where(behind, rest, 0)).astype(np.int64)
            before += size
        return own, earlier

    def window_of(self, queue: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
        """The window that holds the id at ``place`` of ``queue``."""
        low = np.zeros(len(place), np.int64)
        high = np.full(len(place), max(0, -(-self.total // window) - 1), np.int64)
        while (low < high).any():
            mid = (low + high) // 2
            ended = self.given((mid + 1) * window, queue)[0] <= place
            low, high = np.where(ended, mid + 1, low), np.where(ended, high, mid)
        return low


def _encode(path: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given, enc = TaskContext.get().partitionId(), {}, bpe.encoder(path)
        for rows in row_chunks(batches, "text"):
            flat, sizes = enc.encode(rows.column("text").to_pylist())
            flat = np.insert(flat, np.cumsum(sizes), flat.dtype.type(end_id))
            queues, start = ["n" if s is None else "s" + s for s in rows.column("source").to_pylist()], []
            for q, n in zip(queues, (sizes + 1).tolist(), strict=True):
                start.append(given.get(q, 0))
                given[q] = start[-1] + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(queues), part), pa.int32()), pa.array(queues, pa.string()),
                 rows.column("doc_id"), pa.array(sizes + 1, pa.int64()), pa.array(start, pa.int64()),
                 binary_column(flat, sizes + 1)],
                names=["part", "queue", "doc_id", "n", "local_start", "ids"])
    return run


def _cut(held, window: int, dtype):
    def pieces(mixture: Mixture, rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = as_arrays(rows.column("ids"), dtype)
        queue = rows.column("number").to_numpy()
        n = np.diff(at)
        begin = rows.column("base").to_numpy() + rows.column("local_start").to_numpy()
        end = begin + n
        first = mixture.window_of(queue, begin, window)
        last = mixture.window_of(queue, end - 1, window)
        many = last - first + 1
        row = np.repeat(np.arange(len(n)), many)
        seq = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + first[row]
        (upto, earlier), (after, later) = (mixture.given(x * window, queue[row]) for x in (seq, seq + 1))
        lo = np.maximum(begin[row], upto)
        hi = np.minimum(end[row], after)
        offset = later - earlier + lo - upto  # a window's ids lie in the order of their queues
        keep = hi > lo
        row, seq, lo, hi, offset = (x[keep] for x in (row, seq, lo, hi, offset))
        start = lo - begin[row]
        raw = memoryview(ids.astype("<u4").tobytes())
        cuts = zip((4 * (at[row] + start)).tolist(), (4 * (at[row] + start + hi - lo)).tolist(), strict=True)
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(take), pa.array(start), pa.array(hi - lo),
             pa.array([zlib.crc32(raw[a:b]) for a, b in cuts], pa.int64()), pa.array(n[row]), pa.array(seq),
             pa.array(offset), rows.column("queue").take(take)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(*held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield pieces(mixture, batch.slice(at, 500))
    return run


def pack(docs: DataFrame, weights: dict[str, float] | None = None, window: int = WINDOW,
         vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in windows of the target mixture.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are left
    out. ``weights`` are target shares by source name (None: as the sources'
    token counts); sources without one come last. Every source has a queue of
    its own, whatever their number (above ``MAX_SOURCES``: ValueError). Returns a row for each piece: doc_id, start (ids of
    the document before it), length, ids_crc32, doc_tokens, sequence_id, offset
    in the sequence, queue. Only the last sequence is not full.

    A null text is empty (its end id alone is packed); a null source is a
    queue of its own; null or repeated doc_ids are separate documents; an empty
    table gives no pieces.
    """
    spark = docs.sparkSession
    run = f"packing-{uuid.uuid4().hex}"
    encoded = IO.materialize(
        map_texts(docs.select("doc_id", "text", "source"), _encode(vocabulary, end_id), ENCODED_SCHEMA), spark, f"{run}/ids")
    parts = encoded.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("part")  # a row for each task
    base = IO.materialize(parts.select("queue", "part", "n", (F.sum("n").over(before) - F.col("n")).alias("base")),
                          spark, f"{run}/bases")
    sums = base.groupBy("queue").agg(F.sum("n").alias("n"))
    if (many := sums.count()) > MAX_SOURCES:
        raise ValueError(f"{many} sources; their totals don't fit the tasks")
    numbered = IO.materialize(sums.select("queue", "n", (F.row_number().over(Window.orderBy("queue")) - 1).cast("long").alias(
        "number")), spark, f"{run}/queues")  # a row for each source, their number is bounded
    totals = np.fromiter((r.n for r in numbered.orderBy("number").toLocalIterator()), np.int64, many)
    shares = None
    if weights:
        named = numbered.filter(F.col("queue").isin(["s" + x for x in weights])).select("queue", "number").collect()
        shares = {r.number: weights[r.queue[1:]] for r in named}
        Mixture(totals, shares)  # wrong weights raise here
    held = spark.sparkContext.broadcast((totals, shares))
    dtype = bpe.encoder(vocabulary).dtype
    places = base.join(numbered.select("queue", "number"), "queue").select("queue", "part", "base", "number")
    placed = encoded.join(IO.materialize(places, spark, f"{run}/places"), ["queue", "part"])
    return map_texts(placed.select("queue", "number", "doc_id", "local_start", "base", "ids"),
                     _cut(held, window, dtype), PIECE_SCHEMA)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of the corpus's own mixture of sources."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
