"""Exact top-k inner product search by ball trees, a tree for each shard (operator 10).

Candidates are dealt to shards by their nearest pivot (a bounded sample of the
vectors), so that vectors that lie together share a shard; a pivot with more
than ``SHARD_ROWS`` vectors has several. Every shard's ball tree is built once
and written. A node knows its centre, its radius, the largest and smallest
length of its vectors and their widest angle to the centre, and so bounds the
inner product of a query with any of them.

A query is first sent to the shards of its two best root bounds and looks into
the best leaf there. The best k-th score of these is its shared floor: it then
goes to those shards only whose root bound reaches the floor. In a shard the
bounds of all nodes are one matrix product; leaves are taken in descending
order of their bounds, each with all queries that it can still help, as one
dense block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.sources import io as IO

TOP_K = 5
QUERY_EVERY = 50
SCALE = 256
LEAF = 128
#: Most candidates of a shard (by expectation) and queries that meet a copy of its tree.
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
#: Vectors that candidates are dealt by; any choice gives the same result.
MAX_PIVOTS = 1024
#: Roots (a few hundred bytes each) that are sent to the tasks at once; more go in turns.
ROOTS_AT_ONCE = 1 << 15
#: Scores or bounds (eight bytes each) that a task works out at once.
CELLS = 1 << 20
#: Shards that a query looks into for its floor.
SEEDS = 2
_LONG = (1 << 63) - 1


class BallTree:
    """Nodes in the order of their making, parents first; every leaf has a part of the rows."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        todo, nodes = [(np.lexsort((ids,)), -1)], []
        self.parts: list[np.ndarray] = []
        lengths = np.sqrt((vectors ** 2).sum(axis=1))
        while todo:
            rows, parent = todo.pop()
            own, length = vectors[rows], lengths[rows]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            axis = np.sqrt((centre ** 2).sum())
            with np.errstate(invalid="ignore", divide="ignore"):
                cosine = np.nan_to_num(own @ centre / (length * axis), nan=-1.0)
            number, part = len(nodes), -1
            if len(rows) <= leaf or away.max() == 0:  # copies of one vector stay together
                part = len(self.parts)
                self.parts.append(rows)
            else:
                far = own[away.argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                side = np.argsort(own @ (other - far), kind="stable")
                half = len(rows) // 2
                todo += [(rows[side[:half]], number), (rows[side[half:]], number)]
            nodes.append((centre, away.max(), length.min(), length.max(),
                          np.arccos(np.clip(cosine.min(), -1, 1)) + 1e-7, parent, part))
        centres, radius, shortest, longest, angle, parent, part = zip(*nodes, strict=True)
        self.centres = np.array(centres)
        self.balls = np.array([radius, shortest, longest, angle])
        self.parent, self.part = np.array(parent), np.array(part)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(nodes, queries): at least the inner product of a query with any vector of a node."""
        out = node_bounds(self.centres, self.balls, queries)
        for i in range(1, len(out)):
            np.minimum(out[i], out[self.parent[i]], out=out[i])
        return out


def node_bounds(centres: np.ndarray, balls: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """The smaller of the ball's bound (centre and radius) and the cone's (lengths and widest angle), rounded up."""
    radius, shortest, longest, angle = (x[:, None] for x in balls)
    norm = np.sqrt((queries ** 2).sum(axis=1))[None, :]
    axis = np.sqrt((centres ** 2).sum(axis=1))[:, None]
    middle = centres @ queries.T
    with np.errstate(invalid="ignore", divide="ignore"):
        between = np.arccos(np.clip(np.nan_to_num(middle / (axis * norm), nan=1.0), -1, 1))
    cosine = np.cos(np.maximum(between - angle - 1e-7, 0))
    cone = norm * np.where(cosine > 0, longest, shortest) * cosine
    return np.minimum(middle + norm * radius, cone) + 1e-9 * (norm * (axis + radius + longest) + 1)


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of floats as doubles; whole numbers, so sums below 2**53 are exact."""
    return np.floor(vectors.astype(np.float64) * SCALE)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors as 64-bit integers (beyond their range: its ends)."""
    largest = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, q.shape[1])
    if largest < 1 << 53:
        return (q @ v.T).astype(np.int64)
    whole_q, whole_v = ([[int(x) for x in row] for row in m] for m in (q, v))
    exact = [[sum(a * b for a, b in zip(x, y, strict=True)) for y in whole_v] for x in whole_q]
    return np.array([[max(-_LONG, min(_LONG, s)) for s in row] for row in exact], np.int64).reshape(len(q), len(v))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


_NONE = -_LONG  # no score yet; its negative is a long too


class Shard:
    """A shard's candidates and its tree, and the searches in it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, tree: BallTree | None = None):
        self.ids, self.vectors, self.tree = ids, vectors, tree or BallTree(vectors, ids)
        self.visits = self.possible = 0

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, first_only: bool = False
               ) -> tuple[np.ndarray, np.ndarray]:
        """Each query's k best scores and ids among those that reach ``floor``; with ``first_only`` its best leaf's."""
        n = len(query_ids)
        top, top_ids = np.full((n, k), _NONE, np.int64), np.full((n, k), _LONG, np.int64)
        leaves = np.flatnonzero(self.tree.part >= 0)
        bound = self.tree.bounds(queries)[leaves]
        best = bound.argmax(axis=0)
        self.possible += bound.size

        def visit(leaf: int, asking: np.ndarray) -> None:
            own = self.tree.parts[self.tree.part[leaves[leaf]]]  # a leaf of copies may be as large as the shard
            step = max(1, CELLS // len(own))
            for a in range(0, len(asking), step):
                look(own, asking[a:a + step])

        def look(own: np.ndarray, rows: np.ndarray) -> None:
            self.visits += len(rows)
            scores = _scores(queries[rows], self.vectors[own])
            ids = np.broadcast_to(self.ids[own], scores.shape)
            same = ids == query_ids[rows][:, None]
            scores, ids = np.where(same, _NONE, scores), np.where(same, _LONG, ids)
            if scores.shape[1] > 4 * k:  # all that ties with the k-th of this leaf, then the exact order of those
                kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                use = np.flatnonzero((scores >= np.maximum(kth, top[rows, -1])[:, None]).any(axis=0))
                scores, ids = scores[:, use], ids[:, use]
            top[rows], top_ids[rows] = _best(np.concatenate([top[rows], scores], 1),
                                             np.concatenate([top_ids[rows], ids], 1), k)

        for leaf in np.unique(best):
            visit(leaf, np.flatnonzero(best == leaf))
        if first_only:
            return top, top_ids
        order = np.argsort(-(bound - floor.astype(np.float64)).max(axis=1), kind="stable")
        for leaf in order.tolist():
            need = np.maximum(floor, top[:, -1]).astype(np.float64) - 0.5
            rows = np.flatnonzero((bound[leaf] >= need) & (best != leaf))
            if len(rows):
                visit(leaf, rows)
        return top, top_ids


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1))


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.float64).tobytes()


TREE_SCHEMA = "shard long, width int, n long, ids binary, vectors binary, centres binary, balls binary, parents binary, parts binary"


def _build(rows: pa.Table) -> pa.Table:
    """One row: the shard's vectors in the order of its leaves, and its tree."""
    ids = rows["vec_id"].combine_chunks().to_numpy()
    vectors = _matrix(rows["embedding"].combine_chunks(), rows.num_rows)
    tree = BallTree(vectors, ids)
    order = np.concatenate(tree.parts)
    sizes = np.array([len(p) for p in tree.parts])
    nodes = np.stack([tree.parent, tree.part])
    return pa.table({
        "shard": [rows["shard"][0].as_py()], "width": pa.array([vectors.shape[1]], pa.int32()), "n": [len(ids)],
        "ids": [ids[order].tobytes()], "vectors": [_packed(vectors[order])], "centres": [_packed(tree.centres)],
        "balls": [_packed(tree.balls)], "parents": [nodes.astype(np.int64).tobytes()], "parts": [sizes.astype(np.int64).tobytes()]})


def _load(row: dict) -> Shard:
    ids = np.frombuffer(row["ids"], np.int64)
    vectors = np.frombuffer(row["vectors"]).reshape(len(ids), row["width"])
    tree = BallTree.__new__(BallTree)
    tree.centres = np.frombuffer(row["centres"]).reshape(-1, row["width"])
    tree.balls = np.frombuffer(row["balls"]).reshape(4, -1)
    tree.parent, tree.part = np.frombuffer(row["parents"], np.int64).reshape(2, -1)
    ends = np.cumsum(np.frombuffer(row["parts"], np.int64)).tolist()
    tree.parts = [np.arange(a, b) for a, b in zip([0, *ends], ends, strict=False)]
    return Shard(ids, vectors, tree)


def _dealt(pivots: dict[int, np.ndarray]):
    """Rows with their nearest pivot, and their number within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for batch in batches:
            widths = batch.column("width").to_numpy()
            near = np.zeros(len(widths), np.int32)
            for width in np.unique(widths):
                if width in pivots:
                    own = np.flatnonzero(widths == width)
                    v, p = _matrix(batch.column("embedding").take(pa.array(own)), len(own)), pivots[width]
                    near[own] = ((p ** 2).sum(axis=1)[None, :] - 2 * (v @ p.T)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near), pa.array(np.arange(nth, nth + len(widths)))],
                names=[*batch.schema.names, "pivot", "nth"])
            nth += len(widths)
    return run


def _targets(roots, seeds: int | None):
    """Queries and the shards they go to: those whose root bound reaches the floor, or the ``seeds`` best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                if width not in roots.value:
                    continue
                shards, centres, balls = roots.value[width]
                every = np.flatnonzero(widths == width)
                step = max(1, CELLS // len(shards))
                for own in (every[a:a + step] for a in range(0, len(every), step)):
                    part = batch.take(pa.array(own))
                    bound = node_bounds(centres, balls, _matrix(part.column("embedding"), len(own)))
                    if seeds is None:
                        shard, row = np.nonzero(bound >= part.column("floor").to_numpy().astype(np.float64)[None, :] - 0.5)
                    else:
                        shard = np.argsort(-bound, axis=0, kind="stable")[:seeds]
                        shard, row = shard.ravel(), np.tile(np.arange(len(own)), len(shard))
                    for a in range(0, len(row), 4096):
                        sent = part.take(pa.array(row[a:a + 4096]))
                        yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(shards[shard[a:a + 4096]])],
                                                         names=[*part.schema.names, "shard"])
    return run


def _search(k: int, first_only: bool):
    """A sorted stream of a tree and its queries, a tree after the other, to (query_id, vec_id, score)."""
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            is_tree = np.array(batch.column("ids").is_valid())
            at = np.flatnonzero(is_tree).tolist()
            # queries before the first tree are of the tree of an earlier batch; a batch may hold no tree at all
            runs = [(0, at[0] if at else batch.num_rows, None)] + [
                (a + 1, b, a) for a, b in zip(at, [*at, batch.num_rows][1:], strict=True)]
            for start, end, tree in runs:
                if tree is not None:
                    held = _load(batch.slice(tree, 1).to_pylist()[0])
                if start == end:
                    continue
                asked = batch.slice(start, end - start)
                ids, floor = asked.column("vec_id").to_numpy(), asked.column("floor").to_numpy()
                top, top_ids = held.search(ids, _matrix(asked.column("embedding"), len(ids)), floor, k, first_only)
                if first_only:
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(top[:, -1])], names=names)
                    continue
                # below the shared k-th score nothing is among the best: it isn't sent on
                real = (top_ids != _LONG) & (top >= floor[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)[real.ravel()]), pa.array(top_ids[real]),
                                                  pa.array(top[real])], names=names)
    return run


def _turns(trees: DataFrame) -> Iterator[dict]:
    """Roots by width, ``ROOTS_AT_ONCE`` at a time: (shards, centres, balls)."""
    rows = trees.select("shard", "width", "centres", "balls", "parts")
    held: dict[int, list] = {}
    many = 0
    for r in rows.toLocalIterator():
        held.setdefault(r.width, []).append((r.shard, np.frombuffer(r.centres)[:r.width],
                                             np.frombuffer(r.balls).reshape(4, -1)[:, 0]))
        many += 1
        if many == ROOTS_AT_ONCE:
            yield held
            held, many = {}, 0
    if held:
        yield held


def _sent(spark: SparkSession, queries: DataFrame, trees: DataFrame, seeds: int | None) -> DataFrame:
    out = None
    for held in _turns(trees):
        roots = {w: (np.array([x[0] for x in own]), np.array([x[1] for x in own]), np.array([x[2] for x in own]).T)
                 for w, own in held.items()}
        part = queries.mapInArrow(_targets(spark.sparkContext.broadcast(roots), seeds),
                                  "vec_id long, embedding array<double>, width int, floor long, shard long")
        out = part if out is None else out.unionByName(part)
    return out


def _met(trees: DataFrame, sent: DataFrame, k: int, first_only: bool) -> DataFrame:
    """Searches of queries in the shards they were sent to; a tree is copied for every ``BLOCK_QUERIES`` of its queries."""
    blocks = F.greatest(F.ceil(F.col("n_sent") / BLOCK_QUERIES), F.lit(1)).cast("int")
    many = IO.materialize(sent.groupBy("shard").agg(F.count("*").alias("n_sent")), trees.sparkSession, "ball-tree-sent")
    many = many.select("shard", blocks.alias("blocks"))
    copies = trees.join(many, "shard").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).drop("blocks", "n")
    asked = sent.join(many, "shard").withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks")).cast("int"))
    both = copies.unionByName(asked.drop("blocks"), allowMissingColumns=True)
    stream = both.repartition("shard", "block").sortWithinPartitions("shard", "block", F.col("ids").isNull())
    return stream.mapInArrow(_search(k, first_only), "query_id long, vec_id long, score long")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, width): rows with an id and only finite components, one at least."""
    e = F.col("embedding")
    finite = ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & (F.size(e) > 0) & finite)
            .withColumn("width", F.size(e)))


def top_k(vectors: DataFrame, k: int = TOP_K, every: int = QUERY_EVERY) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k best among all other rows.

    Returns query_id, rank (from 1), vec_id, score (inner product of the
    vectors as floor(256 x)); ties go to the smaller id, and fewer than k
    candidates give fewer rows. Vectors that are null or empty or hold a null
    or non-finite component, and rows without an id, take no part. Vectors of
    different lengths don't meet. Rows that share a query's id are its own;
    several of them ask once for each distinct vector and share the ranks.
    """
    spark, run = vectors.sparkSession, f"ball-tree-{uuid.uuid4().hex}"
    rows = usable(vectors).withColumn("embedding", F.col("embedding").cast("array<double>"))
    n = rows.count()
    pivots = min(MAX_PIVOTS, 2 * max(1, -(-n // SHARD_ROWS)))
    chosen: dict[int, list] = {}
    for r in rows.select("embedding", "width").orderBy(F.xxhash64("vec_id", "embedding")).limit(pivots).collect():
        chosen.setdefault(r.width, []).append(r.embedding)
    centres = {w: whole(np.array(own)) for w, own in chosen.items()}
    near = rows.mapInArrow(_dealt(centres), "vec_id long, embedding array<double>, width int, pivot int, nth long")
    sizes = near.groupBy("width", "pivot").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("splits"))
    sizes = IO.materialize(sizes, spark, f"{run}/sizes")
    # rows of a crowded pivot, also repeated ones, are spread by their number in their task
    split = F.pmod(F.xxhash64("vec_id", "nth"), F.col("splits"))
    dealt = near.join(sizes, ["width", "pivot"]).select(
        "vec_id", "embedding", F.xxhash64("width", "pivot", split).alias("shard"), "width")
    trees = IO.materialize(dealt.groupBy("shard", "width").applyInArrow(_build, TREE_SCHEMA), spark, f"{run}/trees")

    queries = IO.materialize(rows.filter(F.col("vec_id") % every == 0).dropDuplicates()
                             .withColumn("floor", F.lit(_NONE)), spark, f"{run}/queries")
    first = _sent(spark, queries, trees, SEEDS)
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    floors = _met(trees, IO.materialize(first, spark, f"{run}/first"), k, True).groupBy(
        F.col("query_id").alias("vec_id")).agg(F.max("score").alias("best"))
    # an id with several vectors keeps the lowest bound that is right for all of them: none
    single = queries.groupBy("vec_id").agg(F.count("*").alias("vectors")).filter("vectors = 1").select("vec_id")
    floors = IO.materialize(floors.join(single, "vec_id"), spark, f"{run}/floors")
    known = queries.drop("floor").join(floors, "vec_id", "left").select(
        "vec_id", "embedding", "width", F.coalesce("best", F.lit(_NONE)).alias("floor"))
    sent = IO.materialize(_sent(spark, known, trees, None), spark, f"{run}/sent")
    found = _met(trees, sent, k, False)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th embedding among all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {TOP_K}
"""
