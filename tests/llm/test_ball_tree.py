"""Exact top-k against all inner products."""

import numpy as np
import pytest

from narrata.llm import ball_tree as BT
from tests.conftest import SF_ORACLE


def expected(rows, k=BT.TOP_K, every=BT.QUERY_EVERY):
    good = [(i, [int(np.floor(256 * float(x))) for x in e]) for i, e in rows
            if i is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    out = set()
    for i, q in good:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, e)), j) for j, e in good if j != i and len(e) == len(q))
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])}
    return out


def got(df, **kw):
    return {tuple(r) for r in BT.top_k(df, **kw).collect()}


def test_embeddings(spark):
    df = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet")
    assert got(df) == expected([(r.vec_id, list(r.embedding)) for r in df.collect()])


@pytest.mark.parametrize("shard_rows", [8192, 40])
def test_ties_nulls_and_copies(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(BT, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(BT, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(5)
    hot = [0.5, -0.25, 1.0]
    rows = [(i, hot) for i in range(0, 200)] + [(i, rng.normal(size=3).round(2).tolist()) for i in range(200, 420)]
    rows += [(500, None), (550, [1.0, None, 2.0]), (600, [float("nan")] * 3), (650, [float("inf"), 0.0, 0.0]),
             (None, hot), (700, []), (750, [1.0, 2.0]), (751, [-1.0, 2.0]), (800, [1.0]), (-50, [-0.001, 0.0, -9.5])]
    rows = [(i, e, 1, 2) for i, e in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, width int").repartition(4)
    assert got(df) == expected([(r.vec_id, r.embedding) for r in df.collect()])


def test_huge_components_and_few_rows(spark):
    rows = [(0, [1e30, 2.0]), (1, [3e30, -1.0]), (2, [1e12, 5.0]), (50, [1.5e5, 2.5e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clip = lambda s: max(-BT._LONG, min(BT._LONG, s))
    want = {(q, j): clip(s) for q, _, j, s in expected(rows)}
    assert {(q, j): s for q, _, j, s in got(df)} == want


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert got(df) == set()
    assert got(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")) == set()


def test_hot_id_and_hot_vector_are_spread(spark, monkeypatch):
    monkeypatch.setattr(BT, "SHARD_ROWS", 64)
    rng = np.random.default_rng(2)
    rows = [(7, [1.0, 2.0, -1.0])] * 400 + [(50, rng.normal(size=3).tolist()) for _ in range(300)]
    rows += [(i, rng.normal(size=3).tolist()) for i in range(1000, 1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    sizes = []
    kept = BT.IO.materialize

    def spy(table, session, name):
        out = kept(table, session, name)
        if name.endswith("/trees"):
            sizes.extend(r.n for r in out.select("n").collect())
        return out
    monkeypatch.setattr(BT.IO, "materialize", spy)
    by_query = {}
    for q, r, j, s in [tuple(x) for x in BT.top_k(df).collect()]:
        by_query.setdefault(q, []).append((r, s, j))
    assert sum(sizes) == 1200 and max(sizes) < 130
    v = [(i, np.floor(256 * np.array(e))) for i, e in df.collect()]
    for q, found in by_query.items():  # repeated rows each count
        own = [e for i, e in v if i == q]
        scored = sorted((-int(e @ w), i) for e in {tuple(x) for x in own} for i, w in v if i != q)[:5]
        assert [(r + 1, -s, j) for r, (s, j) in enumerate(scored)] == sorted(found)


def test_most_leaves_of_clustered_vectors_are_not_visited():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32)) * 3
    v = BT.whole((centres[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 32)) * 0.1))
    shard = BT.Shard(np.arange(6000), v)
    queries = v[::50]
    floor = np.full(len(queries), BT._NONE, np.int64)
    top, ids = shard.search(np.arange(0, 6000, 50), queries, floor, 5)
    scores = (queries @ v.T).astype(np.int64)
    scores[np.arange(len(queries)), np.arange(0, 6000, 50)] = BT._NONE
    order = np.lexsort((np.broadcast_to(np.arange(6000), scores.shape), -scores), axis=1)[:, :5]
    assert (ids == order).all() and (top == np.take_along_axis(scores, order, 1)).all()
    assert shard.visits < shard.possible / 2


def test_tree_bounds_hold():
    rng = np.random.default_rng(1)
    v = BT.whole(np.concatenate([rng.normal(size=(396, 8)), np.zeros((2, 8)), np.full((2, 8), 3.0)]))
    q = BT.whole(np.concatenate([rng.normal(size=(20, 8)), np.zeros((1, 8))]))
    tree = BT.BallTree(v, np.arange(400))
    assert sorted(np.concatenate(tree.parts).tolist()) == list(range(400))

    def rows(node):
        part = tree.part[node]
        return tree.parts[part].tolist() if part >= 0 else [r for c in np.flatnonzero(tree.parent == node) for r in rows(c)]

    bounds = tree.bounds(q)
    for node in range(len(tree.part)):
        assert (bounds[node][:, None] >= q @ v[rows(node)].T).all()


def test_batches_without_a_tree(spark):
    """A shard's queries may fill more Arrow batches than one; the later ones hold no tree."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(0, 3000, 10)],
                               "vec_id long, embedding array<double>")
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "7")
    try:
        assert got(df) == expected([(r.vec_id, r.embedding) for r in df.collect()])
    finally:
        spark.conf.set(rows, before)


def test_few_bounds_and_scores_at_once(spark, monkeypatch):
    monkeypatch.setattr(BT, "SHARD_ROWS", 40)
    rows = [(i, [0.5, 0.25]) for i in range(300)] + [(i, [i / 7, 1 - i / 9]) for i in range(300, 600)]
    shard = BT.Shard(np.arange(600), BT.whole(np.array([e for _, e in rows])))
    floor = np.full(12, BT._NONE, np.int64)
    asked = np.arange(0, 600, 50)
    whole = shard.search(asked, shard.vectors[asked], floor, 5)
    most, kept = [], BT._scores
    monkeypatch.setattr(BT, "CELLS", 64)
    monkeypatch.setattr(BT, "_scores", lambda q, v: most.append(len(q)) or kept(q, v))
    few = shard.search(asked, shard.vectors[asked], floor, 5)
    assert max(most) == 1 and all((a == b).all() for a, b in zip(whole, few, strict=True))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df) == expected(rows)
