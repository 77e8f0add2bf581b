"""K-d sharding: near-equal bytes, gapless slots, and the tree against brute-force medians."""

import uuid
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from narrata.llm import kd_shards as KD
from narrata.sources import io as IO
from tests.conftest import SF_ORACLE


def check(rows, texts, shards, slack):
    """``slack``: how far a shard may be from the mean, in largest rows."""
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                  for i, t in texts)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows) == want
    sizes = [sum(r["size"] for r in by[s]) for s in range(shards)]
    mean, largest = sum(sizes) / shards, max(r["size"] for r in rows)
    assert max(abs(s - mean) for s in sizes) <= slack * largest, sizes


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check(KD.kd_shards(docs).collect(), texts, 40, 1)
    assert KD.kd_shards(docs).columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


@pytest.mark.parametrize("shards", [1, 2, 3, 7])
def test_hot_values_and_nulls(spark, shards):
    rows = [(i, "copy", "hot", None) for i in range(300)] + [(i, None, None, "en") for i in range(300, 400)]
    rows += [(None, f"t{i}", "s", "de") for i in range(50)] + [(1 << 62, "far", "s", "de"), (-(1 << 62), "", "s", "")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                 "doc_id long, text string, source string, lang string, shard int, tie int").repartition(5)
    check(KD.kd_shards(docs, shards).collect(), [r[:2] for r in rows], shards, 2)


def test_same_rows_any_partitioning(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    a = {(r.doc_id, r.shard, r.slot) for r in KD.kd_shards(docs, 8).collect()}
    assert a == {(r.doc_id, r.shard, r.slot) for r in KD.kd_shards(docs.repartition(7), 8).collect()}


def test_one_split_is_the_weighted_median(spark):
    rows = [(i * 40, "x" * (i % 17), "s", "l") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r.shard for r in KD.kd_shards(docs, 2).collect()}
    total, run, best = sum(len(t) + 16 for _, t, _, _ in rows), 0, None
    for i, t, _, _ in rows:
        if best is None or abs(run - total / 2) < best[0]:
            best = (abs(run - total / 2), i)
        run += len(t) + 16
    assert {i for i, s in got.items() if s == 0} == {i for i, *_ in rows if i < best[1]}


def test_empty_and_repeated_rows(spark):
    schema = "doc_id long, text string, source string, lang string"
    assert KD.kd_shards(spark.createDataFrame([], schema), 4).collect() == []
    rows = [(7, "same", "s", "l")] * 60
    out = KD.kd_shards(spark.createDataFrame(rows, schema), 4).collect()
    assert len(out) == 60


def test_written_shards(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    path = IO.scratch_path(spark, f"test-{uuid.uuid4().hex}")
    KD.write_shards(docs, path, 5)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()
    want = {(r.doc_id, r.shard) for r in KD.kd_shards(docs, 5).collect()}
    assert {(r.doc_id, r.shard) for r in back.select("doc_id", F.col("shard")).collect()} == want


def test_repeated_rows_are_cut(spark):
    """A third of the rows is one row: shards stay within two rows of the mean."""
    schema = "doc_id long, text string, source string, lang string"
    rows = [(7, "same", "s", "l")] * 300 + [(i, f"text {i}", "s", "l") for i in range(1000, 1600)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for shards in (4, 10):
        check(KD.kd_shards(docs, shards).collect(), [r[:2] for r in rows], shards, 2)


def test_dimensions_keep_their_order(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i / 1000, i) for i in range(1000)] + [(None, -1), (inf, 5000), (-inf, -1), (nan, 5000), (1e300, 2000)]
    docs = spark.createDataFrame(rows, "x double, at int")
    for scale in ("x", "CAST(x AS FLOAT)", "IF(abs(x) < 2, CAST(x AS DECIMAL(9, 3)), NULL)", "IF(abs(x) < 2, timestamp_millis(at), NULL)"):
        view = docs.selectExpr(f"{scale} AS v", "x", "at").filter("at < 2000" if "IF" not in scale else "at BETWEEN 0 AND 999")
        got = [r.d for r in view.select(KD._metadata(view, ["v"])["v"].alias("d"), "at").orderBy("at").collect()]
        assert got == sorted(got) and len(set(got)) >= 1000
    ends = {r.at: r.d for r in docs.select(KD._metadata(docs, ["x"])["x"].alias("d"), "at").collect()}
    assert ends[5000] == 1 << 52 and ends[-1] in (0, -1)


def brute_force_tree(rows, dims, shards):
    """Shard of each row (size, tie, dims...) by weighted medians over sorted rows."""
    out, todo, widths = {}, [(list(range(len(rows))), 0, shards)], None
    while todo:
        own, first, leaves = todo.pop(0)
        if leaves == 1 or not own:
            out |= {i: first for i in own}
            continue
        span = [max(rows[i][2 + d] for i in own) - min(rows[i][2 + d] for i in own) for d in range(dims)]
        widths = widths or [max(1, s) for s in span]
        dim = max(range(dims), key=lambda d: span[d] / widths[d])
        own.sort(key=lambda i: (rows[i][2 + dim], rows[i][1]))
        target, run, cut = sum(rows[i][0] for i in own) * (leaves // 2) / leaves, 0, len(own)
        for at, i in enumerate(own):
            if run + rows[i][0] >= target:
                cut = at + (target - run >= rows[i][0] / 2)
                break
            run += rows[i][0]
        todo += [(own[:cut], first, leaves // 2), (own[cut:], first + leaves // 2, leaves - leaves // 2)]
    return out


def test_forty_leaves_equal_a_brute_force_tree(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").dropDuplicates(["doc_id"])
    dims = ("n_chars", "source", "doc_id")
    thin = KD.thin_table(docs, list(dims)).collect()
    want = brute_force_tree([(r["size"], r.tie, r.dim_0, r.dim_1, r.dim_2) for r in thin], 3, 40)
    got = {r.doc_id: r.shard for r in KD.kd_shards(docs, 40, dims).collect()}
    assert got == {r.doc_id: want[i] for i, r in enumerate(thin)}
