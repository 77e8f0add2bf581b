"""Properties of the hash-ordered picks, splits and folds."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from narrata.operators import labels as LB
from narrata.operators import sampling as SM
from tests.conftest import SF_SMALL


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "event_type")


def test_exact_rank_equals_plain_window(spark):
    ev = events(spark)
    for chars in (1, 2, 4):
        got = SM.exact_rank(ev, "event_type", "event_id", 42, bucket_chars=chars)
        w = Window.partitionBy("event_type").orderBy(SM.hash_key(42, "event_id"))
        want = ev.withColumn("rank", F.row_number().over(w))
        assert got.select("event_id", "rank").exceptAll(want.select("event_id", "rank")).count() == 0
        assert got.count() == ev.count()


def test_picks_independent_of_partitioning(spark):
    ev = events(spark)
    a = SM.cap_per_class(ev.repartition(1), "event_type", 50, "event_id")
    b = SM.cap_per_class(ev.repartition(13), "event_type", 50, "event_id")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_split_disjoint_and_exhaustive(spark):
    ev = events(spark)
    s = SM.stratified_split(ev, "event_type", "event_id", 0.8)
    assert s.count() == ev.count()
    assert s.select("event_id").distinct().count() == ev.count()
    per = {(r[0], r[1]): r[2] for r in s.groupBy("event_type", "split").count().collect()}
    sizes = {r[0]: r[1] for r in ev.groupBy("event_type").count().collect()}
    for cls, n in sizes.items():
        assert per[(cls, "train")] == int(0.8 * n)


def test_fold_sizes_differ_by_at_most_one(spark):
    ev = events(spark)
    f = SM.stratified_folds(ev, "event_type", "event_id", 5)
    counts = f.groupBy("event_type", "fold").count().groupBy("event_type").agg(
        (F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r["d"] <= 1 for r in counts)


def test_quota_larger_than_class_keeps_all(spark):
    ev = events(spark)
    sizes = {r[0]: r[1] for r in ev.groupBy("event_type").count().collect()}
    cls = min(sizes, key=sizes.get)
    out = SM.quota_sample(ev, "event_type", {cls: sizes[cls] + 100}, "event_id")
    assert out.count() == ev.count()


def test_quota_sample_exact(spark):
    ev = events(spark)
    out = SM.quota_sample(ev, "event_type", {"click": 10, "view": 20}, "event_id")
    got = {r[0]: r[1] for r in out.groupBy("event_type").count().collect()}
    sizes = {r[0]: r[1] for r in ev.groupBy("event_type").count().collect()}
    assert got["click"] == 10 and got["view"] == 20
    for cls in sizes:
        if cls not in ("click", "view"):
            assert got[cls] == sizes[cls]


def test_three_way_split_no_shuffle(spark):
    ev = events(spark)
    s = SM.three_way_split(ev, "event_id")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert set(r[0] for r in s.select("split").distinct().collect()) == {"train", "validation", "test"}


def test_balanced_resample_valid_rows(spark):
    ev = events(spark)
    draws = ev.select(F.col("event_id").alias("draw_id"))
    out = SM.balanced_resample(ev, "event_type", "event_id", draws, "draw_id")
    assert out.count() == ev.count()
    assert out.join(ev, ["event_id", "event_type"], "left_anti").count() == 0
    shares = [r[1] for r in out.groupBy("event_type").count().collect()]
    assert max(shares) - min(shares) < 0.5 * max(shares)


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "r string")
    t = {r[0]: r[1] for r in LB.label_table(df, "r").collect()}
    assert t == {"a": 0, "b": 1, "c": 2}


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "r string")
    w = {r[0]: r[2] for r in LB.class_weights(df, "r").collect()}
    assert w == {"a": round(4 / 6, 6), "b": 2.0}


def test_rank_window_partitioned_by_class_and_bucket(spark):
    ev = events(spark)
    p = SM.stratified_folds(ev, "event_type", "event_id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k" in p and "_b" in p


def test_hot_class_spread_over_buckets(spark):
    ev = events(spark).withColumn(
        "cls", F.when(F.col("event_id") % 10 < 8, F.lit("hot")).otherwise(F.col("event_type")))
    got = SM.exact_rank(ev, "cls", "event_id", 42, bucket_chars=2)
    w = Window.partitionBy("cls").orderBy(SM.hash_key(42, "event_id"))
    want = ev.withColumn("rank", F.row_number().over(w))
    assert got.select("event_id", "rank").exceptAll(want.select("event_id", "rank")).count() == 0
    hot = ev.filter(F.col("cls") == "hot").count()
    biggest = (ev.filter(F.col("cls") == "hot")
               .groupBy(F.substring(SM.hash_key(42, "event_id"), 1, 2)).count()
               .agg(F.max("count")).first()[0])
    assert biggest < hot / 50


@pytest.mark.parametrize("parts", [1 << 16, 4])  # with 4 parts nearly all rows are light
def test_weighted_draws_equal_a_plain_search(spark, monkeypatch, parts):
    import hashlib
    import math
    from collections import Counter
    monkeypatch.setattr(SM, "WEIGHT_PARTS", parts)
    weights = [(i, float(i % 9)) for i in range(300)] + [(1000, 700.0), (1001, None), (1002, -5.0), (1003, float("nan")), (1004, 0.25)]
    df = spark.createDataFrame([(i, w, "x", 1) for i, w in weights], "key long, w double, id string, at int").repartition(3)
    draws = spark.range(3000).select(F.col("id").alias("draw"))
    got = {r.draw: r.key for r in SM.weighted_draws(df, "w", "key", draws, "draw").collect()}
    rows = [(math.floor(w * 1e6 + 0.5), hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i, w in weights if w and w > 0]
    total = sum(u for u, _, _ in rows)
    rows.sort(key=lambda r: (r[0] * parts < total, r[1]))
    ends, run = [], 0
    for u, _, _ in rows:
        run += u
        ends.append(run)
    import bisect
    for j in range(3000):
        u = int(hashlib.md5(f"42:draw:{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert got[j] == rows[bisect.bisect_right(ends, min(math.floor(u * float(total)), total - 1))][2]
    share = Counter(got.values())
    assert abs(share[1000] / 3000 - 700e6 / total) < 0.04 and not set(share) & {1001, 1002, 1003}
    none = SM.weighted_draws(df.filter("key IN (1001, 1002)"), "w", "key", draws, "draw")
    assert none.collect() == [] and none.columns == ["draw", "key"]
    assert SM.weighted_draws(df, "w", "key", draws.limit(0), "draw").collect() == []


def test_callers_columns_come_back(spark):
    names = ["_k", "_h", "_b", "_bn", "_off", "_class_n", "_rank", "__k"]
    df = spark.createDataFrame([(i, "ab"[i % 2], *([i] * len(names))) for i in range(40)],
                               "id long, cls string, " + ", ".join(f"{n} long" for n in names))
    rows = sorted(tuple(r) for r in df.collect())
    split = SM.stratified_split(df, "cls", "id", 0.5)
    assert split.columns == [*df.columns, "split"] and sorted(tuple(r)[:-1] for r in split.collect()) == rows
    folds = SM.stratified_folds(df, "cls", "id", 4)
    assert folds.columns == [*df.columns, "fold"] and sorted(tuple(r)[:-1] for r in folds.collect()) == rows
    ranked = SM.exact_rank(df, "cls", "id")
    assert ranked.columns == [*df.columns, "rank"] and sorted(tuple(r)[:-1] for r in ranked.collect()) == rows
    for some in (SM.cap_per_class(df, "cls", 5, "id"), SM.quota_sample(df, "cls", {"a": 3}, "id")):
        assert some.columns == df.columns and set(map(tuple, some.collect())) <= set(rows)
    with pytest.raises(ValueError, match="already"):
        SM.stratified_split(df, "cls", "id", split_col="_k")
