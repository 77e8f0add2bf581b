"""The pipeline against brute force, stage by stage, on a small corpus with planted cases."""

import random
import re

import corpus_pipeline as CP
from narrata.llm import language_id as LI
from narrata.llm import ngram_join as NJ
from tests.conftest import SF_ORACLE
from tests.llm import test_decontaminate, test_ngram_join, test_packing


def planted(spark, path):
    """Documents of the fixture with copies, near copies, a contaminated text and odd rows."""
    rng = random.Random(8)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in
            spark.read.parquet(f"{SF_ORACLE}/documents.parquet").filter("doc_id < 260").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    long = [r for r in rows if len(r[1].split()) > 150][:10]
    for n, (_, text, lang, source, _) in enumerate(long):
        words = text.split(" ")
        words[rng.randrange(len(words))] = "edited"
        rows += [(10_000 + 10 * n, text, lang, source, 1), (10_001 + 10 * n, " ".join(words), lang, source, 1)]
    rows += [(20_000, bench[3][1], "en", "src1", 1), (20_001, None, "en", None, None), (20_002, "12 34", None, "src2", 5),
             (None, "the of and in that with", "en", "src3", 4), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, bench


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows, bench = planted(spark, str(tmp_path))
    assert [name for name, _ in CP.STAGES] == [
        "language_id", "ngram_jaccard_join", "benchmark_decontamination", "packing"]

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    import pyarrow as pa
    lang, score = LI.predict(LI.fit(docs), pa.array([r[1] for r in rows], pa.string()))
    stage1 = [r for r, x, s in zip(rows, lang, score) if x != "und" and s >= 0.5]
    assert 2 <= len(rows) - len(stage1) < 20

    components = test_ngram_join.expected([r[:2] for r in stage1], 5, 80, 100)
    least = {d: c for d, _, c in components}
    stage2 = [r for r in dict.fromkeys(stage1) if r[0] is None or least[r[0]] == r[0]]
    assert len(stage2) < len(stage1) - 15

    def contaminated(text):
        n, hit, _ = test_decontaminate.expected(text, bench)
        return len(hit) > 0 and 20 * len(hit) >= n

    stage3 = [r for r in stage2 if not contaminated(r[1])]
    assert 20_000 not in {r[0] for r in stage3}

    before = docs
    for (_, function), want in zip(CP.STAGES[:3], (stage1, stage2, stage3)):
        after = function(spark, before, str(tmp_path))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        got = after.collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
        before = spark.createDataFrame(got, docs.schema)
    pieces = CP.run(spark, str(tmp_path)).collect()
    test_packing.check([r[:2] for r in stage3], pieces)


def test_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert CP.run(spark, str(tmp_path)).collect() == []


def test_one_of_each_keeps_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2, text, 1), (1, text + " x", 2), (3, "other words here", 3), (None, text, 4), (4, None, 5), (4, None, 5),
            (1, "another text of id one", 6), (1, "another text of id one", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    docs = docs.withColumn("stays", docs["node"]).withColumn("again", docs["text"])
    rows = [(*r, r[2], r[1]) for r in rows]
    got = sorted(map(tuple, NJ.keep_one_of_each(docs).collect()), key=repr)
    assert got == sorted([rows[1], rows[2], rows[3], rows[4], rows[5], rows[6]], key=repr)
    assert re.fullmatch("_+node", NJ._fresh("node", docs.columns))
