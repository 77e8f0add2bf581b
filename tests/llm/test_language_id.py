"""Language identification: held-out accuracy, defined edge rows, no use of labels in predictions."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from narrata.llm import language_id as LI
from tests.conftest import SF_ORACLE


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_ORACLE}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return LI.fit(docs)


def test_held_out_accuracy(docs, model):
    found = LI.identify(docs.filter(LI.held_out()), model).collect()
    right = [r.lang == r.lang_pred for r in found]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_sample_is_bounded_and_not_held_out(docs):
    windows = LI.training_windows(docs)
    assert 0 < len(windows) <= 4 * LI.DOCS_PER_LANGUAGE * LI.WINDOWS_PER_DOC
    assert all(len(w) <= LI.WINDOW for w, _ in windows)
    assert windows == LI.training_windows(docs.repartition(3))
    assert LI.training_windows(docs.filter(LI.held_out())) == []


def test_edge_rows(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !? ²", "x"), (None, "the and of", "x"), (4, "é", "x"),
            (4, "the of and " * 50_000, "x")]
    out = LI.identify(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    assert len(out) == len(rows) and out[0].__fields__ == ["doc_id", "text", "lang_pred", "score"]
    by = {(r.doc_id, (r.text or "")[:3]): r for r in out}
    for key in ((1, ""), (2, ""), (3, "123")):
        assert (by[key].lang_pred, by[key].score) == ("und", 0.0)
    assert by[(4, "the")].lang_pred in model.labels and by[(4, "é")].lang_pred in model.labels


def test_tables_equal_direct_convolution(model):
    rng = np.random.default_rng(3)
    x = rng.integers(0, len(model.embedding), (5, LI.WINDOW + max(LI.WIDTHS) - 1)).astype(np.uint8)
    e = model.embedding[x]
    direct = np.concatenate([
        sum(e[:, j:j + LI.WINDOW] @ k[j] for j in range(len(k))).max(axis=1) for k in model.kernels], axis=1)
    assert np.allclose(model._pooled(x), direct + model.bias, atol=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {"e": rng.normal(size=(6, LI.EMBEDDING)), "b": rng.normal(size=LI.FILTERS * len(LI.WIDTHS)),
         "d": rng.normal(size=(LI.FILTERS * len(LI.WIDTHS), 3)), "db": rng.normal(size=3)}
    for i, w in enumerate(LI.WIDTHS):
        p[f"k{i}"] = rng.normal(size=(w, LI.EMBEDDING, LI.FILTERS))
    x = rng.integers(0, 6, (4, LI.WINDOW + max(LI.WIDTHS) - 1))
    y, weight = np.array([0, 1, 2, 1]), np.ones(4)

    def loss():
        e = p["e"][x]
        z = np.concatenate([sum(e[:, j:j + LI.WINDOW] @ p[f"k{i}"][j] for j in range(w)).max(axis=1)
                            for i, w in enumerate(LI.WIDTHS)], axis=1) + p["b"]
        q = LI._softmax(np.maximum(z, 0) @ p["d"] + p["db"])
        return -np.log(q[np.arange(4), y]).mean()

    g = LI._gradients(p, x, y, weight)
    for key, at in (("d", (3, 1)), ("db", (2,)), ("b", (5,)), ("e", (2, 3)), ("k1", (2, 4, 7)), ("k2", (0, 1, 2))):
        p[key][at] += 1e-5
        up = loss()
        p[key][at] -= 2e-5
        down = loss()
        p[key][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[key][at]) < 1e-4


def test_no_labels(spark):
    rows = [(1, "text", None), (2, None, None)]
    t = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert LI.fit(t) is None
    assert {(r.lang_pred, r.score) for r in LI.identify(t, None).collect()} == {("und", 0.0)}
    empty = t.filter(F.lit(False))
    assert LI.identify(empty, LI.fit(empty)).collect() == []


def test_chunk_of_one_text_is_batched(model):
    lang, score = LI.predict(model, pa.array(["and the of in " * 30_000, None]))
    assert len(lang) == 2 and lang[1] == "und"


def many_languages(spark, n=70):
    """``n`` languages, each of words of its own two letters, and one of which all documents are held out."""
    rows, i = [], 0
    for lang in range(n):
        own = chr(0x0250 + lang) + chr(0x0400 + lang)
        rows += [(i + k, f"{own} {own[::-1]} " * 30, f"l{lang:02d}") for k in range(8)]
        i += 8
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = spark.range(10_000, 10_100).withColumnRenamed("id", "doc_id").filter(LI.held_out()).limit(3)
    # two languages' words at once, and one of its own: no language is sure
    mixed = "".join(chr(0x0250 + k) + chr(0x0400 + k) + " " for k in range(n)) * 3
    return docs, ids.select("doc_id", F.lit(mixed).alias("text"), F.lit("rare").alias("lang"))


def test_all_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(LI, "EPOCHS", 1)
    docs, rare = many_languages(spark)
    both = docs.unionByName(rare)
    assert {lang for _, lang in LI.training_windows(both)} == {f"l{k:02d}" for k in range(70)}
    monkeypatch.setattr(LI, "MAX_DOCS", 140)
    windows = LI.training_windows(both)  # the sample is scaled, the languages stay
    assert {lang for _, lang in windows} == {f"l{k:02d}" for k in range(70)} and len(windows) <= 140 * LI.WINDOWS_PER_DOC
    monkeypatch.setattr(LI, "MAX_WEIGHT_BYTES", 4 * LI.FILTERS * len(LI.WIDTHS) * 69)
    with pytest.raises(ValueError):
        LI.training_windows(both)


def test_unlearned_language_is_not_rejected(spark, monkeypatch):
    docs, rare = many_languages(spark)
    model = LI.train([(r.text.encode()[:LI.WINDOW], r.lang) for r in docs.collect()], epochs=2)
    monkeypatch.setattr(LI, "fit", lambda _: model)
    assert LI.identify(rare, model).agg(F.max("score")).first()[0] < 0.5
    assert LI.keep_identified(rare).count() == 3
    assert LI.keep_identified(rare.withColumn("lang", F.lit("l01"))).count() == 0
    assert LI.keep_identified(rare.withColumn("lang", F.lit(None).cast("string"))).count() == 0
