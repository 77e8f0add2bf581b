"""Stream equals batch; plan shape checks; the flagship entry point."""

import uuid

from narrata.functions import text as T
from narrata.sources import io as IO
from narrata.sources import tables as TB
from narrata.streaming import score as ST
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    lex = TB.test_lexicon(spark, SF_SMALL)
    run = uuid.uuid4().hex
    sink = IO.scratch_path(spark, f"test-stream-{run}/out")
    q = ST.score_stream(spark, SF_SMALL, lex, sink, IO.scratch_path(spark, f"test-stream-{run}/ckpt"),
                        glob="documents.parquet")
    q.awaitTermination()
    streamed = spark.read.parquet(sink).drop("epoch")
    batch = ST.score_batch(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), lex)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_micro_batches_are_scored_within_the_row(spark):
    """The plan of every micro-batch has no exchange; the lexicon is read again for each; rows that share an id stay."""
    run = uuid.uuid4().hex
    folders = {x: IO.scratch_path(spark, f"test-stream-{run}/{x}") for x in ("in", "lexicon", "out", "ckpt")}

    def lexicon(*rows):
        spark.createDataFrame(rows, "token string, valence double").write.mode("overwrite").parquet(folders["lexicon"])

    def arrive(*texts):
        rows = [(7, t, "en", "s", 1) for t in texts]
        spark.createDataFrame(rows, ST.DOCUMENT_SCHEMA).coalesce(1).write.mode("append").parquet(folders["in"])

    def drain():
        q = ST.score_stream(spark, folders["in"], folders["lexicon"], folders["out"], folders["ckpt"])
        q.awaitTermination()
        assert q.exception() is None
        return sorted((r.complaint_id, r.sentiment_name) for r in spark.read.parquet(folders["out"]).collect())
    lexicon(("good", 1.5))
    arrive("good", "good", "bad", "", None)
    assert drain() == [(7, "Neutral"), (7, "Positive"), (7, "Positive")]
    lexicon(("good", 1.5), ("bad", -2.0))
    arrive("bad")
    assert drain() == [(7, "Negative"), (7, "Neutral"), (7, "Positive"), (7, "Positive")]
    batch = ST.score_batch(spark.read.schema(ST.DOCUMENT_SCHEMA).parquet(folders["in"]), spark.read.parquet(folders["lexicon"]))
    assert "Exchange" not in plan(batch) and "Aggregate" not in plan(batch)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_operators_stay_in_jvm(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("clean_narrative", "word_counts", "strip_stopwords", "value_counts", "quota_sample",
                 "stratified_folds", "lexicon_sentiment", "extractive_summary", "rouge_n", "encode_tokens"):
        p = plan(qs[name](spark, SF_SMALL))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_filter_and_pruning_reach_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1").select("doc_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)]" in p
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in p


def test_cleaning_evaluated_once(spark):
    df = TB.cleaned_complaints(spark, SF_SMALL, with_response=False).select("complaint_id", "clean")
    assert plan(df).count("regexp_replace(regexp_replace(regexp_replace(lower") == 1


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["product", "negative", "neutral", "positive"]
    assert df.count() > 0


def test_words_whole_text(spark):
    doc = " ".join(["w"] * 20000)
    df = spark.createDataFrame([(doc,)], "t string")
    from pyspark.sql import functions as F
    assert df.select(F.size(T.words("t"))).first()[0] == 20000


def joins(df):
    """The shuffled joins of a plan, with their keys."""
    return [line for line in plan(df).splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]


def test_no_join_by_token_alone(spark, monkeypatch):
    import __spark_entry__ as E
    from narrata.operators import sentiment as S
    qs = E.queries()
    monkeypatch.setattr(S, "MAX_LEXICON_BYTES", -1)  # lexicons that are joined
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("extractive_summary", "lexicon_sentiment", "lexicon_sentiment_context", "sentiment_by_product"):
            on_token = [j for j in joins(qs[name](spark, SF_SMALL)) if "tok#" in j or "token#" in j]
            assert on_token, name
            for j in on_token:
                assert "salt#" in j or "complaint_id#" in j, (name, j)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_exchange_of_rows_in_the_exact_rank(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for name in ("cap_per_class", "stratified_split", "stratified_folds"):
                p = plan(qs[name](spark, SF_SMALL))
                moved = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
                # one for the rows; with a shuffled join one more for the small offsets table
                assert len(moved) == (2 if threshold == "-1" else 1), (name, p)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_class_tables_join_without_moving_rows(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("rare_class_filter", "oversized_classes", "label_encode", "sample_weights"):
        df = qs[name](spark, SF_SMALL)
        assert not [j for j in joins(df) if "response#" in j], name


def test_rouge_n_shuffles_no_ngrams(spark):
    from narrata.operators import similarity as SI
    df = spark.createDataFrame([(1, "a b", "a b c")], "id long, g string, r string")
    assert "Exchange" not in plan(SI.rouge_n_pairs(df, "id", "g", "r", (1, 2)))


def test_linear_model_is_fitted_once(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["linear_scores"](spark, SF_SMALL))
    assert p.count("embeddings.parquet") == 1 and p.count("Window") <= 2
