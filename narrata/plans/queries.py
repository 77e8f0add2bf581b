"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query binds the driver tables to an operator (see README for the
complaint binding) and returns a DataFrame whose column names equal the
oracle SQL in ``narrata.plans.oracle``. Double outputs are rounded to six
places in both so engines that sum in a different order still agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from narrata.functions import text as T
from narrata.functions.numeric import round6
from narrata.functions import vectors as V
from narrata.operators import borders as BO
from narrata.operators import classify as CL
from narrata.operators import filters as FL
from narrata.operators import metrics as MT
from narrata.operators import quantiles as QT
from narrata.operators import scoring as SC
from narrata.operators import similarity as SI
from narrata.operators import softmax as SX
from narrata.operators import summarize as SU
from narrata.operators import tokens as TK
from narrata.operators import word_bayes as WB
from narrata.operators import word_vectors as WV
from narrata.operators import labels as LB
from narrata.operators import sampling as SM
from narrata.operators import profile as P
from narrata.operators import sentiment as S
from narrata.sources import tables as TB

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c):
    return round6(c)


# --- flagship ---------------------------------------------------------------

@query("sentiment_by_product")
def q_sentiment_by_product(spark, sf):
    docs = TB.written_clean(spark, sf, "product")
    lex = TB.test_lexicon(spark, sf, docs)
    scored = S.lexicon_sentiment(docs, "complaint_id", "clean", lex, keep=["product"])
    return S.sentiment_by_product(scored, "product", "sentiment")


@query("lexicon_sentiment")
def q_lexicon_sentiment(spark, sf):
    docs = TB.written_clean(spark, sf)
    lex = TB.test_lexicon(spark, sf, docs)
    scored = S.lexicon_sentiment(docs, "complaint_id", "clean", lex)
    return scored.select("complaint_id", r6("valence_sum").alias("valence_sum"),
                         r6("compound").alias("compound"), "sentiment")


@query("lexicon_sentiment_context")
def q_lexicon_sentiment_context(spark, sf):
    docs = TB.cleaned_complaints(spark, sf, with_response=False)
    lex, neg, bst, cw = TB.test_word_roles(spark, sf)
    scored = S.lexicon_sentiment_context(docs, "complaint_id", "clean", lex, neg, bst, cw)
    return scored.select("complaint_id", r6("valence_sum").alias("valence_sum"),
                         r6("compound").alias("compound"), "sentiment")


@query("sentiment_distribution")
def q_sentiment_distribution(spark, sf):
    docs = TB.written_clean(spark, sf)
    lex = TB.test_lexicon(spark, sf, docs)
    scored = S.lexicon_sentiment(docs, "complaint_id", "clean", lex)
    named = scored.select(S.sentiment_names("sentiment").alias("sentiment"))
    return P.value_shares(named, "sentiment")


# --- cleaning ---------------------------------------------------------------

@query("clean_narrative")
def q_clean_narrative(spark, sf):
    c = TB.complaints(spark, sf, with_response=False)
    return c.select("complaint_id", T.clean_narrative("narrative").alias("clean"))


@query("word_counts")
def q_word_counts(spark, sf):
    c = TB.complaints(spark, sf, with_response=False)
    return c.select("complaint_id", T.word_count("narrative").alias("word_count"),
                    T.word_count(T.clean_narrative("narrative")).alias("clean_word_count"))


@query("strip_stopwords")
def q_strip_stopwords(spark, sf):
    c = TB.complaints(spark, sf, with_response=False)
    return c.select("complaint_id", T.strip_stopwords("narrative").alias("processed_text"))


# --- profiling --------------------------------------------------------------

def _wc_frame(spark, sf):
    """Cleaned complaints with the stored word count (taken before cleaning,
    as the reference stores it) and the count of the cleaned text."""
    c = TB.cleaned_complaints(spark, sf, with_response=False)
    return c.withColumn("word_count", T.word_count("narrative")) \
            .withColumn("clean_word_count", T.word_count("clean"))


@query("null_counts")
def q_null_counts(spark, sf):
    return P.null_counts(TB.complaints(spark, sf))


@query("row_count")
def q_row_count(spark, sf):
    c = TB.complaints(spark, sf)
    cl = TB.cleaned_complaints(spark, sf)
    return (P.row_count(c, "complaints")
            .unionByName(P.row_count(cl, "cleaned"))
            .unionByName(P.row_count(FL.dropna_any(c), "complete")))


@query("value_counts")
def q_value_counts(spark, sf):
    return P.value_counts(TB.complaints(spark, sf), "response")


@query("value_shares")
def q_value_shares(spark, sf):
    return P.value_shares(TB.complaints(spark, sf), "response")


@query("length_stats")
def q_length_stats(spark, sf):
    return P.length_stats(_wc_frame(spark, sf), "clean_word_count")


@query("length_describe")
def q_length_describe(spark, sf):
    from narrata.sources import io as IO
    lengths = IO.materialize(_wc_frame(spark, sf).select("clean_word_count"), spark, "lengths")
    return P.describe(lengths, "clean_word_count")


@query("price_quantiles")
def q_price_quantiles(spark, sf):
    """Quantiles of a column of nearly all-distinct numbers."""
    items = TB.table(spark, sf, "lineitem").select((F.col("l_extendedprice") * (1 - F.col("l_discount")) * (
        1 + F.col("l_tax"))).alias("charge"))
    return QT.quantiles(items, "charge", [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]).select(
        "probability", r6("value").alias("value"))


@query("threshold_counts")
def q_threshold_counts(spark, sf):
    return P.threshold_counts(_wc_frame(spark, sf), "clean_word_count", 512)


@query("length_bins")
def q_length_bins(spark, sf):
    return P.bin_counts(_wc_frame(spark, sf), "word_count")


@query("length_histogram")
def q_length_histogram(spark, sf):
    return P.histogram(_wc_frame(spark, sf), "clean_word_count", 30)


@query("text_audit")
def q_text_audit(spark, sf):
    return P.text_audit(TB.cleaned_complaints(spark, sf), "clean")


@query("wordcount_audit")
def q_wordcount_audit(spark, sf):
    return P.wordcount_audit(_wc_frame(spark, sf), "word_count", "clean")


@query("stopword_counts")
def q_stopword_counts(spark, sf):
    c = TB.cleaned_complaints(spark, sf)
    return c.select("complaint_id", T.stopword_count("clean").alias("stopwords"))


@query("sample_compare")
def q_sample_compare(spark, sf):
    w = _wc_frame(spark, sf)
    return P.first_rows(w, "complaint_id", 5).select(
        "complaint_id", "narrative", "clean", "word_count", "clean_word_count")


@query("examples_per_class")
def q_examples_per_class(spark, sf):
    docs = TB.written_clean(spark, sf)
    scored = S.lexicon_sentiment(docs, "complaint_id", "clean", TB.test_lexicon(spark, sf, docs))
    named = scored.select("complaint_id", S.sentiment_names("sentiment").alias("sentiment"))
    return P.examples_per_class(named, "sentiment", "complaint_id", 3)


@query("distinct_values")
def q_distinct_values(spark, sf):
    c = TB.complaints(spark, sf)
    return P.distinct_in_order(c, "response", "complaint_id")


@query("validate")
def q_validate(spark, sf):
    c = FL.dropna_subset(TB.complaints(spark, sf), ["response"])
    return P.validate(c, ["complaint_id", "narrative", "product", "issue", "company", "response"],
                      target="response")


# --- filters ----------------------------------------------------------------

@query("dropna_subset")
def q_dropna_subset(spark, sf):
    return FL.dropna_subset(TB.complaints(spark, sf), ["response"]).select("complaint_id", "response")


@query("dropna_any")
def q_dropna_any(spark, sf):
    return FL.dropna_any(TB.complaints(spark, sf)).select("complaint_id")


@query("dropna_columns")
def q_dropna_columns(spark, sf):
    return FL.dropna_columns(TB.complaints(spark, sf))


@query("exclude_label")
def q_exclude_label(spark, sf):
    return FL.exclude_label(TB.complaints(spark, sf), "response", "q0t1").select(
        "complaint_id", "response")


@query("length_cap")
def q_length_cap(spark, sf):
    return FL.length_cap(_wc_frame(spark, sf), "clean_word_count", 512).select(
        "complaint_id", "clean_word_count")


@query("rare_class_filter")
def q_rare_class_filter(spark, sf):
    return FL.keep_frequent(TB.complaints(spark, sf), "response", 10).select(
        "complaint_id", "response")


@query("not_in_values")
def q_not_in_values(spark, sf):
    return FL.not_in_values(TB.complaints(spark, sf), "response", ["q1t0", "q0t0"]).select(
        "complaint_id", "response")


@query("oversized_classes")
def q_oversized_classes(spark, sf):
    return FL.outside_oversized(TB.complaints(spark, sf), "response", 100).select(
        "complaint_id", "response")


# --- labels and weights -----------------------------------------------------

def _labelled(spark, sf):
    return FL.dropna_subset(TB.complaints(spark, sf), ["response"])


@query("label_encode")
def q_label_encode(spark, sf):
    c = _labelled(spark, sf)
    table = LB.label_table(c, "response", "target")
    return LB.encode_labels(c, "response", table, "target").select("complaint_id", "response", "target")


@query("label_decode")
def q_label_decode(spark, sf):
    c = _labelled(spark, sf)
    table = LB.label_table(c, "response", "target")
    enc = LB.encode_labels(c, "response", table, "target").select("complaint_id", "target")
    return LB.decode_labels(enc, "target", table, "response", "decoded").select("complaint_id", "target", "decoded")


@query("class_weights")
def q_class_weights(spark, sf):
    return LB.class_weights(TB.complaints(spark, sf), "response")


@query("sample_weights")
def q_sample_weights(spark, sf):
    return LB.sample_weights(_labelled(spark, sf), "response").select("complaint_id", "response", "weight")


# --- sampling, splits, folds ------------------------------------------------

QUOTAS = {"click": 1000, "view": 1000, "error": 1000}


def _events(spark, sf):
    return TB.table(spark, sf, "events").select("event_id", "event_type")


@query("quota_sample")
def q_quota_sample(spark, sf):
    return SM.quota_sample(_events(spark, sf), "event_type", QUOTAS, "event_id", seed=42)


@query("cap_per_class")
def q_cap_per_class(spark, sf):
    li = TB.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return SM.cap_per_class(li, "l_returnflag", 15000, "line_key", seed=42).select(
        "l_orderkey", "l_linenumber", "l_returnflag")


@query("stratified_split")
def q_stratified_split(spark, sf):
    return SM.stratified_split(_events(spark, sf), "event_type", "event_id", 0.8, seed=42)


@query("three_way_split")
def q_three_way_split(spark, sf):
    return SM.three_way_split(_events(spark, sf), "event_id", (0.6, 0.2, 0.2), seed=42).select(
        "event_id", "split")


@query("stratified_folds")
def q_stratified_folds(spark, sf):
    return SM.stratified_folds(_events(spark, sf), "event_type", "event_id", 5, seed=42)


@query("weighted_draws")
def q_weighted_draws(spark, sf):
    """An order for every event, drawn by its price (a tenth of the orders has no weight)."""
    orders = TB.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice").cast("double")).alias("price"))
    return SM.weighted_draws(orders, "price", "o_orderkey", TB.table(spark, sf, "events").select("event_id"), "event_id")


@query("weighted_resample")
def q_weighted_resample(spark, sf):
    ev = _events(spark, sf)
    draws = ev.select(F.col("event_id").alias("draw_id"))
    return SM.balanced_resample(ev, "event_type", "event_id", draws, "draw_id", seed=42)


# --- linear model over embeddings and evaluation metrics --------------------

def _embedding_split(spark, sf):
    """Nearest-centroid linear model fitted on the 80% stratified train split:
    (test rows, model rows)."""
    emb = TB.table(spark, sf, "embeddings")
    rows = SM.stratified_split(emb, "label", "vec_id", 0.8, seed=42)
    model = SC.centroid_rows(SC.fit_centroids(rows.filter(F.col("split") == "train"), "embedding", "label"))
    return rows.filter(F.col("split") == "test"), model


def _embedding_model(spark, sf):
    """Test rows with scores, the classes of the scores, probabilities and prediction."""
    test, rows = _embedding_split(spark, sf)
    model = SC.model_column(rows)
    held = test.select("vec_id", "label", "embedding").withColumn("model", model)
    scored = T.with_computed(held, scores=SC.linear_scores("embedding", "model"), classes=SC.model_labels("model"))
    probs, pred_idx, prob = SC.predict("scores")
    return scored.select("vec_id", "label", "scores", "classes", probs.alias("probs"),
                         F.element_at("classes", pred_idx + 1).alias("pred"), prob.alias("prob"))


@query("linear_scores")
def q_linear_scores(spark, sf):
    m = _embedding_model(spark, sf)
    return m.select("vec_id", "label", "pred", r6("prob").alias("prob"),
                    V.round_elements("probs", 2).alias("probs_2dp"))


@query("top_k_classes")
def q_top_k_classes(spark, sf):
    m = _embedding_model(spark, sf)
    best = F.transform(V.top_k_classes("scores", 3), lambda i: F.element_at("classes", i + 1))
    return m.select("vec_id", "label", best.alias("top_3"))


@query("accuracy")
def q_accuracy(spark, sf):
    return MT.accuracy(_embedding_model(spark, sf), "label", "pred")


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return MT.confusion_matrix(_embedding_model(spark, sf), "label", "pred")


@query("classification_report")
def q_classification_report(spark, sf):
    return MT.classification_report(_embedding_model(spark, sf), "label", "pred")


@query("weighted_f1")
def q_weighted_f1(spark, sf):
    return MT.weighted_f1(_embedding_model(spark, sf), "label", "pred")


@query("top_k_accuracy")
def q_top_k_accuracy(spark, sf):
    return MT.top_k_accuracy(_embedding_model(spark, sf), "label", "scores", F.col("classes"), 3)


@query("cross_entropy")
def q_cross_entropy(spark, sf):
    m = _embedding_model(spark, sf)
    w = LB.class_weights(m, "label")
    return MT.cross_entropy(m, "label", "scores", F.col("classes"), w, "label", "balanced_weight")


# --- sentences, text assembly, names ----------------------------------------

@query("sentences")
def q_sentences(spark, sf):
    c = TB.complaints(spark, sf, with_response=False)
    return c.select("complaint_id", F.posexplode(T.sentences("narrative")).alias("sentence_pos", "sentence")) \
        .withColumn("sentence_pos", F.col("sentence_pos").cast("bigint"))


@query("abbreviations")
def q_abbreviations(spark, sf):
    c = TB.complaints(spark, sf, with_response=False).select("narrative")
    return BO.abbreviations(c, "narrative")


@query("learned_sentences")
def q_learned_sentences(spark, sf):
    """Sentences whose borders know the corpus's abbreviations."""
    c = TB.complaints(spark, sf, with_response=False).select("complaint_id", "narrative")
    table = BO.abbreviation_table(BO.abbreviations(c, "narrative"))
    return BO.with_sentences(c, "narrative", table).drop("narrative")


@query("dedupe_sentences")
def q_dedupe_sentences(spark, sf):
    c = TB.complaints(spark, sf, with_response=False)
    return c.select("complaint_id", T.dedupe_sentences("narrative").alias("deduped"))


@query("chunk_sentences")
def q_chunk_sentences(spark, sf):
    c = TB.complaints(spark, sf, with_response=False)
    return SU.chunk_sentences(c, "complaint_id", "narrative", SU.CHUNK_WORDS).withColumn(
        "chunk_index", F.col("chunk_index").cast("bigint"))


NO_SUMMARY = "(none)"   # stands for a text without a summary


@query("build_text")
def q_build_text(spark, sf):
    c = TB.complaints(spark, sf)
    return c.select(
        "complaint_id",
        T.build_text(["response", "product", "issue", "company"], "empty").alias("text_empty"),
        T.build_text(["narrative", "product", "issue", "response"], "blank").alias("text_blank"),
        T.build_text(["narrative", "company", "product", "response"], "skip", sep=" | ",
                     labels=["Complaint Narrative", "Company", "Product", "Response"]).alias("text_skip"),
        F.coalesce("response", F.lit(NO_SUMMARY)).alias("summary_or_default"))


@query("label_names")
def q_label_names(spark, sf):
    docs = TB.written_clean(spark, sf)
    scored = S.lexicon_sentiment(docs, "complaint_id", "clean", TB.test_lexicon(spark, sf, docs))
    return scored.select("complaint_id", "sentiment", S.sentiment_names("sentiment").alias("sentiment_name"))


# --- vocabulary and token encoding ------------------------------------------

VOCAB_SIZE = 30000
MAX_LEN = 128


@query("vocabulary")
def q_vocabulary(spark, sf):
    return TK.build_vocabulary(TB.cleaned_complaints(spark, sf, with_response=False), "clean", VOCAB_SIZE)


@query("encode_tokens")
def q_encode_tokens(spark, sf):
    docs = TB.cleaned_complaints(spark, sf, with_response=False)
    vocab = TK.build_vocabulary(docs, "clean", VOCAB_SIZE)
    return TK.encode_tokens(docs, "complaint_id", "clean", vocab, MAX_LEN)


# --- summaries and ROUGE ----------------------------------------------------

@query("summary_budget")
def q_summary_budget(spark, sf):
    c = TB.complaints(spark, sf, with_response=False).select(
        "complaint_id", T.word_count("narrative").alias("n_words"))
    lo, hi = SU.summary_budget("n_words")
    return c.select("complaint_id", "n_words", lo.alias("min_words"), hi.alias("max_words"))


def _summaries(spark, sf):
    c = TB.complaints(spark, sf, with_response=False).select("complaint_id", "narrative")
    return SU.extractive_summary(c, "complaint_id", "narrative").join(c, "complaint_id")


@query("extractive_summary")
def q_extractive_summary(spark, sf):
    c = TB.complaints(spark, sf, with_response=False).select("complaint_id", "narrative")
    return SU.extractive_summary(c, "complaint_id", "narrative")


@query("chunked_summary")
def q_chunked_summary(spark, sf):
    c = TB.complaints(spark, sf, with_response=False).select("complaint_id", "narrative")
    return SU.chunked_summary(c, "complaint_id", "narrative")


@query("rouge_n")
def q_rouge_n(spark, sf):
    return SI.rouge_n(_summaries(spark, sf), "complaint_id", "summary", "narrative", (1, 2))


@query("rouge_l")
def q_rouge_l(spark, sf):
    r = SI.rouge_l_pairs(_summaries(spark, sf), "complaint_id", "summary", "narrative")
    return r.select("complaint_id", r6("p").alias("rouge_l_p"), r6("r").alias("rouge_l_r"),
                    r6("f").alias("rouge_l_f"))


@query("rouge_stemmed")
def q_rouge_stemmed(spark, sf):
    """Mean ROUGE-1, -2 and -L of all summaries over stemmed words."""
    from narrata.sources import io as IO
    # stemmed words are whole tokens already: both measures read them as they are
    pairs = IO.materialize(SI.pair_tokens(_summaries(spark, sf), "complaint_id", "summary", "narrative", stem=True), spark, "rouge-pairs")
    n = SI.rouge_n(pairs, "complaint_id", "summary", "narrative", (1, 2))
    longest = SI.rouge_l_pairs(pairs, "complaint_id", "summary", "narrative").agg(
        *(r6(F.avg(c)).alias(f"rougeL_{c}") for c in ("p", "r", "f")))
    return n.crossJoin(longest)  # one row and one row


@query("embedding_match")
def q_embedding_match(spark, sf):
    test, model = _embedding_split(spark, sf)
    return SI.embedding_match(test.withColumn("model", SC.model_column(model)), "embedding", "model")


@query("word_vectors")
def q_word_vectors(spark, sf):
    c = TB.cleaned_complaints(spark, sf, with_response=False).select("clean")
    return WV.word_vectors(c, "clean")


@query("pair_similarity")
def q_pair_similarity(spark, sf):
    """Precision, recall and F of every summary against its narrative, by vectors learned from the narratives."""
    from narrata.sources import io as IO
    pairs = IO.materialize(_summaries(spark, sf).select(
        "complaint_id", T.clean_narrative("summary").alias("summary"), T.clean_narrative("narrative").alias("narrative")),
        spark, "similarity-pairs")
    docs = pairs.filter("narrative <> ''")
    vectors = IO.materialize(WV.word_vectors(docs, "narrative"), spark, "word-vectors")
    return WV.pair_similarity(pairs, "summary", "narrative", vectors, docs.count(), ["complaint_id"]).select(
        "complaint_id", r6("p").alias("p"), r6("r").alias("r"), r6("f").alias("f"))


# --- classifiers (MLlib) ----------------------------------------------------

def _response_data(spark, sf):
    """Labelled complaints with the training text layout (narrative, product,
    issue, company; NULL parts blank) cleaned, and an 80/20 stratified split."""
    c = _labelled(spark, sf).select(
        "complaint_id", "response",
        T.clean_narrative(T.build_text(["narrative", "product", "issue", "company"], "blank")).alias("text"))
    return SM.stratified_split(c, "response", "complaint_id", 0.8, seed=42)


@query("train_classifier")
def q_train_classifier(spark, sf):
    data = _response_data(spark, sf)
    model = CL.fit_classifier(data.filter(F.col("split") == "train"), "text", "response")
    pred = CL.predict(model, data.filter(F.col("split") == "test"), ["complaint_id", "response"])
    return pred.select("complaint_id", "response", F.col("predicted_label").alias("predicted_response"),
                       r6(F.array_max("probabilities")).alias("probability"))


@query("model_family_compare")
def q_model_family_compare(spark, sf):
    """Metrics of every family on the test split; the best one on a validation split is saved to the shared folder."""
    from narrata.sources import io as IO
    data = IO.materialize(_response_data(spark, sf), spark, "splits/families")
    train = SM.stratified_split(data.filter(F.col("split") == "train").drop("split"), "response", "complaint_id", 0.75, seed=43)
    rows, best = CL.compare_families(train.filter(F.col("split") == "train"), data.filter(F.col("split") == "test"), "text",
                                     "response", validation=train.filter(F.col("split") == "test"))
    CL.save(best, IO.scratch_path(spark, f"models/best-{uuid.uuid4().hex}"))
    return rows


@query("cross_validate")
def q_cross_validate(spark, sf):
    folds = _sentiment_folds(spark, sf)
    pooled = CL.cross_validate(folds, "fold", "clean", "sentiment", 5, keep=["complaint_id", "sentiment"])
    return MT.classification_report(pooled, "sentiment", "predicted_label")


@query("classifier_reload")
def q_classifier_reload(spark, sf):
    from pyspark.ml import PipelineModel

    from narrata.sources import io as IO
    data = _response_data(spark, sf)
    model = CL.fit_classifier(data.filter(F.col("split") == "train"), "text", "response")
    path = IO.scratch_path(spark, f"models/response-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    pred = CL.predict(loaded, data.filter(F.col("split") == "test"), ["complaint_id", "response"])
    return pred.select("complaint_id", "response", F.col("predicted_label").alias("predicted_response"))


# --- caller models in Arrow batches, side-by-side comparison ----------------

@query("batch_model_scores")
def q_batch_model_scores(spark, sf):
    test, model = _embedding_split(spark, sf)
    labels, matrix = SC.local_model(model)
    test = test.withColumn("vec", F.col("embedding").cast("array<double>"))
    scores = SC.score_batches(test, "vec", SC.numpy_linear_predictor(matrix),
                              ArrayType(DoubleType()), batch_size=32, input_tensor_shapes=[[len(matrix[0])]])
    label_of = F.array(*[F.lit(x) for x in labels])
    return test.select("vec_id", "label", scores.alias("scores")).select(
        "vec_id", "label", F.element_at(label_of, V.argmax("scores") + 1).alias("pred"))


@query("model_compare")
def q_model_compare(spark, sf):
    c = TB.complaints(spark, sf)
    summ = SU.extractive_summary(c.select("complaint_id", "narrative"), "complaint_id", "narrative")
    c = c.join(summ, "complaint_id")
    lex, neg, bst, cw = TB.test_word_roles(spark, sf)
    inputs = {
        "combined": T.build_text(["narrative", "company", "product", "issue"], "skip", sep=" | ",
                                 labels=["Complaint Narrative", "Company", "Product", "Issue"]),
        "summary": F.when(F.col("summary") != "", F.col("summary")).otherwise(F.lit(NO_SUMMARY)),
    }

    words = {}  # of the inputs that both scorers read

    def of(d):
        return words.setdefault("words", S.TextWords(d, "complaint_id", "text", ["input"]))

    def plain(d):
        return S.lexicon_sentiment(d, "complaint_id", "text", lex, keep=["input"], words=of(d))

    def context(d):
        return S.lexicon_sentiment_context(d, "complaint_id", "text", lex, neg, bst, cw, keep=["input"], words=of(d))

    out = SC.compare_models(c, "complaint_id", inputs, {"lexicon": plain, "lexicon_context": context}, T.clean_narrative)
    return out.select("complaint_id", "input", "model", "sentiment",
                      S.sentiment_names("sentiment").alias("sentiment_name"))


# --- text classifiers whose scores SQL can give: naive Bayes over exact words --

def _split(spark, sf, label):
    """Cleaned complaints with a label, split 80/20 within each class, written once."""
    from narrata.sources import io as IO
    c = FL.dropna_subset(TB.cleaned_complaints(spark, sf), [label])
    split = SM.stratified_split(c.select("complaint_id", label, "clean"), label, "complaint_id", 0.8, seed=42)
    return IO.materialize(split, spark, f"splits/{label}")


@query("batch_text_scores")
def q_batch_text_scores(spark, sf):
    model = WB.fit(_split(spark, sf, "response").filter(F.col("split") == "train"), "clean", "response")
    docs = TB.cleaned_complaints(spark, sf, with_response=False).select("complaint_id", "clean")
    return WB.score(docs, "clean", model, ["complaint_id"]).select(
        "complaint_id", F.col("predicted").alias("predicted_response"), "probability")


@query("trained_model_compare")
def q_trained_model_compare(spark, sf):
    """Two trained classifiers (words, pairs of words) over the combined text and the summary."""
    train = _split(spark, sf, "response").filter(F.col("split") == "train")
    models = {"words": WB.fit(train, "clean", "response"), "pairs": WB.fit(train, "clean", "response", pairs=True)}
    c = TB.complaints(spark, sf, with_response=False)
    c = c.join(SU.extractive_summary(c.select("complaint_id", "narrative"), "complaint_id", "narrative"), "complaint_id")
    combined = T.build_text(["narrative", "company", "product", "issue"], "skip", sep=" | ",
                            labels=["Complaint Narrative", "Company", "Product", "Issue"])

    rows = {}  # the inputs' words, which both models read

    def scorer(model):
        def score(d):
            if not rows:
                rows["rows"] = WB.numbered(d, "text", ["complaint_id", "input"])
            return WB.score(d, "text", model, ["complaint_id", "input"], rows["rows"])
        return score

    out = SC.compare_models(c, "complaint_id", {"combined": combined, "summary": F.col("summary")},
                            {name: scorer(model) for name, model in models.items()}, T.clean_narrative)
    return out.select("complaint_id", "input", "model", F.col("predicted").alias("predicted_response"), "probability")


def _early_stopping(spark, sf):
    """Softmax regression of the response, fitted on the training part and stopped by the validation part."""
    from narrata.sources import io as IO
    c = FL.dropna_subset(TB.cleaned_complaints(spark, sf), ["response"]).select("complaint_id", "response", "clean")
    c = IO.materialize(SM.three_way_split(c, "complaint_id"), spark, "splits/early-stopping")
    parts = {x: c.filter(F.col("split") == x) for x in ("train", "validation", "test")}
    return SX.fit_early_stopping(parts["train"], parts["validation"], "clean", "response", epochs=6), parts["test"]


@query("early_stopping")
def q_early_stopping(spark, sf):
    """Losses by epoch, and the epoch that is kept."""
    fit, _ = _early_stopping(spark, sf)
    return fit.history.select("epoch", r6("train_loss").alias("train_loss"),
                              r6("validation_loss").alias("validation_loss"), "best")


@query("early_stopping_report")
def q_early_stopping_report(spark, sf):
    """Report of the kept epoch's weights on the test part, which took no part in fitting or stopping."""
    fit, test = _early_stopping(spark, sf)
    return MT.classification_report(SX.predict(fit, test, "clean", ["response"]), "response", "predicted")


def _sentiment_folds(spark, sf):
    """Cleaned complaints with their lexicon sentiment, in five stratified folds."""
    docs = TB.written_clean(spark, sf)
    scored = S.lexicon_sentiment(docs, "complaint_id", "clean", TB.test_lexicon(spark, sf, docs))
    labelled = scored.select("complaint_id", S.sentiment_names("sentiment").alias("sentiment")) \
        .join(docs.select("complaint_id", "clean"), "complaint_id")
    return SM.stratified_folds(labelled, "sentiment", "complaint_id", 5, seed=42)


@query("cross_validate_words")
def q_cross_validate_words(spark, sf):
    """Out-of-fold predictions of every complaint, all folds from one count of the words."""
    pooled = WB.cross_validate(_sentiment_folds(spark, sf), "fold", "clean", "sentiment", ["complaint_id", "fold", "sentiment"])
    return pooled.select("complaint_id", "fold", "sentiment", F.col("predicted").alias("predicted_sentiment"), "probability")


def _issue_predictions(spark, sf):
    from narrata.sources import io as IO
    rows = _split(spark, sf, "issue")
    model = WB.fit(rows.filter(F.col("split") == "train"), "clean", "issue")
    scored = WB.score(rows.filter(F.col("split") == "test"), "clean", model, ["complaint_id", "issue"])
    return IO.materialize(scored, spark, "issue-predictions"), F.array(*[F.lit(x) for x in model.labels])


@query("issue_classifier")
def q_issue_classifier(spark, sf):
    """Report of the issue classifier on its test split, with top-3 accuracy as a row of its own."""
    scored, labels = _issue_predictions(spark, sf)
    report = MT.classification_report(scored, "issue", "predicted")
    top = MT.top_k_accuracy(scored, "issue", "scores", labels, 3)
    none = F.lit(None).cast("double")
    return report.unionByName(top.select(
        F.lit("top 3 accuracy").alias("class"), none.alias("precision"), none.alias("recall"),
        F.col("top_3_accuracy").alias("f1"), F.col("n").alias("support")))


@query("issue_confusion")
def q_issue_confusion(spark, sf):
    scored, _ = _issue_predictions(spark, sf)
    return MT.confusion_matrix(scored, "issue", "predicted")


# --- sources and sinks ------------------------------------------------------

@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    from narrata.sources import io as IO
    path = IO.scratch_path(spark, f"stages/complaints-{uuid.uuid4().hex}.csv")
    IO.write_stage(TB.complaints(spark, sf), path, "csv")
    return IO.read_complaints(spark, path)


@query("csv_splits")
def q_csv_splits(spark, sf):
    """The same stage, its files read in splits."""
    from narrata.sources import csv_splits as CS
    from narrata.sources import io as IO
    path = IO.scratch_path(spark, f"stages/complaints-{uuid.uuid4().hex}.csv")
    IO.write_stage(TB.complaints(spark, sf), path, "csv")
    return CS.read_csv_splits(spark, path, IO.COMPLAINT_SCHEMA)


# --- streaming --------------------------------------------------------------

@query("stream_score")
def q_stream_score(spark, sf):
    """Documents arriving as files are scored by the streaming scorer until
    the available input is drained; the sink is read back as a table."""
    from narrata.sources import io as IO
    from narrata.streaming import score as ST
    run = uuid.uuid4().hex
    sink = IO.scratch_path(spark, f"streams/score-{run}/out")
    ckpt = IO.scratch_path(spark, f"streams/score-{run}/checkpoint")
    # the lexicon is written once to the shared folder and read again for every micro-batch
    lexicon = IO.scratch_path(spark, f"streams/score-{run}/lexicon")
    IO.write_stage(TB.test_lexicon(spark, sf), lexicon)
    q = ST.score_stream(spark, TB.stream_path(sf, "documents"), lexicon, sink, ckpt, glob="*")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink).select("complaint_id", "product", "sentiment", "sentiment_name")


@query("stream_classify")
def q_stream_classify(spark, sf):
    """Documents arriving as files are classified by a saved model until the input is drained."""
    from narrata.sources import io as IO
    from narrata.streaming import score as ST
    train = _split(spark, sf, "response").filter(F.col("split") == "train")
    run = f"streams/classify-{uuid.uuid4().hex}"
    WB.save(WB.fit(train, "clean", "response"), IO.scratch_path(spark, f"{run}/model"))
    sink = IO.scratch_path(spark, f"{run}/out")
    q = ST.classify_stream(spark, TB.stream_path(sf, "documents"), IO.scratch_path(spark, f"{run}/model"), sink,
                           IO.scratch_path(spark, f"{run}/checkpoint"), glob="*")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink).select("complaint_id", "predicted_response", "probability")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)
