"""Corpus vocabulary and fixed-length token encoding (T19).

A re-aim of pretrained tokenizers as a Spark job: the vocabulary is the
``vocab_size`` most frequent tokens of the corpus (ties by token), and every
text is encoded whole: its tokens are cut into consecutive windows of
``max_len - 2`` ids, one output row per window (window 0 is what a truncating
tokenizer returns; the others are its overflow windows).

A vocabulary of up to ``MAX_VOCABULARY_BYTES`` is a value of the plan: ids are
looked up and windows are cut within the row. A larger one is joined to the
exploded tokens by (token, salt), and windows are gathered by row number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions.lookup import MAX_BYTES, row_table
from narrata.operators import word_bayes as WB
from narrata.sources import io as IO

#: Bytes of a vocabulary that travels with the plan.
MAX_VOCABULARY_BYTES = MAX_BYTES

# ---------------------------------------------------------------------------
# Special token ids of the BERT-style vocabulary.
PAD_ID = 0
UNK_ID = 100
CLS_ID = 101
SEP_ID = 102
FIRST_WORD_ID = 1000     # corpus tokens are numbered from here in rank order
# ---------------------------------------------------------------------------


def build_vocabulary(df: DataFrame, text_col: str, vocab_size: int) -> DataFrame:
    """``(token, count, token_id)`` for the ``vocab_size`` most frequent tokens.

    Counting is a partial aggregate per token; the top-k is a
    TakeOrderedAndProject (k rows per partition), and only those k rows are
    numbered.
    """
    counts = (df.select(F.explode(T.words(text_col)).alias("token"))
              .groupBy("token").agg(F.count("*").alias("count")))
    top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(vocab_size)
    w = Window.orderBy(F.col("count").desc(), F.col("token"))
    return top.withColumn("token_id", (F.row_number().over(w) - 1 + FIRST_WORD_ID).cast("int"))


def encode_tokens(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame,
                  max_len: int = 128) -> DataFrame:
    """``(id, window_index, input_ids, attention_mask)``: [CLS] ids [SEP] padded to ``max_len``.

    ``vocab`` holds distinct tokens; a token that it doesn't have maps to
    [UNK]. A null text, or one without tokens, keeps one window of [CLS]
    [SEP] and padding. Every row is encoded by itself, also rows that share
    an id.
    """
    if max_len < 3:
        raise ValueError("a window holds [CLS], [SEP] and one id at least")
    body = max_len - 2
    vocab = IO.materialize(vocab.select("token", "token_id").filter("token IS NOT NULL"), df.sparkSession, "vocabulary")
    table = row_table(vocab, ["token_id"], MAX_VOCABULARY_BYTES)
    empty = F.array().cast("array<int>")
    if table is not None:
        ids = F.transform("words", lambda w: F.coalesce(table.of(w)["token_id"], F.lit(UNK_ID)))
        # the id under a name of its own; the text is read before names can clash
        rows = T.with_computed(df.select(F.col(id_col).alias("id"), T.words(text_col).alias("words")),
                               ids=F.coalesce(ids, empty))
        last = F.floor((F.greatest(F.size("ids"), F.lit(1)) - 1) / F.lit(body)).cast("int")
        windows = rows.select("id", F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(
            "ids", i * body + 1, F.lit(body)))).alias("window_index", "seq"))
    else:
        rows = df.select(F.struct(F.col(id_col).alias("id")).alias("keep"), T.words(text_col).alias("words"),
                         F.monotonically_increasing_id().alias("row"))
        hot = WB.hot_tokens(rows.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("n")))
        ex = WB.with_salt(rows.select("keep", "row", F.posexplode_outer("words").alias("pos", "token")), hot, "row")
        met = ex.join(WB.salted(vocab, hot), ["token", "salt"], "left")
        # a row and window hold at most max_len - 2 tokens, so no list is unbounded
        item = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("token_id", F.lit(UNK_ID)).alias("id")))
        windows = met.groupBy("row", "keep", F.coalesce((F.col("pos") / body).cast("int"), F.lit(0)).alias("window_index")).agg(
            F.array_sort(F.collect_list(item)).alias("items"))
        windows = windows.select("keep.id", "window_index", F.transform("items", lambda x: x["id"]).alias("seq"))
    n = F.size("seq")
    input_ids = F.concat(F.array(F.lit(CLS_ID)), "seq", F.array(F.lit(SEP_ID)),
                         F.array_repeat(F.lit(PAD_ID), F.lit(max_len) - n - 2))
    mask = F.concat(F.array_repeat(F.lit(1), n + 2), F.array_repeat(F.lit(0), F.lit(max_len) - n - 2))
    return windows.select(F.col("id").alias(id_col), "window_index", input_ids.alias("input_ids"), mask.alias("attention_mask"))
