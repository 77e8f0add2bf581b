"""Naive Bayes over exact words: the model is a table joined to exploded tokens (M4, M6, M7, M9, S3, S4).

Tokens are the words of a cleaned text, or its pairs of neighbouring words;
each has a row of its own, so no two words share a feature and nothing bounds
their number. A model is two written tables: one row per class, and one row
per token with its weight for every class (in label order). Weights are whole
numbers of 1e-9, so scores don't depend on the order of summation.

Counts are subtractable: cross-validation counts (fold, class, token) once,
and a fold's model is the total minus the fold (:func:`cross_validate`).

Tokens that are common in training meet their weights by broadcast, the rest
by an exchange of (token, row number) (``common_words``). Its keys are
(token, salt). Only tokens that make up at least one part in
``HOT_PARTS`` of the training tokens are salted; there can be no more than
``HOT_PARTS`` of them, so the list that travels with the plan is bounded.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions import vectors as V
from narrata.functions.numeric import round6
from narrata.operators import common_words as CW
from narrata.operators import scoring as SC
from narrata.sources import io as IO

UNIT = 1e9
#: A token with one part in so many of all tokens is hot; its rows are spread over ``SALTS`` keys.
HOT_PARTS, SALTS = 1000, 16


@dataclass
class Model:
    """Written tables: ``classes`` (label, prior, unseen) and ``weights`` (token, n, more)."""

    classes: DataFrame
    weights: DataFrame
    pairs: bool = False

    @property
    def labels(self) -> list:
        return [r.label for r in self.class_rows]

    @property
    def class_rows(self) -> list:
        """One row per class, in label order."""
        return self.classes.orderBy("label").collect()


def tokens(text_col, pairs: bool = False, cut: bool = False) -> Column:
    """The words of a cleaned text (of a list of words with ``cut``), or its pairs of neighbouring words."""
    w = (F.col(text_col) if isinstance(text_col, str) else text_col) if cut else T.words(text_col)
    if not pairs:
        return w
    two = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(two, lambda x: x.isNotNull())


def hot_tokens(counts: DataFrame) -> list[str]:
    """Tokens (rows of token and n) with one part in ``HOT_PARTS`` of all n: at most ``HOT_PARTS`` of them."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r.token for r in counts.filter(F.col("n") * HOT_PARTS >= total).select("token").collect()] if total else []


def with_salt(rows: DataFrame, hot: list[str], row_col: str) -> DataFrame:
    """Token rows with the salt of their key."""
    return rows.withColumn("salt", F.when(F.col("token").isin(hot), F.pmod(row_col, F.lit(SALTS))).otherwise(0).cast("int"))


def salted(table: DataFrame, hot: list[str]) -> DataFrame:
    """A token table with a row for every salt of its hot tokens."""
    return table.withColumn("salt", F.explode(
        F.when(F.col("token").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))


def _units(x: Column) -> Column:
    return F.round(x * F.lit(UNIT)).cast("long")


def _by_class(labels: list, value: str = "n") -> Column:
    """Sums of ``value`` for every class, as one array."""
    return F.array(*[F.sum(F.when(F.col("label") == F.lit(x), F.col(value)).otherwise(0)) for x in labels])


def _labels(rows: DataFrame) -> list:
    return [r.label for r in rows.select("label").distinct().orderBy("label").collect()]


def fit(train: DataFrame, text_col: str, label_col: str, pairs: bool = False, name: str = "word-bayes") -> Model:
    """Fit on rows with a label and write the model to the shared folder.

    Smoothed by one occurrence of every training token in every class. Rows
    without a label are left out; a null text has no tokens; repeated rows
    count each.
    """
    spark, run = train.sparkSession, f"models/{name}-{uuid.uuid4().hex}"
    rows = train.filter(F.col(label_col).isNotNull()).select(
        F.col(label_col).alias("label"), tokens(text_col, pairs).alias("tokens"))
    sizes = IO.materialize(rows.groupBy("label").agg(
        F.count("*").alias("size"), F.coalesce(F.sum(F.greatest(F.size("tokens"), F.lit(0))), F.lit(0)).alias("n")),
        spark, f"{run}/sizes")
    labels = _labels(sizes)
    # a token's counts of all classes are one row from the tasks' own counts on, so tokens are exchanged once
    each = T.exploded(rows, F.col("tokens"), "label").withColumn("n", F.lit(1).cast("long"))
    seen = [F.sum(F.when(F.col("label") == F.lit(x), F.col("n")).otherwise(0)).alias(f"seen{j}") for j, x in enumerate(labels)]
    counted = each.groupBy("token").agg(F.sum("n").alias("n"), *seen)
    kept = F.array(*[F.col(f"seen{j}") for j in range(len(labels))]) if labels else F.array().cast("array<bigint>")
    counts = IO.materialize(counted.select("token", "n", kept.alias("seen")), spark, f"{run}/counts")
    n_rows, n_tokens = sizes.agg(F.sum("size")).scalar(), counts.agg(F.count("*")).scalar()
    total = F.greatest(F.col("n") + n_tokens, F.lit(1))  # without any token the priors decide
    classes = IO.materialize(sizes.select(
        "label", _units(F.log(F.col("size") / n_rows)).alias("prior"), total.alias("total"),
        _units(F.log(F.lit(1) / total)).alias("unseen")), spark, f"{run}/classes")
    parts = classes.orderBy("label").collect()
    more = F.array(*[_units(F.log((F.col("seen")[j] + 1) / F.lit(p.total))) - p.unseen for j, p in enumerate(parts)])
    more = more if parts else F.array().cast("array<bigint>")
    weights = IO.materialize(counts.select("token", "n", more.alias("more")), spark, f"{run}/weights")
    return Model(classes.select("label", "prior", "unseen"), weights, pairs)


def save(model: Model, path: str) -> None:
    """Write a model under ``path``; :func:`load` reads it in a batch job or a stream."""
    model.classes.write.mode("overwrite").parquet(f"{path}/classes")
    model.weights.withColumn("pairs", F.lit(model.pairs)).write.mode("overwrite").parquet(f"{path}/weights")


def load(spark: SparkSession, path: str) -> Model:
    weights = spark.read.parquet(f"{path}/weights")
    first = weights.select("pairs").first()
    return Model(spark.read.parquet(f"{path}/classes"), weights.drop("pairs"), bool(first and first.pairs))


def _named(sums: DataFrame, labels: list) -> DataFrame:
    """Rows (kept columns, scores of ``labels``) with the best label and its probability."""
    out = T.with_computed(sums, scores=F.transform("units", lambda x: x / F.lit(UNIT)))
    names = F.array(*[F.lit(x) for x in labels])
    _, best, probability = SC.predict("scores")
    return out.select("keep.*", "scores", F.element_at(names, best + 1).alias("predicted"),
                      round6(probability).alias("probability"))


def numbered(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """(keep, row, words) of every row of ``df``, written: its number, and its words as one string with spaces."""
    words = F.coalesce(T.spaced(text_col), F.lit(""))
    return IO.materialize(df.select(F.struct(*keep).alias("keep"), F.monotonically_increasing_id().alias("row"), words.alias("words")),
                          df.sparkSession, f"scores-{uuid.uuid4().hex}/rows")


def score(df: DataFrame, text_col: str, model: Model, keep=(), rows: DataFrame | None = None) -> DataFrame:
    """``keep`` columns, ``scores`` (of ``model.labels``, in order), ``predicted`` and its ``probability``.

    One row for every row of ``df``, also for rows that share all kept values,
    and for texts without tokens (the priors decide). The rows are written
    once with their words and a number; only numbers go with the tokens.
    ``rows``: those of :func:`numbered`, where another model scores them too.
    """
    parts, hot = model.class_rows, hot_tokens(model.weights)
    if not parts:
        raise ValueError("the model has no class")
    rows, run = numbered(df, text_col, keep) if rows is None else rows, f"scores-{uuid.uuid4().hex}"
    cut = tokens(T.spaced_words("words"), model.pairs, cut=True)
    table = model.weights.select("token", "more")
    often = CW.common(model.weights, f"{run}/common").select("token", "more")
    met = CW.all_met(T.exploded(rows, cut, "row"), often, table, hot)
    sums = met.groupBy("row").agg(*[F.sum(F.col("more")[j]).alias(f"more{j}") for j in range(len(parts))])
    n = F.greatest(T.spaced_count("words") - F.lit(int(model.pairs)), F.lit(0)).cast("long")
    units = F.array(*[p.prior + F.col("n") * p.unseen + F.coalesce(f"more{j}", F.lit(0)) for j, p in enumerate(parts)])
    return _named(rows.select("row", "keep", n.alias("n")).join(sums, "row", "left").select("keep", units.alias("units")),
                  [p.label for p in parts])


def top_labels(labels: list, k: int) -> Column:
    """The k best labels of ``scores``, best first (ties: the later label)."""
    names = F.array(*[F.lit(x) for x in labels])
    return F.transform(V.top_k_classes("scores", k), lambda i: F.element_at(names, i + 1))


def cross_validate(df: DataFrame, fold_col: str, text_col: str, label_col: str, keep, pairs: bool = False) -> DataFrame:
    """Out-of-fold predictions of every labelled row: ``keep`` columns (one at least), ``scores``, ``predicted``, ``probability``.

    Equal to fitting on all other folds and scoring the fold, for each fold,
    but (fold, class, token) is counted once: a fold's counts are the totals
    minus its own, and the vocabulary of its training part is the whole one
    without the tokens that occur in the fold alone. Texts are cut into tokens
    once and written; the model table has a row for each token of each fold.
    Rows without fold or label are left out. A class that occurs in one fold
    only can't be predicted there.
    """
    spark, run = df.sparkSession, f"cross-{uuid.uuid4().hex}"
    rows = df.filter(F.col(fold_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.struct(*keep).alias("keep"), F.col(fold_col).alias("fold"), F.col(label_col).alias("label"),
        tokens(text_col, pairs).alias("tokens"), F.monotonically_increasing_id().alias("row"))
    rows = IO.materialize(rows, spark, f"{run}/rows")
    labels = _labels(rows)
    many = len(labels)
    if not many:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("scores", "array<double>"), ("predicted", dict(rows.dtypes)["label"]),
                                                          ("probability", "double"))]
        return rows.select("keep.*", *none)
    # one count of the texts: (fold, class, token), then an array over the classes for each (fold, token)
    counts = rows.select("fold", "label", F.explode("tokens").alias("token")).groupBy("fold", "label", "token").agg(
        F.count("*").alias("n"))
    own = IO.materialize(counts.groupBy("fold", "token").agg(_by_class(labels).alias("own")), spark, f"{run}/own")
    totals = IO.materialize(own.groupBy("token").agg(
        F.array(*[F.sum(F.col("own")[j]) for j in range(many)]).alias("all")), spark, f"{run}/totals")
    both = IO.materialize(own.join(totals, "token").withColumn(
        "left", F.zip_with("all", "own", lambda a, b: a - b)), spark, f"{run}/left")

    def summed(c) -> Column:
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    per_fold = both.groupBy("fold").agg(
        F.count(F.when(summed("left") == 0, 1)).alias("alone"),
        F.array(*[F.sum(F.col("own")[j]) for j in range(many)]).alias("own_n"))
    all_n = totals.agg(F.count("*").alias("vocabulary"), F.array(*[F.sum(F.col("all")[j]) for j in range(many)]).alias("n"))
    sizes = rows.groupBy("fold").agg(F.array(*[F.count(F.when(F.col("label") == F.lit(x), 1)) for x in labels]).alias("size"))
    none = [0] * many
    whole = all_n.first()
    fold_rows = sizes.join(per_fold, "fold", "left").orderBy("fold").collect()  # a row for each fold
    all_rows = [sum(r["size"][j] for r in fold_rows) for j in range(many)]
    params = []
    for r in fold_rows:
        left_rows = [a - b for a, b in zip(all_rows, r["size"], strict=True)]
        n = [(a or 0) - b for a, b in zip(whole.n or none, r.own_n or none, strict=True)]
        vocabulary = whole.vocabulary - (r.alone or 0)
        params.append((r.fold, [max(x + vocabulary, 1) for x in n], left_rows, sum(left_rows)))
    fold_type = dict(rows.dtypes)["fold"]
    table = spark.createDataFrame(params, f"fold {fold_type}, total array<bigint>, size array<bigint>, n bigint")
    table = IO.materialize(table.select(
        "fold", "total", F.transform("size", lambda x: F.when(x > 0, _units(F.log(x / F.col("n"))))).alias("prior"),
        F.transform("total", lambda x: _units(F.log(F.lit(1) / x))).alias("unseen")),
        spark, f"{run}/folds")
    weights = both.join(F.broadcast(table.select("fold", "total", "unseen")), "fold").select(  # a row for each fold
        "fold", "token", F.array(*[_units(F.log((F.col("left")[j] + 1) / F.col("total")[j])) - F.col("unseen")[j]
                                   for j in range(many)]).alias("more"))
    weights = IO.materialize(weights, spark, f"{run}/weights")
    sizes = IO.materialize(totals.select("token", summed("all").alias("n")), spark, f"{run}/sizes")
    hot, often = hot_tokens(sizes), CW.common(sizes, f"{run}/common")
    near = IO.materialize(weights.join(F.broadcast(often.select("token")), "token", "left_semi"), spark, f"{run}/near")
    each = rows.select("row", "fold", F.explode("tokens").alias("token"))
    met = each.join(F.broadcast(near), ["fold", "token"]).unionByName(CW.rare(each, often, weights, hot, ["fold", "token"]))
    more = met.groupBy("row").agg(*[F.sum(F.col("more")[j]).alias(f"more{j}") for j in range(many)])
    sums = rows.select("row", "keep", "fold", F.greatest(F.size("tokens"), F.lit(0)).cast("long").alias("n")).join(
        more, "row", "left").withColumn("more", F.array(*[F.coalesce(f"more{j}", F.lit(0)) for j in range(many)]))
    # a class without rows in the other folds has no prior; its score is the least there is
    units = F.array(*[F.coalesce(F.col("prior")[j] + F.col("n") * F.col("unseen")[j] + F.col("more")[j],
                                 F.lit(-(1 << 62))) for j in range(many)])
    return _named(sums.join(F.broadcast(table.drop("total")), "fold").select("keep", units.alias("units")), labels)
