"""Softmax regression over words with early stopping by validation loss (M7, M10).

Texts are cut into distinct words once and written as sparse rows of unit
length. An epoch is three Spark aggregates and no driver loop over rows: the
rows' scores (words joined to the weight table, summed by row), the losses of
both parts, and the gradient, one grouped sum per (word, class). Only the two
losses come to the driver, which decides whether another epoch follows.

All sums are of whole numbers (weights and residuals in 1e-9, row lengths and
row weights in 1e-3), so they don't depend on the order of summation or the
partitioning, and SQL can replay the epochs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.operators import labels as LB
from narrata.operators import scoring as SC
from narrata.operators import word_bayes as WB
from narrata.sources import io as IO

#: Units of weights and residuals, and of row lengths and row weights.
FINE, COARSE = 1e9, 1e3
#: The token of the intercept; no word is empty.
BIAS = ""
DECIMAL = "decimal(38,0)"


@dataclass
class Fit:
    """The best epoch's ``weights`` (token, w: one whole number of 1e-9 per class), its number, and the ``history``."""

    labels: list
    hot: list
    weights: DataFrame
    best_epoch: int
    history: DataFrame


def _nearest(x: Column) -> Column:
    return F.floor(x + F.lit(0.5)).cast("long")


def _sparse(rows: DataFrame, text_col: str, *cols: Column) -> DataFrame:
    """(row, ..., cells): the row's distinct words and the intercept, each with its value in thousandths."""
    words = F.array_distinct(F.coalesce(T.words(text_col), F.array().cast("array<string>")))
    size = F.greatest(F.size("words"), F.lit(1))
    value = _nearest(F.lit(COARSE) / F.sqrt(size.cast("double")))
    numbered = rows.select(*cols, words.alias("words"), F.monotonically_increasing_id().alias("row"))
    cells = F.concat(F.transform("words", lambda w: F.struct(w.alias("token"), value.alias("x"))),
                     F.array(F.struct(F.lit(BIAS).alias("token"), F.lit(int(COARSE)).cast("long").alias("x"))))
    return numbered.select("*", cells.alias("cells")).drop("words")


def _scores(rows: DataFrame, carried: list[str], weights: DataFrame | None, hot: list[str], many: int) -> DataFrame:
    """Carried columns and ``z``: the scores of all classes."""
    if weights is None:  # before the first epoch all weights are zero
        return rows.select("row", *carried, F.array_repeat(F.lit(0.0), many).alias("z"))
    cells = rows.select("row", *carried, F.inline("cells"))
    met = WB.with_salt(cells, hot, "row").join(WB.salted(weights.select("token", "w"), hot), ["token", "salt"], "left")
    sums = [F.coalesce(F.sum((F.col("x") * F.col("w")[j]).cast("decimal(28,0)")), F.lit(0)).cast("double") for j in range(many)]
    z = F.array(*[s / F.lit(FINE * COARSE) for s in sums])
    return met.groupBy("row", *carried).agg(z.alias("z"))


def _judged(scores: DataFrame) -> DataFrame:
    """Scores with each row's loss and residuals (probability minus truth) in 1e-9."""
    top = F.array_max("z")
    s = T.with_computed(scores, e=F.transform("z", lambda v: F.exp(v - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    loss = _nearest((F.log(total) - (F.element_at("z", F.col("y") + 1) - top)) * F.lit(FINE))
    residual = F.transform("e", lambda v, j: _nearest(
        (v / total - F.when(j == F.col("y"), 1.0).otherwise(0.0)) * F.lit(FINE)))
    return s.select("row", "part", "weight", loss.alias("loss"), residual.alias("r"))


def _losses(judged: DataFrame) -> tuple[float, float]:
    """The weighted training loss and the plain validation loss."""
    train, valid = F.col("part") == "train", F.col("part") == "validation"
    d = (F.col("loss") * F.col("weight")).cast(DECIMAL)
    r = judged.agg(F.sum(F.when(train, d)).cast("double").alias("tl"), F.sum(F.when(train, F.col("weight"))).alias("tw"),
                   F.sum(F.when(valid, F.col("loss").cast(DECIMAL))).cast("double").alias("vl"),
                   F.count(F.when(valid, 1)).alias("vn")).first()
    return r.tl / (r.tw * FINE), r.vl / (r.vn * FINE)


def _step(rows: DataFrame, judged: DataFrame, weights: DataFrame | None, rate: float, mass: int, many: int) -> DataFrame:
    """The weights after one step against the gradient, a grouped sum per (word, class) over the training rows."""
    pulled = judged.filter(F.col("part") == "train").select("row", "weight", "r")
    cells = rows.filter(F.col("part") == "train").select("row", "cells").join(pulled, "row").select(
        "weight", "r", F.inline("cells"))
    gradient = cells.groupBy("token").agg(F.array(*[
        F.sum((F.col("x") * F.col("weight")).cast("decimal(19,0)") * F.col("r")[j].cast("decimal(10,0)"))
        .cast("double") for j in range(many)]).alias("g"))
    move = F.transform("g", lambda g: F.floor(g * F.lit(rate) / F.lit(mass * COARSE) + F.lit(0.5)).cast("long"))
    if weights is None:
        return gradient.select("token", F.transform(move, lambda m: -m).alias("w"))
    return gradient.join(weights, "token").select("token", F.zip_with("w", move, lambda w, m: w - m).alias("w"))


def fit_early_stopping(train: DataFrame, validation: DataFrame, text_col: str, label_col: str, epochs: int = 10,
                       patience: int = 2, rate: float = 40.0, weighted: bool = True) -> Fit:
    """Fit by full-batch steps until the validation loss hasn't fallen for ``patience`` epochs; the best epoch is kept.

    ``weighted`` gives every class the same total weight in the training loss
    (n / (k * class size)); the validation loss is unweighted. An epoch's
    training loss is taken before its step, its validation loss after it. Rows
    without label, and validation rows whose label the training part doesn't
    have, are left out; a null or empty text has the intercept alone; rows
    that share ids stay rows. An empty part raises ValueError.
    """
    spark, run = train.sparkSession, f"models/softmax-{uuid.uuid4().hex}"
    label = F.col(label_col).alias("label")
    sizes = LB.class_map(train.filter(F.col(label_col).isNotNull()).groupBy(label).agg(F.count("*").alias("size")))
    counts = {r.label: r["size"] for r in sizes.orderBy("label").collect()}  # a row for each class
    labels, many, n = list(counts), len(counts), sum(counts.values())
    if not many:
        raise ValueError("no training rows with a label")
    scale = {x: int(COARSE * n / (many * c) + 0.5) if weighted else int(COARSE) for x, c in counts.items()}
    place = F.create_map(*[F.lit(v) for j, x in enumerate(labels) for v in (x, j)])
    weight = F.create_map(*[F.lit(v) for x, w in scale.items() for v in (x, w)])
    both = None
    for name, part in (("train", train), ("validation", validation)):
        some = part.filter(F.col(label_col).isin(labels)).select(F.col(text_col).alias("text"), label, F.lit(name).alias("part"))
        both = some if both is None else both.unionByName(some)
    rows = IO.materialize(_sparse(both, "text", "part", place[F.col("label")].alias("y"),
                                  weight[F.col("label")].cast("long").alias("weight")), spark, f"{run}/rows")
    if rows.filter(F.col("part") == "validation").isEmpty():
        raise ValueError("no validation rows with a label of the training part")
    tokens = rows.filter(F.col("part") == "train").select(F.inline("cells")).groupBy("token").agg(F.count("*").alias("n"))
    hot = WB.hot_tokens(IO.materialize(tokens, spark, f"{run}/tokens"))
    mass = sum(scale[x] * c for x, c in counts.items())

    carried = ["part", "y", "weight"]
    judged = IO.materialize(_judged(_scores(rows, carried, None, hot, many)), spark, f"{run}/judged-0")
    train_loss, _ = _losses(judged)
    weights, best, history, waited = None, None, [], 0
    for epoch in range(1, epochs + 1):
        weights = IO.materialize(_step(rows, judged, weights, rate, mass, many), spark, f"{run}/weights-{epoch}")
        judged = IO.materialize(_judged(_scores(rows, carried, weights, hot, many)), spark, f"{run}/judged-{epoch}")
        next_loss, valid_loss = _losses(judged)
        history.append((epoch, train_loss, valid_loss))
        train_loss = next_loss
        if best is None or valid_loss < best[0]:
            best, waited = (valid_loss, epoch, weights), 0
        else:
            waited += 1
            if waited >= patience:
                break
    schema = "epoch int, train_loss double, validation_loss double, best boolean"
    table = spark.createDataFrame([(*h, h[0] == best[1]) for h in history], schema)
    return Fit(labels, hot, best[2], best[1], table)


def predict(fit: Fit, df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """``keep`` columns, ``scores`` (of ``fit.labels``), ``predicted`` and its ``probability``; a row for every row."""
    rows = _sparse(df, text_col, F.struct(*keep).alias("keep"))
    scored = _scores(rows, ["keep"], fit.weights, fit.hot, len(fit.labels))
    names = F.array(*[F.lit(x) for x in fit.labels])
    _, best, probability = SC.predict("z")
    return scored.select("keep.*", F.col("z").alias("scores"), F.element_at(names, best + 1).alias("predicted"),
                         probability.alias("probability"))
