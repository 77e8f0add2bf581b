"""Model scoring (M4-M6): linear scores, softmax, caller models in Arrow batches.

A fitted model is small (classes x features) and written once. Plans take it
as one array value; a caller's numpy code gets it in its closure, like any
MLlib model, after its bytes are checked. Data rows never pass through the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import vectors as V
from narrata.sources import io as IO

MAX_MODEL_BYTES = 16 << 20   # of a model shipped to Python workers in a closure


def fit_centroids(df: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    """Per-class mean vector as rows ``(label, pos, mean)``.

    ``posexplode`` + ``groupBy(label, pos)``: the partial aggregate reduces
    every partition to classes x dim rows before the shuffle.
    """
    ex = df.select(F.col(label_col).alias("label"), F.posexplode(vec_col).alias("pos", "x"))
    return ex.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def centroid_rows(centroids: DataFrame) -> DataFrame:
    """``(label, vec)``: one row per class, written once, so that a model is fitted once."""
    vec = F.transform(F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda x: x["mean"])
    return IO.materialize(centroids.groupBy("label").agg(vec.alias("vec")), centroids.sparkSession, "centroids")


def model_column(model: DataFrame) -> Column:
    """All classes of a ``(label, vec)`` model as one array value in label order.

    A scalar subquery: attach it to the rows as a column before lambdas use it.
    """
    return model.agg(F.array_sort(F.collect_list(F.struct("label", "vec")))).scalar()


def model_labels(model) -> Column:
    return F.transform(model, lambda c: c["label"])


def linear_scores(vec, model) -> Column:
    """Score vector ``[vec . w_c for each class c]``; ``model`` names the attached model column."""
    return F.transform(model, lambda c: V.dot(vec, c["vec"]))


def local_model(model: DataFrame) -> tuple[list, list[list[float]]]:
    """``(labels, matrix)`` on the driver for a caller's numpy code, after its size is checked."""
    cells = model.agg(F.sum(F.size("vec"))).first()[0] or 0
    if 8 * cells > MAX_MODEL_BYTES:
        raise ValueError(f"a model of {8 * cells} bytes doesn't fit a closure; score it with linear_scores")
    rows = model.orderBy("label").collect()
    return [r["label"] for r in rows], [[float(x) for x in r["vec"]] for r in rows]


def predict(scores) -> tuple[Column, Column, Column]:
    """(probabilities, arg-max class index, probability of that class)."""
    probs = V.softmax(scores)
    pred = V.argmax(scores)
    return probs, pred, F.element_at(probs, pred + 1)


def score_batches(df: DataFrame, input_col: str, make_predict_fn, return_type,
                  batch_size: int = 32, input_tensor_shapes=None) -> Column:
    """Caller model applied in Arrow batches (``predict_batch_udf``).

    ``make_predict_fn`` runs once per Python worker and returns
    ``numpy batch -> numpy batch``; the model is loaded there, not per row.
    """
    from pyspark.ml.functions import predict_batch_udf

    udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size,
                            input_tensor_shapes=input_tensor_shapes)
    return udf(F.col(input_col))


def numpy_linear_predictor(matrix):
    """Factory for ``predict_batch_udf``: float vectors -> class scores with numpy."""
    def make():
        import numpy as np

        w = np.asarray(matrix, dtype=np.float64).T

        def predict_fn(x):
            return np.asarray(x, dtype=np.float64) @ w
        return predict_fn
    return make


def compare_models(df: DataFrame, id_col: str, inputs: dict, models: dict, prepare=None) -> DataFrame:
    """Every (input, model) pair scored side by side, one row per (row of ``df``, input, model).

    ``inputs``: name -> Column (text). They are stacked as rows (``id_col``,
    ``input``, ``text``), ``prepare`` (a text Column -> Column, cleaning for
    example) is applied to ``text``, and the table is written once; all models
    read it. ``models``: name -> (that table -> DataFrame that carries
    ``id_col`` and ``input`` beside its prediction columns); so no scores are
    joined back, and rows that share an id stay rows. A null text is the
    model's to score. The result has the columns ``model`` and those that the
    models return, which must agree in names.
    """
    both = F.array(*[F.struct(F.lit(name).alias("input"), col.alias("text")) for name, col in inputs.items()])
    text = prepare(F.col("text")) if prepare else F.col("text")
    stacked = df.select(F.col(id_col), F.inline(both)).select(id_col, "input", text.alias("text"))
    stacked = IO.materialize(stacked, df.sparkSession, "compare-inputs")
    out = None
    for name, score in models.items():
        scored = score(stacked).withColumn("model", F.lit(name))
        out = scored if out is None else out.unionByName(scored)
    return out
