"""Column functions over ``array<double>`` score vectors (JVM-side lambdas)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return _col(c).cast("array<double>")


def dot(a, b) -> Column:
    """Inner product of two equal-length arrays, summed in index order."""
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(as_double(a), F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a, b) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def softmax(c) -> Column:
    """Max-shifted softmax of a score vector."""
    s = as_double(c)
    m = F.array_max(s)
    e = F.transform(s, lambda x: F.exp(x - m))
    tot = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda x: x / tot)


def log_sum_exp(c) -> Column:
    s = as_double(c)
    m = F.array_max(s)
    return m + F.log(F.aggregate(F.transform(s, lambda x: F.exp(x - m)), F.lit(0.0),
                                 lambda acc, v: acc + v))


def argmax(c) -> Column:
    """0-based index of the first maximum."""
    s = _col(c)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def round_elements(c, places: int = 2) -> Column:
    scale = float(10 ** places)
    return F.transform(as_double(c), lambda x: F.round(x * F.lit(scale)) / F.lit(scale))


def class_index(label, labels) -> Column:
    """0-based place of a label in the class order of the scores; NULL for a label that has no score."""
    return F.nullif(F.array_position(labels, _col(label)), F.lit(0)) - 1


def true_class_rank(scores, index) -> Column:
    """1-based rank of the score at ``index`` (a 0-based place) within the row.

    Classes scoring strictly higher come first; on an equal score the class
    with the higher index wins, so the true class is ranked after it.
    """
    s = as_double(scores)
    y = _col(index)
    sy = F.element_at(s, (y + 1).cast("int"))
    ahead = F.filter(s, lambda x, i: (x > sy) | ((x == sy) & (i > y)))
    return F.when(y.isNotNull(), (F.size(ahead) + 1).cast("int"))


def top_k_classes(scores, k: int) -> Column:
    """0-based indices of the k best scores, best first; on equal scores the
    higher class index comes first."""
    s = as_double(scores)
    pairs = F.transform(s, lambda x, i: F.struct(x.alias("score"), i.alias("cls")))
    ordered = F.array_sort(pairs, lambda a, b: F.when(a["score"] > b["score"], -1)
                           .when(a["score"] < b["score"], 1)
                           .when(a["cls"] > b["cls"], -1)
                           .when(a["cls"] < b["cls"], 1).otherwise(0))
    return F.transform(F.slice(ordered, 1, k), lambda p: p["cls"])
