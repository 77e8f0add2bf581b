"""Metrics against brute-force Python on small inputs."""

import math

from pyspark.sql import functions as F

from narrata.functions import vectors as V
from narrata.operators import metrics as MT


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1000.0, 1000.0, -5.0],)], "s array<double>")
    for r in df.select(V.softmax("s").alias("p")).collect():
        assert abs(sum(r["p"]) - 1.0) < 1e-12


def test_argmax_first_maximum(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    assert df.select(V.argmax("s")).first()[0] == 1


def test_top_k_tie_goes_to_higher_index(spark):
    # true class 0 tied with classes 1, 2, 3: the three higher indices rank first
    df = spark.createDataFrame([(0, [1.0, 1.0, 1.0, 1.0]), (3, [1.0, 1.0, 1.0, 1.0])],
                               "y int, s array<double>")
    got = [r[0] for r in df.select(V.true_class_rank("s", F.col("y"))).collect()]
    assert got == [4, 1]


def test_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "y int, p int")
    rep = {r["class"]: r for r in MT.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1"] == 0.0
    assert rep["0"]["precision"] == round(1 / 3, 6) and rep["0"]["recall"] == 1.0
    assert rep["accuracy"]["f1"] == round(1 / 3, 6)


def test_report_against_brute_force(spark):
    import random
    rnd = random.Random(7)
    data = [(rnd.randrange(4), rnd.randrange(4)) for _ in range(200)]
    df = spark.createDataFrame(data, "y int, p int")
    rep = {r["class"]: r for r in MT.classification_report(df, "y", "p").collect()}
    f1s, sup = [], []
    for c in range(4):
        tp = sum(1 for y, p in data if y == c and p == c)
        pp = sum(1 for _, p in data if p == c)
        sp = sum(1 for y, _ in data if y == c)
        pr = tp / pp if pp else 0.0
        rc = tp / sp if sp else 0.0
        f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        assert abs(rep[str(c)]["f1"] - f1) < 1e-6
        f1s.append(f1)
        sup.append(sp)
    assert abs(rep["macro avg"]["f1"] - sum(f1s) / 4) < 1e-6
    assert abs(rep["weighted avg"]["f1"] - sum(f * s for f, s in zip(f1s, sup)) / sum(sup)) < 1e-6


def test_confusion_matrix_zero_cells(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 2)], "y int, p int")
    cm = {(r[0], r[1]): r[2] for r in MT.confusion_matrix(df, "y", "p").collect()}
    assert len(cm) == 9 and cm[(0, 0)] == 0 and cm[(0, 1)] == 1


def test_cross_entropy(spark):
    df = spark.createDataFrame([(0, [2.0, 0.0]), (1, [0.0, 1.0])], "y int, s array<double>")
    got = MT.cross_entropy(df, "y", "s", F.array(F.lit(0), F.lit(1))).first()["mean_ce"]
    want = (-math.log(math.exp(2) / (math.exp(2) + 1)) - math.log(math.e / (1 + math.e))) / 2
    assert abs(got - want) < 1e-6


def test_top_k_classes_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.5],)], "s array<double>")
    assert df.select(V.top_k_classes("s", 3)).first()[0] == [2, 1, 0]


def test_labels_are_not_positions(spark):
    """Classes 3, 7, 9; a true class 5 that the model has never seen."""
    labels = F.array(F.lit(3), F.lit(7), F.lit(9))
    df = spark.createDataFrame([(3, [2.0, 0.0, 1.0]), (9, [0.0, 3.0, 1.0]), (7, [5.0, 0.0, 4.0]), (5, [1.0, 1.0, 1.0])],
                               "y int, s array<double>")
    assert MT.top_k_accuracy(df, "y", "s", labels, 1).first()["top_1_accuracy"] == 0.25
    assert MT.top_k_accuracy(df, "y", "s", labels, 2).first()["top_2_accuracy"] == 0.5

    def loss(scores, i):
        return math.log(sum(math.exp(x) for x in scores)) - scores[i]

    want = (loss([2, 0, 1], 0) + loss([0, 3, 1], 2) + loss([5, 0, 4], 1)) / 3
    assert abs(MT.cross_entropy(df, "y", "s", labels).first()["mean_ce"] - want) < 1e-6
    weights = spark.createDataFrame([(3, 1.0), (7, 2.0), (9, 0.5)], "label int, weight double")
    want = (loss([2, 0, 1], 0) + 2 * loss([5, 0, 4], 1) + 0.5 * loss([0, 3, 1], 2)) / 3.5
    assert abs(MT.cross_entropy(df, "y", "s", labels, weights).first()["weighted_ce"] - want) < 1e-6
