"""Softmax regression with early stopping against numpy, and its stopping rule."""

import math
import random

import numpy as np
import pytest

from narrata.operators import softmax as SX
from narrata.operators import word_bayes as WB


def nearest(x):
    return np.floor(x + 0.5)


def brute_force(train, valid, epochs, patience, rate, weighted):
    """History [(epoch, train loss, validation loss)], the best epoch and its weights, by numpy over dense rows."""
    labels = sorted({y for y, _ in train if y is not None})
    train, valid = ([(y, t) for y, t in part if y in labels] for part in (train, valid))
    words = sorted({w for _, t in train for w in (t or "").split()}) + [""]
    scale = [nearest(1000 * len(train) / (len(labels) * sum(y == x for y, _ in train))) if weighted else 1000. for x in labels]

    def matrix(part):
        out = np.zeros((len(part), len(words)))
        for i, (_, t) in enumerate(part):
            own = set((t or "").split())
            for w in own & set(words):
                out[i, words.index(w)] = nearest(1000 / math.sqrt(max(len(own), 1)))
            out[i, -1] = 1000
        return out

    def judge(x, part, w):
        z = x @ w / 1e12
        z -= z.max(1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        y = np.array([labels.index(a) for a, _ in part])
        loss = nearest(-np.log(p[np.arange(len(y)), y]) * 1e9)
        return loss, nearest((p - np.eye(len(labels))[y]) * 1e9), np.array([scale[i] for i in y])
    xt, xv = matrix(train), matrix(valid)
    w, history, best, waited = np.zeros((len(words), len(labels))), [], None, 0
    for epoch in range(1, epochs + 1):
        loss, r, weight = judge(xt, train, w)
        mass = weight.sum()
        w = w - nearest(((xt * weight[:, None]).T @ r) * rate / (mass * 1000))
        valid_loss = judge(xv, valid, w)[0].mean() / 1e9
        history.append((epoch, (loss * weight).sum() / mass / 1e9, valid_loss))
        if best is None or valid_loss < best[0]:
            best, waited = (valid_loss, epoch, w), 0
        else:
            waited += 1
            if waited == patience:
                break
    return labels, words, history, best


def texts(rng, n, noise):
    for i in range(n):
        y = rng.choice(["card", "debt", "debt", "loan"])
        w = [rng.choice([y, f"{y}{rng.randint(0, 9)}", "the", "and", f"n{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 12))]
        yield (rng.choice(["card", "debt", "loan"]) if rng.random() < noise else y), " ".join(w)


@pytest.mark.parametrize("rate,weighted,hot_parts", [(40.0, True, 1000), (600.0, False, 10)])
def test_epochs_and_stop_equal_numpy(spark, monkeypatch, rate, weighted, hot_parts):
    monkeypatch.setattr(WB, "HOT_PARTS", hot_parts)
    rng = random.Random(4)
    train, valid = list(texts(rng, 150, 0.3)), list(texts(rng, 60, 0.3))
    train += [("debt", None), (None, "card"), train[0], train[0]]
    valid += [("rent", "card"), (None, "debt"), ("card", "unseen words")]
    schema = "label string, text string"
    t, v = (spark.createDataFrame(x, schema) for x in (train, valid))
    fit = SX.fit_early_stopping(t, v, "text", "label", epochs=7, rate=rate, weighted=weighted)
    labels, words, history, best = brute_force(train, valid, 7, 2, rate, weighted)
    got = fit.history.collect()
    assert [r.epoch for r in got] == [h[0] for h in history] and fit.labels == labels
    assert fit.best_epoch == best[1] and [r.epoch for r in got if r.best] == [best[1]]
    for r, (_, a, b) in zip(got, history, strict=True):
        assert abs(r.train_loss - a) < 1e-7 and abs(r.validation_loss - b) < 1e-7
    if rate > 100:
        assert len(got) < 7 and best[1] == len(got) - 2  # it overshoots, and stops after two epochs
    weights = {r.token: r.w for r in fit.weights.collect()}
    assert set(weights) == set(words)
    for i, w in enumerate(words):
        assert np.abs(np.array(weights[w]) - best[2][i]).max() <= 2
    rows = SX.predict(fit, v.selectExpr("*", "1 AS token", "2 AS row"), "text", ["label", "text", "token", "row"]).collect()
    assert len(rows) == len(valid) and all(abs(r.probability - 1 / sum(math.exp(s - max(r.scores)) for s in r.scores)) < 1e-9
                                           and r.predicted == labels[int(np.argmax(r.scores))] for r in rows)


def test_empty_parts_are_errors(spark):
    rows = spark.createDataFrame([("a", "x"), (None, "y")], "label string, text string")
    with pytest.raises(ValueError, match="training"):
        SX.fit_early_stopping(rows.filter("label IS NULL"), rows, "text", "label")
    with pytest.raises(ValueError, match="validation"):
        SX.fit_early_stopping(rows, rows.filter("label IS NULL"), "text", "label")
