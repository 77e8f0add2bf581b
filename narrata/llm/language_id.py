"""Language identification by a byte convolutional network (operator 9).

A window of 256 bytes goes through byte embeddings, convolutions of several
widths, max pooling over the window and a softmax. The network is trained with
numpy on the driver from a bounded sample of labelled windows; Spark tasks
apply it to all windows of every text, many windows at a time, and a text's
probabilities are the mean over its windows by their bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from narrata.llm.batches import map_texts, row_chunks, text_buffer

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: The bounded training sample: documents of each language, windows of each, documents in all (one of each language at least).
DOCS_PER_LANGUAGE = 600
WINDOWS_PER_DOC = 4
MAX_DOCS = 64 * DOCS_PER_LANGUAGE
#: Most bytes of the last layer's weights, which grow with the number of languages.
MAX_WEIGHT_BYTES = 16 << 20
EPOCHS = 8
UNDETERMINED = "und"
_PAD, _UNSEEN = 0, 1
_HASHES = (1 << 63) - 1


@dataclass
class Model:
    """Parameters of a trained network; ``symbols`` maps a byte to its row of ``embedding``."""

    labels: list[str]
    symbols: np.ndarray
    embedding: np.ndarray
    kernels: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, labels) for symbols (windows, WINDOW + max width - 1)."""
        return _softmax(np.maximum(self._pooled(x), 0) @ self.dense + self.dense_bias)

    def _tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """A convolution of one-hot symbols is a sum of table rows: of pairs, and of a single for odd widths."""
        n = len(self.embedding)
        out = []
        for kernel in self.kernels:
            single = [np.ascontiguousarray(self.embedding @ k) for k in kernel]
            own = [(i, (single[i][:, None] + single[i + 1]).reshape(n * n, -1)) for i in range(0, len(kernel) - 1, 2)]
            if len(kernel) % 2:
                own.append((len(kernel) - 1, single[-1]))
            out.append(own)
        return out

    def _pooled(self, x: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_cached"):
            self._cached = self._tables()
        n = len(self.embedding)
        pairs = x[:, :-1].astype(np.int32) * n + x[:, 1:]
        pooled = []
        for kernel, tables in zip(self.kernels, self._cached, strict=True):
            total = None
            for at, table in tables:
                index = (pairs if len(table) == n * n else x)[:, at:at + WINDOW]
                part = table.take(index, axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(total.max(axis=1))
        return np.concatenate(pooled, axis=1) + self.bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def window_symbols(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Windows of the bytes as symbols, filled up with the padding symbol."""
    at = np.arange(WINDOW + max(WIDTHS) - 1)
    index = begin[:, None] + at
    inside = at < size[:, None]
    out = np.full(index.shape, _PAD, np.uint8)
    out[inside] = symbols[raw[index[inside]]]
    return out


def train(windows: list[tuple[bytes, str]], epochs: int = EPOCHS, seed: int = 7) -> Model | None:
    """A network from labelled windows by Adam on the cross-entropy; None without any."""
    if not windows:
        return None
    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in windows})
    y = np.searchsorted(labels, [lang for _, lang in windows])
    raw = np.frombuffer(b"".join(w for w, _ in windows), np.uint8)
    sizes = np.array([len(w) for w, _ in windows])
    begin = np.cumsum(sizes) - sizes
    symbols = np.full(256, _UNSEEN, np.uint8)
    seen = np.flatnonzero(np.bincount(raw, minlength=256) >= 5)[:254]
    symbols[seen] = np.arange(len(seen)) + 2
    n_sym = len(seen) + 2
    p = {"e": rng.normal(0, 0.5, (n_sym, EMBEDDING)), "b": np.zeros(FILTERS * len(WIDTHS)),
         "d": rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(labels))), "db": np.zeros(len(labels))}
    for i, w in enumerate(WIDTHS):
        p[f"k{i}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w, EMBEDDING, FILTERS))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    moment, step = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}, 0
    frequency = np.bincount(y, minlength=len(labels))
    importance = (len(y) / (len(labels) * frequency))[y]
    for _ in range(epochs):
        # other cuts in each epoch, so that short texts are learned too
        short = rng.random(len(y)) < 0.4
        lengths = np.where(short, np.minimum(sizes, rng.integers(12, WINDOW, len(y))), sizes)
        order = rng.permutation(len(y))
        for lo in range(0, len(order), 64):
            own = order[lo:lo + 64]
            x = window_symbols(raw, begin[own], lengths[own], symbols)
            g = _gradients(p, x, y[own], importance[own])
            step += 1
            for k, v in g.items():
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                p[k] -= 0.004 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return Model(labels, symbols, p["e"], [p[f"k{i}"] for i in range(len(WIDTHS))], p["b"], p["d"], p["db"])


def _gradients(p: dict, x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> dict:
    n, e = len(x), p["e"][x]
    pooled, best = [], []
    for i, w in enumerate(WIDTHS):
        conv = sum(e[:, j:j + WINDOW] @ p[f"k{i}"][j] for j in range(w))
        best.append(conv.argmax(axis=1))
        pooled.append(np.take_along_axis(conv, best[-1][:, None], axis=1)[:, 0])
    z = np.concatenate(pooled, axis=1) + p["b"]
    h = np.maximum(z, 0)
    prob = _softmax(h @ p["d"] + p["db"])
    prob[np.arange(n), y] -= 1
    prob *= (importance / n)[:, None]
    back = (prob @ p["d"].T) * (z > 0)
    g = {"d": h.T @ prob, "db": prob.sum(0), "b": back.sum(0), "e": np.zeros_like(p["e"])}
    rows = np.arange(n)[:, None]
    for i, w in enumerate(WIDTHS):
        own = back[:, i * FILTERS:(i + 1) * FILTERS]
        kernel = np.zeros_like(p[f"k{i}"])
        for j in range(w):  # only the places that won the pooling pass a gradient on
            kernel[j] = np.einsum("nfe,nf->ef", e[rows, best[i] + j], own)
            np.add.at(g["e"], x[rows, best[i] + j], own[:, :, None] * p[f"k{i}"][j].T)
        g[f"k{i}"] = kernel
    return g


def held_out(doc_id: str = "doc_id"):
    """Documents kept from training: crc32 of the id as text leaves 2 modulo 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _bound(per_language: int, n: int) -> int:
    """The largest hash that goes on of a language of n documents (some four samples, 64 documents at least)."""
    return min(_HASHES, max(64, 4 * per_language) * _HASHES // n)


def training_windows(docs: DataFrame) -> list[tuple[bytes, str]]:
    """The bounded sample of labelled windows, the same for any partitioning.

    For every language the ``DOCS_PER_LANGUAGE`` first documents by a hash of
    their ids (fewer where all languages would pass ``MAX_DOCS``), of each
    ``WINDOWS_PER_DOC`` windows at hashed places. Only ``text`` and ``lang``
    of documents that are not held out are read.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
                           & F.col("text").rlike(r"\p{L}"))
    counted = labelled.groupBy("lang").count()
    most = MAX_WEIGHT_BYTES // (4 * FILTERS * len(WIDTHS))
    counts = {r.lang: r["count"] for r in counted.limit(most + 1).collect()}
    if len(counts) > most:
        raise ValueError(f"more than {most} languages: the weights of as many don't fit {MAX_WEIGHT_BYTES} bytes")
    if not counts:
        return []
    per_language = max(1, min(DOCS_PER_LANGUAGE, MAX_DOCS // len(counts)))
    # ids by a hash; only hashes below a bound that holds some four samples go on, so no task sees a whole language
    h = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1)
    bounds = docs.sparkSession.createDataFrame(
        [(lang, _bound(per_language, n)) for lang, n in counts.items()], "lang string, bound long")
    first = Window.partitionBy("lang").orderBy("h")
    places = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOC - 1)), lambda i: F.when(
        i == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col("h"), i), F.length("text"))))
    cut = (labelled.join(F.broadcast(bounds), "lang").withColumn("h", h).filter(F.col("h") <= F.col("bound"))
           .withColumn("windows", F.transform(places, lambda at: F.substring(
               F.col("text"), (at + 1).cast("int"), F.lit(WINDOW))))
           .select("lang", "h", "windows"))
    sample = cut.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
    out = []
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.h, r.windows)):
        out += [(w.encode()[:WINDOW], r.lang) for w in dict.fromkeys(r.windows) if len(w) >= 8 or len(r.windows[0]) < 8]
    return [x for x in out if x[0]]


_models: dict[str, Model] = {}


def predict(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: all its windows, a bounded number at a time."""
    raw, offsets = text_buffer(texts)
    n = len(offsets) - 1
    sure = np.array([any(map(str.isalpha, t)) if t else False for t in texts.to_pylist()], bool)
    if model is None or not sure.any():
        return [UNDETERMINED] * n, np.zeros(n)
    many = np.where(sure, -(-np.diff(offsets) // WINDOW), 0)
    row = np.repeat(np.arange(n), many)
    begin = offsets[row] + WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
    size = np.minimum(WINDOW, offsets[row + 1] - begin)
    padded = np.append(raw, np.zeros(WINDOW, np.uint8))
    total = np.zeros((n, len(model.labels)))
    for at in range(0, len(row), 256):
        part = slice(at, at + 256)
        # a window's convolutions end with it; what follows is padding, as in training
        prob = model.probabilities(window_symbols(padded, begin[part], size[part], model.symbols))
        np.add.at(total, row[part], prob * size[part][:, None])
    best = total.argmax(axis=1)
    score = total[np.arange(n), best] / np.maximum(np.diff(offsets), 1)
    return ([model.labels[b] if s else UNDETERMINED for b, s in zip(best, sure, strict=True)],
            np.where(sure, np.clip(score, 0, 1), 0.0))


def _apply(model, text: str, keep: list[str], added: list[str]):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _models:
            _models.clear()
            _models[key] = model.value
        for rows in row_chunks(batches, text):
            lang, score = predict(_models[key], rows.column(text))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*keep, *added])
    return run


def fit(docs: DataFrame) -> Model | None:
    """The network of a table of labelled documents (doc_id, text, lang)."""
    return train(training_windows(docs))


def identify(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text: str = "text",
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the predicted language and its probability.

    Columns of ``docs`` by one of ``names`` are replaced. A text that is null or
    has no letter is ``und`` with score 0, as is every text without a model.
    Only the text's bytes enter a prediction.
    """
    keep = [c for c in (keep or docs.columns) if c not in names]
    schema = StructType([*(docs.schema[c] for c in keep), StructField(names[0], StringType()),
                         StructField(names[1], DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)  # the network's size doesn't depend on the data's
    return map_texts(docs.select(*dict.fromkeys([*keep, text])), _apply(held, text, keep, list(names)), schema)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` whose language the network (trained on their own labels) is sure of; all columns stay.

    Rejected are texts without a letter and texts of which no language has
    half of the probability (texts that mix languages). A text whose own
    ``lang`` the network hasn't learned (all its documents are held out) isn't
    rejected for a low probability.
    """
    names = ("lang_pred", "score")
    while set(names) & set(docs.columns):
        names = ("_" + names[0], "_" + names[1])
    model = fit(docs)
    found = identify(docs, model, names=names)
    unknown = F.coalesce(~F.col("lang").isin(model.labels if model else []), F.lit(False))
    sure = (F.col(names[0]) != UNDETERMINED) & ((F.col(names[1]) >= least) | unknown)
    return found.filter(sure).select(*docs.columns)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), fit(docs), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
