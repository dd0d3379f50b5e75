"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is described by its
characters and by how its words repeat, and encoded by a layer that is learned. Gated
attention says how much each passage counts, and the weighted sum of the encoded
passages is scored. Only documents have labels; the weights of passages come from them.

The model is small and fitted with numpy on a sample of labelled documents of bounded size
(``documents`` and ``passages_most`` of ``fit``); scoring covers every passage of all documents.
Only the text goes into a score.

Defined cases: an empty or NULL text is one passage without characters and is scored; equal
texts get equal scores; labels that are NULL, or whose id is, are left out, and of several
for one id the largest counts; with no labels, or of one kind only, every score is the share
of label 1 (0.5 without any); an empty table gives an empty table. Other columns are not looked at, or
pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.staging import stage

PASSAGE_WORDS = 50
HIDDEN, ATTENTION = 24, 16

#: Classes of bytes: lower, upper, digit, space, line end, beyond ASCII, control, then each ASCII punctuation.
_PUNCTUATION = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS = np.full(256, 6, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[128:] = 3, 4, 5
_CLASS[_PUNCTUATION] = np.arange(7, 7 + len(_PUNCTUATION))
CLASSES = 7 + len(_PUNCTUATION)
FEATURES = CLASSES + 6


def passages(text: str | None) -> np.ndarray:
    """One row of features for each passage of a whole text."""
    data = (text or "").encode()
    words = data.split()
    n = max(1, -(-len(words) // PASSAGE_WORDS))
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((n, FEATURES), np.float32)
    if len(raw):
        if n == 1:
            counts = np.bincount(_CLASS[raw], minlength=CLASSES)[None, :]
        else:
            # A word starts after white space; a passage is as many words, with what stands between.
            space = (raw == 32) | ((raw >= 9) & (raw <= 13))
            starts = ~space
            starts[1:] &= space[:-1]
            passage = np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE_WORDS
            counts = np.bincount(passage * CLASSES + _CLASS[raw], minlength=n * CLASSES).reshape(n, CLASSES)
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        out[:, :CLASSES] = np.sqrt(counts / total)
    for p in range(n):
        own = words[p * PASSAGE_WORDS : (p + 1) * PASSAGE_WORDS]
        if own:
            k, kinds = len(own), len(set(own))
            lengths = sum(map(len, own))
            out[p, CLASSES:] = (
                1.0,
                np.log1p(k),
                lengths / k / 10,
                kinds / k,
                sum(map(eq, own, own[1:])) / k,
                sum(map(eq, own, own[2:])) / k,
            )
    return out


@dataclass(frozen=True)
class Model:
    """What ``fit`` learned; ``base`` alone if there was nothing to learn from."""

    base: float
    weights: dict[str, np.ndarray] | None = None

    def score(self, bag: np.ndarray) -> float:
        if self.weights is None:
            return self.base
        w = self.weights
        hidden = np.tanh((bag - w["mean"]) / w["spread"] @ w["W"] + w["b"])
        gate = np.tanh(hidden @ w["V"]) / (1 + np.exp(-(hidden @ w["U"])))
        a = gate @ w["w"]
        a = np.exp(a - a.max())
        return float(1 / (1 + np.exp(-((a / a.sum()) @ hidden @ w["c"] + w["d"][0]))))


def _start(rng: np.random.Generator, mean: np.ndarray, spread: np.ndarray) -> dict[str, np.ndarray]:
    def layer(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    return {
        "mean": mean, "spread": spread, "W": layer(FEATURES, HIDDEN), "b": np.zeros(HIDDEN),
        "V": layer(HIDDEN, ATTENTION), "U": layer(HIDDEN, ATTENTION), "w": layer(ATTENTION),
        "c": layer(HIDDEN), "d": np.zeros(1),
    }


def learn(bags: list[np.ndarray], labels: np.ndarray, steps: int = 1500, batch: int = 128, seed: int = 7) -> Model:
    """Fit the model by gradient steps on batches of whole bags."""
    labels = np.asarray(labels, float)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(float(labels.mean()) if len(labels) else 0.5)
    every = np.concatenate(bags)
    rng = np.random.default_rng(seed)
    p = _start(rng, every.mean(0), every.std(0) + 0.05)
    every = (every - p["mean"]) / p["spread"]
    ends = np.cumsum([len(b) for b in bags])
    begins = ends - [len(b) for b in bags]
    learned = ["W", "b", "V", "U", "w", "c", "d"]
    m1, m2 = ({k: np.zeros_like(p[k]) for k in learned} for _ in range(2))
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(bags), batch)
        rows = np.concatenate([np.arange(begins[i], ends[i]) for i in chosen])
        sizes = ends[chosen] - begins[chosen]
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        owner = np.repeat(np.arange(batch), sizes)
        x = every[rows]
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, at)[owner])
        a = e / np.add.reduceat(e, at)[owner]
        z = np.add.reduceat(a[:, None] * h, at)
        y = 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))
        wrong = (y - labels[chosen]) / batch
        dz = wrong[:, None] * p["c"]
        dh = a[:, None] * dz[owner]
        da = (h * dz[owner]).sum(1)
        de = a * (da - np.add.reduceat(a * da, at)[owner])
        dg = de[:, None] * p["w"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh += dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - h * h)
        slopes = {
            "W": x.T @ du, "b": du.sum(0), "V": h.T @ dt, "U": h.T @ ds,
            "w": (t * s).T @ de, "c": z.T @ wrong, "d": wrong.sum(keepdims=True),
        }
        for k in learned:
            slope = slopes[k] + 1e-4 * p[k]
            m1[k] = 0.9 * m1[k] + 0.1 * slope
            m2[k] = 0.999 * m2[k] + 0.001 * slope**2
            p[k] = p[k] - 0.01 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return Model(float(labels.mean()), p)


def held_out(doc_id: Column) -> Column:
    """Whether an id is kept from training: its crc32, as text, is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    documents: int = 4000,
    passages_most: int = 256_000,
) -> Model:
    """Learn from at most ``documents`` labelled documents that are not held out, all passages of each.

    The sample is drawn by hashes of the id and of the bag. A document with which the sample would have
    more than ``passages_most`` passages is left out of it as a whole. Both bounds are what
    reaches the driver, whatever the size of the tables.
    """
    known = labels.select(F.col(doc_id).alias("_mil_id"), F.col(label).cast("int").alias("_mil_label")).dropna()
    known = known.filter(~held_out(F.col("_mil_id"))).groupBy("_mil_id").agg(F.max("_mil_label").alias("_mil_label"))
    sample = known.orderBy(F.xxhash64("_mil_id"), "_mil_id").limit(documents)
    rows = docs.join(sample, docs[doc_id] == sample["_mil_id"]).select("_mil_id", "_mil_label", F.col(text).alias("text"))

    def describe(batches):
        for frame in batches:
            bags = [passages(t) for t in frame["text"]]
            sizes, data = [len(b) for b in bags], [b.tobytes() for b in bags]
            yield pd.DataFrame({"id": frame["_mil_id"], "label": frame["_mil_label"], "n": sizes, "bag": data})

    found = rows.mapInPandas(describe, "id long, label int, n long, bag binary").withColumn("body", F.xxhash64("bag"))
    found = stage(found.dropDuplicates(["id", "body"]), "mil-sample")
    order = found.select(F.xxhash64("id", "body").alias("drawn"), "id", "body", "n")
    chosen, left = [], passages_most
    for r in order.orderBy("drawn", "id", "body").limit(2 * documents).collect():
        if r.n <= left:
            chosen.append((r.id, r.body))
            left -= r.n
    picked = docs.sparkSession.createDataFrame(chosen, "id long, body long")
    found = sorted((r.id, bytes(r.bag), r.label) for r in found.join(picked, ["id", "body"]).collect())
    bags = [np.frombuffer(bag, np.float32).reshape(-1, FEATURES).astype(float) for _, bag, _ in found]
    return learn(bags, np.array([y for _, _, y in found]))


def scored(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns ``keep`` and the score of every whole text, under ``name``. One pass without a shuffle."""
    rows = docs.select(*keep) if text in keep else docs.select(*keep, text)
    at = rows.columns.index(text)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(name, T.DoubleType())])
    fitted = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [fitted.value.score(passages(t.as_py())) for t in batch.column(at)]
            columns = [*batch.columns[: len(keep)], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = scored(docs, fit(docs, labels))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` without the documents the model rejects, all columns kept."""
    rows = scored(docs, fit(docs, labels, text=text), text, tuple(docs.columns), "_mil_score")
    return rows.filter(F.col("_mil_score") >= least).drop("_mil_score")
