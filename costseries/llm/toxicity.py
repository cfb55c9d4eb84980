"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costseries.llm.common import fields
from costseries.session import landed

SAMPLE = 3000  # labelled documents of either class that the chain is fitted on, at most about
FEATURES = 1000  # selected word and prefix features
LEAST = 2  # z-score of a selected feature
FOLDS = 5
STEPS = 150  # of gradient descent
DECAY = 1e-4
PREFIXES = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")

KINDS = 3  # categories before the last one: groups of toxic documents by their own words
CHAIN = (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")  # toxic: the label itself


def features(text: str | None) -> set[str]:
    """Distinct lower-cased words, and word beginnings of 4 to 6 letters marked by a star."""
    found = set(WORD.findall(text.lower())) if text else set()
    return found | {w[:k] + "*" for w in found for k in PREFIXES if len(w) >= k}


def kinds(x: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Number of the group of each toxic document: k-means on unit vectors, the largest group first.

    The labels tell toxic documents apart from others only, so what kinds of toxic documents there are is
    learned from their features. A fixed seed and the order of the rows decide.
    """
    rng = np.random.default_rng(0)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = x[:1]
    while len(centres) < min(KINDS, len(x)):
        far = np.maximum(0, 1 - (x @ centres.T).max(1)).astype(float)
        if far.sum() < 1e-6:
            break  # fewer different documents than kinds
        centres = np.concatenate((centres, x[rng.choice(len(x), p=far / far.sum())][None]))
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        means = np.stack([x[own == k].sum(0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    own = (x @ centres.T).argmax(1)
    order = np.argsort(-np.bincount(own, minlength=len(centres)), kind="stable")
    return np.argsort(order)[own]


def targets(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Labels along the chain, a row per document: its kind if it is toxic, then the label."""
    y = np.zeros((len(x), len(CHAIN)), np.float32)
    y[:, -1] = toxic
    at = np.flatnonzero(toxic)
    if len(at):
        y[at, kinds(x[at])] = 1
    return y


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights and bias of a regularised logistic regression on weighted rows, by accelerated gradient descent."""
    x = np.concatenate((x, np.ones((len(x), 1), x.dtype)), 1)
    w = w / max(w.sum(), 1e-9)
    top = np.ones(x.shape[1], x.dtype)  # power iteration: the largest curvature sets the step
    for _ in range(15):
        top = x.T @ (w * (x @ top))
        size = float(np.linalg.norm(top))
        top /= max(size, 1e-12)
    rate = 4 / max(1.1 * size, 1e-9)
    beta = np.zeros(x.shape[1], x.dtype)
    ahead, t = beta.copy(), 1.0
    for _ in range(STEPS):
        gradient = x.T @ (w * (sigmoid(x @ ahead) - y)) + DECAY * np.append(ahead[:-1], 0)
        new = ahead - rate * gradient.astype(x.dtype)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead = new + x.dtype.type((before - 1) / t) * (new - beta)
        beta = new
    return beta


def fit_chain(x: np.ndarray, y: np.ndarray, w: np.ndarray, fold: np.ndarray) -> list[np.ndarray]:
    """One model per category; each later one also reads the earlier probabilities.

    The probabilities that a later model is trained on are out of fold: made by models that have not seen the
    row, as at prediction time.
    """
    models, earlier = [], np.zeros((len(x), 0), x.dtype)
    for k in range(y.shape[1]):
        data, out = np.concatenate((x, earlier), 1), np.zeros(len(x), x.dtype)
        models.append(logistic(data, y[:, k], w))
        if k + 1 < y.shape[1]:
            for f in range(FOLDS):
                own, rest = fold == f, fold != f
                if own.any() and rest.any():
                    beta = logistic(data[rest], y[rest, k], w[rest])
                    out[own] = sigmoid(data[own] @ beta[:-1] + beta[-1])
            earlier = np.concatenate((earlier, out[:, None]), 1)
    return models


def predict_chain(models: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probabilities along the chain, a column per category."""
    data = x
    for beta in models:
        p = sigmoid(data @ beta[:-1] + beta[-1])
        data = np.concatenate((data, p[:, None].astype(x.dtype)), 1)
    return data[:, x.shape[1] :]


def select(sample: DataFrame) -> list[str]:
    """The features that tell the classes apart best, by the z-score of their document shares; ties by name.

    ``sample`` has a row per document: toxic (0 or 1) and its distinct features ``found``.
    """
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        return []
    share = toxic / n
    counts = sample.select("toxic", F.explode("found").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    z = F.abs(F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)) + 0.5)
    best = counts.withColumn("z", z).where((F.col("n") > 1) & (F.col("z") >= LEAST)).orderBy(F.desc("z"), "name").limit(FEATURES)
    return [r["name"] for r in best.select("name").collect()]


def drawn(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    """At most about ``SAMPLE`` labelled documents of either class (id, toxic, found), and the number of labels of each.

    Labels are drawn by a hash of the id, so that only their bounded sample is joined. A document labelled both ways
    counts as toxic; of repeated ids the least text counts, so that the order of rows doesn't matter.
    """
    known = labels.select(labels[doc].alias("id"), labels[label].alias("toxic")).where("id is not null and toxic is not null")
    known = known.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    limits = [F.lit(-(-1_000_000 * SAMPLE // max(1, sizes.get(k, 1)))) for k in (0, 1)]
    chosen = known.where(draw < F.when(F.col("toxic") == 1, limits[1]).otherwise(limits[0])).orderBy(draw, "id").limit(4 * SAMPLE)
    pairs = docs.select(docs[doc].alias("id"), docs[text].alias("text")).join(F.broadcast(chosen), "id")
    pairs = pairs.groupBy("id", "toxic").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features(v.as_py())) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], names=["id", "toxic", "found"])

    kind = docs.schema[doc].dataType.simpleString()
    return landed(pairs.mapInArrow(run, fields(f"id {kind}, toxic int, found array<string>")), "toxicity"), sizes


def learn(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str) -> tuple[list[str], list[np.ndarray]]:
    """Select features and fit the chain on the documents of ``drawn``.

    Rows of a class stand for all its labels through their weights. Only numbers of selected features reach the
    driver, at most ``FEATURES`` a document.
    """
    sample, sizes = drawn(docs, labels, doc, text, label)
    names = select(sample)
    if not names:  # nothing to tell apart: every document gets the share of toxic labels
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return [], [np.append(np.zeros(k), bias).astype(np.float32) for k in range(len(CHAIN))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {f: k for k, f in enumerate(names)}
        for batch in batches:
            own = [[at[f] for f in found if f in at] for found in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32()))], names=["id", "toxic", "own"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = sorted(sample.mapInArrow(run, fields(f"id {kind}, toxic int, own array<int>")).toLocalIterator(), key=lambda r: str(r["id"]))
    x = np.zeros((len(rows), len(names)), np.float32)
    for k, r in enumerate(rows):
        x[k, r["own"]] = 1
    toxic = np.array([r["toxic"] for r in rows])
    folds = np.array([zlib.crc32(str(r["id"]).encode()) % FOLDS for r in rows])
    weight = np.where(toxic == 1, sizes.get(1, 0) / max(1, toxic.sum()), sizes.get(0, 0) / max(1, (1 - toxic).sum()))
    return names, fit_chain(x, targets(x, toxic), weight.astype(np.float32), folds)


def score(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """One row per document: id, ``toxic`` and the probability of every category of the chain.

    A null text has no features. Without labels of both classes every document gets the share of
    toxic labels as its probability. Whole texts are read. Repeated rows give repeated results; other columns are not
    carried; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, doc, text, label))
    kind = docs.schema[doc].dataType.simpleString()
    schema = fields(f"id {kind}, toxic boolean, " + ", ".join(f"p_{c} double" for c in CHAIN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, models = shared.value
        at = {f: k for k, f in enumerate(names)}
        known: dict[str, tuple[int, ...]] = {}  # word -> its features

        def indices(word: str) -> tuple[int, ...]:
            if len(known) > 300_000:
                known.clear()
            forms = [word, *(word[:k] + "*" for k in PREFIXES if len(word) >= k)]
            known[word] = got = tuple(at[f] for f in forms if f in at)
            return got

        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                x = np.zeros((batch.num_rows, len(names)), np.float32)
                for r, value in enumerate(batch.column(1)):
                    body = value.as_py()
                    for w in set(WORD.findall(body.lower())) if body else ():
                        got = known.get(w)
                        if got is None:
                            got = indices(w)
                        if got:
                            x[r, got] = 1
                p = predict_chain(models, x).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p[:, -1] >= threshold), *[pa.array(c) for c in p.T]], names=schema.names)

    return docs.select(docs[doc].alias("id"), docs[text].alias("text")).mapInArrow(run, schema).withColumnRenamed("id", doc)
