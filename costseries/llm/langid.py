"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costseries.llm.common import fields

DIMENSIONS = 4096  # hashed n-gram buckets
SAMPLE = 400  # labelled documents per language that centroids are fitted on, at most about
CENTROIDS = 4  # clusters per language
MARGIN = 1.25  # a text further from its centroid than this times the farthest one in training is rejected
PART = 1 << 18  # code points counted at a time


def grams(text: str | None) -> np.ndarray:
    """Counts of hashed 1-, 2- and 3-grams of lower-cased letters; other characters become one space between words."""
    counts = np.zeros(DIMENSIONS, np.float32)
    body = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) if text and not text.isascii() else _ascii(text or "")
    if not body:
        return counts
    points = np.frombuffer(f" {body} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    for at in range(0, len(points), PART):
        p = points[at : at + PART + 2]
        one = p[: PART] * np.uint64(0x9E3779B97F4A7C15)
        two = (p[:-1] * np.uint64(0x100000001B3) ^ p[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        three = ((p[:-2] * np.uint64(0x100000001B3) ^ p[1:-1]) * np.uint64(0x100000001B3) ^ p[2:]) * np.uint64(0x165667B19E3779F9)
        for h in (one, two[:PART], three[:PART]):
            counts += np.bincount((h >> np.uint64(40)).astype(np.int64) % DIMENSIONS, minlength=DIMENSIONS)
    return counts


_KEEP = {i: (chr(i).lower() if chr(i).isalpha() else " ") for i in range(128)}


def _ascii(text: str) -> str:
    return " ".join(text.translate(_KEEP).split())


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    names: list[str]  # of each centroid
    reach: np.ndarray  # largest cosine distance that still counts as the language, per centroid

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine with its nearest centroid (0 to 1), and whether the distance is within reach."""
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(1)
        score = cosine[np.arange(len(best)), best]
        return [self.names[b] for b in best], np.clip(score, 0, 1).astype(float), 1 - score <= self.reach[best]


def fit(rows: list[tuple[str, np.ndarray]]) -> Model:
    """Spherical k-means inside each language, on (language, counts) rows in a fixed order."""
    counts = np.array([c for _, c in rows], np.float32).reshape(-1, DIMENSIONS)
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    blank = Model(idf, np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(0))
    vectors, centroids, names, reach = blank.vectors(counts), [], [], []
    for name in sorted({n for n, _ in rows}):
        own = vectors[[i for i, (n, _) in enumerate(rows) if n == name]]
        heads = [own[0]]
        while len(heads) < min(CENTROIDS, len(own)):  # the vector farthest from all heads starts the next
            heads.append(own[(own @ np.array(heads).T).max(1).argmin()])
        heads = np.array(heads)
        for _ in range(12):
            nearest = (own @ heads.T).argmax(1)
            for k in range(len(heads)):
                if (nearest == k).any():
                    mean = own[nearest == k].mean(0)
                    heads[k] = mean / max(np.linalg.norm(mean), 1e-12)
        cosine = own @ heads.T
        nearest = cosine.argmax(1)
        for k in range(len(heads)):
            if (nearest == k).any():
                centroids.append(heads[k])
                names.append(name)
                reach.append(MARGIN * float((1 - cosine[nearest == k, k]).max()))
    return Model(idf, np.array(centroids, np.float32), names, np.array(reach))


def held_out(doc: Column) -> Column:
    """crc32 of the id as text leaves 1 modulo 3; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def learn(docs: DataFrame, doc: str, text: str, lang: str, sample: int = SAMPLE) -> Model | None:
    """Fit on about ``sample`` documents per language, chosen by a hash of the id among those not held out.

    A threshold on the hash takes the same share from every partition, so no window or sort is needed,
    and only count vectors of fixed size reach the driver: about ``sample`` for each of the languages, all of which are learned.
    None without any labelled text.
    """
    known = docs.select(docs[doc].alias("id"), docs[text].alias("text"), docs[lang].alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000_000))
    # One row per language, as the model has. Equal rows are drawn together and count once, so the sample depends neither on their number nor on the order of tasks.
    share = sizes.select("lang", F.ceil(F.lit(1_000_000_000.0) * sample / F.col("n")).alias("share"))
    chosen = known.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("id", "text", "lang").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                keep = [k for k, t in enumerate(texts) if has_letter(t)]
                those = pa.array(keep, pa.int64())
                vectors = [grams(texts[k]).tobytes() for k in keep]
                yield pa.RecordBatch.from_arrays([part.column(0).take(those), pa.array(vectors, pa.binary()), part.column(2).take(those)], names=["lang", "v", "h"])

    rows = chosen.select("lang", "text", F.xxhash64("id", "text").alias("h")).mapInArrow(run, fields("lang string, v binary, h long"))
    got = sorted(rows.collect(), key=lambda r: (r["lang"], r["h"], r["v"]))
    return fit([(r["lang"], np.frombuffer(r["v"], np.float32)) for r in got]) if got else None


def identify(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score`` (cosine), ``accepted``.

    ``accepted`` is the distance-based verdict: false where the nearest centroid is out of reach, so a
    caller may treat the text as unknown. A null text, or one without a letter, is ``und`` with
    score 0 and not accepted, and so is every text if nothing labelled can be learned from. The whole text is read.
    Repeated rows give repeated results; other columns are not carried; an empty table gives an empty result.
    """
    model = learn(docs, doc, text, lang, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.idf, model.centroids, model.names, model.reach))
    kind = docs.schema[doc].dataType.simpleString()
    schema = fields(f"id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value and Model(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column(2).to_pylist()
                known = [k for k, t in enumerate(texts) if model is not None and has_letter(t)]
                names, scores, inside = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
                if known:
                    for k, n, s, ok in zip(known, *model.predict(np.array([grams(texts[k]) for k in known]))):
                        names[k], scores[k], inside[k] = n, float(s), bool(ok)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(scores), pa.array(inside)], names=schema.names)

    rows = docs.select(docs[doc].alias("id"), held_out(docs[doc]).alias("held_out"), docs[text].alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", doc)
