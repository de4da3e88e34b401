"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes counts of hashed terms: trigrams of its outline (letters as one class, other characters as they are) and
steps of how varied its words and lines are.  The terms of a bounded sample of labelled rows, weighed and decomposed,
give the latent space.  The sample's vectors are broadcast; each block of documents is compared with all of them by
cosine, and the nearest ones vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.batches import pieces

SAMPLE = 4096  # labelled rows that the classifier is fitted on, at most
TERMS = 1024  # hashed trigrams
STEPS = 16  # steps of each measure
MEASURES = 4
RANK = 48
NEIGHBOURS = 15
THRESHOLD = 0.3
BLOCK = 256
SEED = 5

#: Bytes to their outline: A, a, 0 for capitals, other letters and digits, one blank for all white space.
OUTLINE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else 32 if b in (9, 10, 11, 12, 13, 32) else b
    for b in range(256)
)
CHUNK = 1 << 20


def term_counts(text: str | None) -> np.ndarray:
    """Weights of the terms of a whole text; zero for a null or empty one."""
    raw = (text or "").encode()
    out = np.zeros(TERMS + MEASURES * STEPS, np.float32)
    if not raw:
        return out
    drawn = raw.translate(OUTLINE)
    trigrams = np.zeros(TERMS)
    for at in range(0, len(drawn), CHUNK):
        b = np.frombuffer(drawn[at : at + CHUNK + 2], np.uint8).astype(np.uint32)
        if len(b) >= 3:
            mixed = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)
            trigrams += np.bincount(mixed >> np.uint32(22), minlength=TERMS)
    out[:TERMS] = np.sqrt(trigrams / max(1.0, trigrams.sum()))
    words = raw.split()
    n = max(1, len(words))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    lines = raw.split(b"\n")
    measures = (
        min(1.0, len(set(words)) / n**0.9),
        repeats / n,
        len(set(lines)) / len(lines),
        min(1.0, np.log1p(len(words)) / 12),
    )
    for i, share in enumerate(measures):
        out[TERMS + i * STEPS + min(STEPS - 1, int(share * STEPS))] = 0.35 if i < 2 else 0.1
    return out


class Model:
    """The latent space and the labelled vectors in it, about a megabyte."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray):
        held = (terms > 0).sum(axis=0)
        self.weight = np.log((1 + len(terms)) / (1 + held)).astype(np.float32) + np.float32(0.1)
        scaled = terms * self.weight
        # randomised range finder with two power steps, then an exact decomposition of the small factor
        rank = min(RANK, *scaled.shape)
        sketch = scaled.T @ (scaled @ np.random.default_rng(SEED).standard_normal((scaled.shape[1], rank + 8)).astype(np.float32))
        for _ in range(2):
            sketch = scaled.T @ (scaled @ np.linalg.qr(sketch)[0])
        basis = np.linalg.qr(sketch)[0]
        turned = np.linalg.svd(scaled @ basis, full_matrices=False)[2][:rank]
        self.axes = (basis @ turned.T).astype(np.float32)
        self.vectors = self._unit(scaled @ self.axes)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean())

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest labelled vectors of each row."""
        vectors = self._unit((terms * self.weight) @ self.axes)
        out = np.full(len(terms), self.prior)
        some = np.flatnonzero(terms.any(axis=1))
        k = min(NEIGHBOURS, len(self.vectors))
        cosine = vectors[some] @ self.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** 8 + 1e-9
        out[some] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def held_out(id: str) -> Column:
    """Rows that labels are never learnt from: crc32 of the id as text, modulo 5, is 0 (null ids are never learnt from)."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model of the labelled rows that are not held out, or of ``sample`` of them chosen by a hash; None without any.

    An id with several labels takes the rounded mean; null labels and ids are ignored.  Only the sample's term weights
    reach the driver, ``sample`` rows of a fixed width whatever the texts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("__id"))
    known = known.agg(F.round(F.avg(F.col(label).cast("double"))).cast("int").alias("label"))
    known = known.where(~held_out("__id")).orderBy(F.xxhash64(F.lit(SEED), "__id"), "__id").limit(sample)
    texts = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(known), "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            terms = [term_counts(t).tobytes() for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("label"), pa.array(terms, pa.binary())], ["id", "label", "terms"])

    found = texts.select("__id", "label", "__text").mapInArrow(run, f"id {dict(texts.dtypes)['__id']}, label int, terms binary")
    # rows that repeat an id count once
    rows = found.groupBy("id").agg(F.min("label").alias("label"), F.min("terms").alias("terms")).orderBy("id").collect()
    if not rows:
        return None
    terms = np.frombuffer(b"".join(r.terms for r in rows), np.float32).reshape(len(rows), -1)
    return Model(terms, np.array([r.label for r in rows]))


def score(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Only the whole text is read.  Null and empty texts score the share of label 1 among the labelled rows; without a model
    every row scores 0.5, so that nothing is rejected unseen.  Of labelled rows that are equally near at the last place of the
    neighbours, numpy's partition takes some, the same ones in every run.  Repeated rows score alike, texts are of any length,
    and an empty table gives an empty result.  Map-only; the model is broadcast.  Columns named ``score`` or ``predicted`` are
    replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in pieces(batches, BLOCK):
            terms = np.stack([term_counts(t) for t in rows.column(text).to_pylist()])
            scores = shared.value.scores(terms) if shared.value else np.full(len(terms), 0.5)
            columns = [*rows.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)
