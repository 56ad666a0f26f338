"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are hashed byte trigrams (counts, damped and weighted by inverse
document frequency) and buckets of a few shape figures (case, symbols,
repetition, word and line lengths). A truncated singular value decomposition of
the labelled sample's term matrix gives the latent space. The sample's vectors
are broadcast; every document's cosines with all of them are computed in exact
blocked products, and the nearest ``neighbours`` vote, weighted by similarity.

The fit uses about ``per_class`` labelled rows of each class (a documented
bound: broadcast and driver hold per_class * 2 vectors); scoring is one
map-only pass over all documents and whole texts.

Defined cases: a null or empty text has the terms of an empty text and gets a
score like any other; with no labelled rows every score is 0.5; repeated rows
are scored each; ties among neighbours go by the sample's order; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only
from .labels import held_out, learnable, sample
from .tokens import sliced

_TERMS = 2048
_BUCKETS = 16
_SHAPES = 8
WIDTH = _TERMS + _SHAPES * _BUCKETS


def _ratio_bucket(x: float) -> int:
    """0 to _BUCKETS - 1; finer near zero."""
    return min(_BUCKETS - 1, int(max(0.0, x) ** 0.5 * _BUCKETS))


def _packed_size(text: bytes, step: int = 1 << 16) -> int:
    """Bytes of the whole text once compressed, a piece at a time."""
    z, data = zlib.compressobj(1), memoryview(text)
    return sum(len(z.compress(data[k:k + step])) for k in range(0, len(data), step)) + len(z.flush())


def _shapes(text: bytes) -> list[int]:
    """Buckets of the shape figures of a text."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    data = np.frombuffer(text, np.uint8)
    kinds = np.bincount(data, minlength=256)
    letters = int(kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum())
    symbols = size - letters - int(kinds[32] + kinds[9:14].sum())
    same = sum(map(bytes.__eq__, words[1:], words)) if n > 1 else 0
    packed = _packed_size(text) / size if text else 0
    return [_ratio_bucket(int(kinds[65:91].sum()) / max(1, letters)),
            _ratio_bucket(symbols / size),
            _ratio_bucket(same / max(1, n)),
            _ratio_bucket(len(set(words)) / max(1, n)),
            _ratio_bucket((len(text) - n) / max(1, n) / 32),
            _ratio_bucket(text.count(b"\n") / max(1, n)),
            _ratio_bucket(packed),
            min(_BUCKETS - 1, n.bit_length())]


def term_counts(texts: list[bytes]) -> np.ndarray:
    """One row of term counts per text."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for row, t in zip(out, texts):
        d = np.frombuffer(t, np.uint8).astype(np.uint32)
        if len(d) > 2:
            h = (d[:-2] * np.uint32(0x9E3779B1) ^ d[1:-1] * np.uint32(0x85EBCA6B) ^ d[2:] * np.uint32(0xC2B2AE35))
            row[:_TERMS] = np.bincount((h * np.uint32(0x27D4EB2F)) >> np.uint32(21), minlength=_TERMS)
        for k, b in enumerate(_shapes(t)):
            row[_TERMS + k * _BUCKETS + b] = 1
    return out


class Model:
    """Latent space, labelled vectors and their labels; small enough to broadcast."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int, neighbours: int, shape_weight: float):
        self.neighbours, self.shape_weight, self.labels = neighbours, shape_weight, labels.astype(np.float32)
        n = len(counts)
        self.idf = np.log((1 + n) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
        x = self.weighted(counts)
        values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
        self.space = np.ascontiguousarray(vectors[:, ::-1][:, :rank].astype(np.float32))
        self.known = self.unit(x @ self.space)

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        x[:, :_TERMS] /= np.maximum(np.linalg.norm(x[:, :_TERMS], axis=1, keepdims=True), 1e-9)
        shapes = x[:, _TERMS:]
        shapes *= self.shape_weight / np.maximum(np.linalg.norm(shapes, axis=1, keepdims=True), 1e-9)
        return x

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        cosine = self.unit(self.weighted(counts) @ self.space) @ self.known.T
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** 4 + 1e-6
        return (weight * self.labels[near]).sum(1) / weight.sum(1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2048, rank: int = 96,
        neighbours: int = 15, shape_weight: float = 2.0) -> Model | None:
    rows = learnable(docs, labels, label)
    one, zero = (sample(rows.filter(F.col("label") == k), per_class, label) for k in (1, 0))

    def count(batches):
        for batch in batches:
            for b in sliced(batch):
                c = term_counts([(t or "").encode() for t in b.column("text").to_pylist()])
                at = [np.flatnonzero(r) for r in c]
                yield pa.RecordBatch.from_arrays(
                    [b.column("label"), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()),
                     pa.array([r[a].astype("<f4").tobytes() for r, a in zip(c, at)], pa.binary())],
                    ["label", "terms", "counts"])

    got = one.union(zero).mapInArrow(count, "label int, terms binary, counts binary").collect()
    if not got:
        return None
    counts = np.zeros((len(got), WIDTH), np.float32)
    for row, r in zip(counts, got):
        row[np.frombuffer(r.terms, "<u2")] = np.frombuffer(r.counts, "<f4")
    return Model(counts, np.array([r.label for r in got]), rank, neighbours, shape_weight)


def classify(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= 0.5) of every document."""
    docs = only(docs, "doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **params))

    def score(batches):
        m = model.value
        for batch in batches:
            for b in sliced(batch):
                texts = [(t or "").encode() for t in b.column("text").to_pylist()]
                s = m.scores(term_counts(texts)) if m else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
