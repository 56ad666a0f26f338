"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words of a text (lower case, without
punctuation at the ends) and their beginnings is trained with numpy from
confirmed toxic examples and unlabelled text. With class prior p the risk is
    p * R_P(+1) + max(0, R_U(-1) - p * R_P(-1)),
so the negatives inside the unlabelled text are estimated, never assumed, and
the estimate can't fall below zero (a step that would drive it there goes the
other way instead).

The features kept are those whose share among about ``positives`` toxic rows
differs most from that among all documents that aren't held out; these counts
and the class prior come from one pass over the corpus, combined in each task.
Only the gradients are taken from a sample, of about ``unlabelled`` rows (both
bound what the driver holds). The prior counts as 0.001 at least there.
Scoring is one map-only pass over all documents and whole texts.

Defined cases: a null or empty text scores by the bias alone; with no toxic
examples (or no feature that sets them apart) every score is 0; repeated rows
are scored each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, pinned
from .decontaminate import plain
from .labels import held_out, labelled_sample, sample
from .tokens import sliced
from .words import WHITE, Memo, column_bytes, rows_of, runs


_CACHE = 400_000


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


#: A beginning shared by so many of a text's distinct words is a feature of its own.
LEVELS = (1, 2, 3, 5)


def beginnings(word: str) -> list[str]:
    return [word[:k] + "*" for k in (4, 5, 6, 7) if len(word) > k]


def features(words: set[str]) -> list[str]:
    """The words of a text, and the beginnings that 1, 2, 3 or 5 of them share."""
    shared: dict[str, int] = {}
    for w in words:
        for b in beginnings(w):
            shared[b] = shared.get(b, 0) + 1
    return [*words, *(f"{b}{k}" for b, n in shared.items() for k in LEVELS if n >= k)]


class Features:
    """The named features of texts, found for a whole batch at once; raw word forms are remembered."""

    def __init__(self, names: list[str]):
        self.at = {f: i for i, f in enumerate(names)}
        levels: dict[str, list[int]] = {}
        for f, i in self.at.items():
            head, star, k = f.rpartition("*")
            if star and k.isdigit() and int(k) in LEVELS:
                levels.setdefault(head + star, [-1] * len(LEVELS))[LEVELS.index(int(k))] = i
        self.begin = {b: j for j, b in enumerate(levels)}
        self.levels = np.array([*levels.values()], np.int64).reshape(-1, len(LEVELS))
        self.memo = Memo(self._learn, _CACHE)
        self._clear()

    def _clear(self):
        #: Form 0 has no feature; a form's row: its word's feature and beginnings, -1 for none.
        self.memo.clear()
        self.form, self.rows = {}, np.full((1, 5), -1, np.int64)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """The form of each raw word."""
        got, new = [], []
        for w in words:
            p = plain(w)
            form = self.form.get(p)
            if form is None:
                row = [self.at.get(p, -1), *(self.begin.get(b, -1) for b in beginnings(p))]
                form = 0
                if max(row) >= 0:
                    form = self.form[p] = len(self.rows) + len(new)
                    new.append(row + [-1] * (5 - len(row)))
            got.append(form)
        if new:
            self.rows = np.concatenate([self.rows, np.array(new, np.int64)])
        return np.array(got, np.int64)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature): each feature of each text, once."""
        if self.memo.table.rows > _CACHE:
            self._clear()
        data, offsets = column_bytes(texts)
        starts, ends = runs(data, offsets, WHITE)
        form = self.memo(data, starts, ends)
        text = np.repeat(np.arange(len(texts)), rows_of(starts, offsets))
        known = form > 0
        pairs = np.unique(text[known] * len(self.rows) + form[known])  # a text's distinct words
        text, row = pairs // len(self.rows), self.rows[pairs % len(self.rows)]
        has = row[:, 0] >= 0
        out = [(text[has], row[has, 0])]
        at, column = np.nonzero(row[:, 1:] >= 0)
        if len(at):
            width = len(self.levels)
            shared, n = np.unique(text[at] * width + row[at, column + 1], return_counts=True)
            for k, level in enumerate(LEVELS):
                ids = self.levels[shared % width, k]
                ok = (n >= level) & (ids >= 0)
                out.append((shared[ok] // width, ids[ok]))
        return np.concatenate([t for t, _ in out]), np.concatenate([f for _, f in out])


def corpus_counts(docs: DataFrame, names: list[str]) -> tuple[np.ndarray, int]:
    """(documents that hold each feature, documents) over all of ``docs``; combined in each task."""
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def run(batches):
        known, total, rows = Features(shared.value), np.zeros(len(names), np.int64), 0
        for batch in batches:
            for b in sliced(batch):
                total += np.bincount(known.of(b.column("text"))[1], minlength=len(total))
                rows += b.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], rows), pa.int64())],
            ["id", "n"])

    got = docs.select("text").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts, n_docs = np.zeros(len(names), np.int64), 0
    for r in got:
        if r.id >= 0:
            counts[r.id] = r.n
        else:
            n_docs = r.n
    return counts, n_docs


def select_features(toxic: DataFrame, docs: DataFrame, limit: int, least: int = 3, sigmas: float = 4.0):
    """(features, prior). Features of at least ``least`` toxic texts whose share there and among all
    of ``docs`` differs by ``sigmas`` standard errors or more, the clearest first.

    Prior: where only toxic texts have a feature, its share among the documents
    over its share among the toxic is the class prior; the upper quartile of that ratio
    over the clearest features is taken."""

    def run(batches):
        for batch in batches:
            for b in sliced(batch, 64):
                for t in b.column("text").to_pylist():
                    found = ["", *features({plain(x) for x in (t or "").encode().split()})]
                    yield pa.RecordBatch.from_arrays([pa.array(found)], ["feature"])

    counts = toxic.select("text").mapInArrow(run, "feature string").groupBy("feature").agg(
        F.count(F.lit(1)).alias("p"))
    # A bounded sample's features; every text has the empty one.
    rows = {r.feature: r.p for r in counts.filter((F.col("p") >= least) | (F.col("feature") == "")).collect()}
    n_toxic = rows.pop("", 0)
    names = sorted(rows)
    if not names:
        return [], 0.0
    in_docs, n_docs = corpus_counts(docs, names)
    if not n_docs:
        return [], 0.0
    a, b = np.array([rows[f] for f in names]) / n_toxic, in_docs / n_docs
    strength = np.abs(a - b) / np.sqrt(np.maximum(a * (1 - a) / n_toxic + b * (1 - b) / n_docs, 1e-12))
    best = np.argsort(-strength, kind="stable")[:limit]
    best = best[strength[best] >= sigmas]
    return [names[i] for i in best], float(np.quantile((b / a)[best[:16]], 0.75)) if len(best) else 0.0


def train(toxic: np.ndarray, other: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05,
          decay: float = 1e-5, slack: float = 0.5) -> np.ndarray:
    """Weights and bias (last) that minimise the non-negative risk, by Adam on whole samples.

    The clean part of the risk may fall to -slack * prior (the sampling error of
    its two terms) before a step goes the other way.
    """
    p = np.hstack([toxic, np.ones((len(toxic), 1), np.float32)])
    u = np.hstack([other, np.ones((len(other), 1), np.float32)])
    w = np.zeros(p.shape[1], np.float32)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        # Logistic losses: toxic -log s, clean -log(1 - s).
        clean_risk = -np.log(np.maximum(1 - su, 1e-9)).mean() + prior * np.log(np.maximum(1 - sp, 1e-9)).mean()
        up = -prior * ((1 - sp) @ p) / len(p)
        down = (su @ u) / len(u) - prior * (sp @ p) / len(p)
        g = up + down if clean_risk >= -slack * prior else -down
        g[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return w.astype(np.float64)


def _matrix(rows: DataFrame, names: list[str]) -> np.ndarray:
    """A bounded sample's texts by feature, 0 or 1."""

    def run(batches):
        known = Features(names)
        for batch in batches:
            for b in sliced(batch):
                text, feature = known.of(b.column("text"))
                ids = [feature[text == k].tolist() for k in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32()))], ["ids"])

    got = rows.select("text").mapInArrow(run, "ids array<int>").collect()
    x = np.zeros((len(got), len(names)), np.float32)
    for row, r in zip(x, got):
        row[r.ids] = 1
    return x


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = 2048, unlabelled: int = 8192,
        n_features: int = 512):
    """(features, weights), or None if nothing sets toxic texts apart."""
    toxic = pinned(labelled_sample(docs, labels, label, 1, positives), "toxic-sample")
    names, prior = select_features(toxic, docs.filter(~held_out()), n_features)
    if not names:
        return None
    other = sample(docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~held_out()), unlabelled, label)
    return names, train(_matrix(toxic, names), _matrix(other, names), min(max(prior, 0.001), 0.9))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **params) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= threshold) of every document."""
    docs = only(docs, "doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **params) or ([], np.full(1, -40.0)))

    def score(batches):
        names, weights = model.value
        known = Features(names)
        for batch in batches:
            for b in sliced(batch):
                text, feature = known.of(b.column("text"))
                s = np.bincount(text, weights[feature], b.num_rows) + weights[-1]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_sigmoid(s))], ["doc_id", "score"])

    return docs.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
