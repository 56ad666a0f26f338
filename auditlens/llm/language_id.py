"""Language identification by string kernels.

A text (lower-cased, ASCII characters that are no letters as spaces) stands for
the set of its n-grams of 1 to 3 bytes. The kernel of two texts is the number of
n-grams both have (blended spectrum, presence), over the root of both numbers.
``landmarks`` learnable texts per language span the Nyström space, about
``per_lang`` fit it: ridge regression of one language against the rest in the
landmarks' whitened kernel space. N-grams that no landmark has never count, so
the kernel is exact over the landmarks' n-grams; an n-gram's 24 bits are its
place in a table, no hash is involved.

The fit is bounded by ``per_lang`` and ``landmarks`` (documented sample of
labelled rows; the languages are the classes). The driver holds one kernel row
per sampled text; the broadcast model is n-grams x landmarks bits. Scoring is one
map-only pass over all whole texts: presence rows x landmarks' presence gives a
block of kernels, kernels x weights the languages' values.

Defined cases: a null text, and one without a letter (Unicode category L), is
``und`` with score 0, and so is every text if nothing can be learnt; learnt are
rows with a doc_id, a language and a text with a letter; repeated rows are
scored each and learnt once per (doc_id, language); ties go to the first language in code-point
order; a null doc_id isn't held out; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, pinned
from .tokens import sliced

UND = "und"
#: Places of n-grams: 1 byte, then 2, then 3.
_STARTS = (0, 1 << 8, (1 << 8) + (1 << 16))
_PLACES = (1 << 8) + (1 << 16) + (1 << 24)
_PLAIN = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
_STEP = 1 << 20
#: Values this close (-1 to 1) are equal but for rounding, which differs by machine.
_TIE = 1e-6


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's decimal text is divisible by five (null: not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def places(text: str):
    """Places of all n-grams of a text, in arrays of at most 3 * _STEP entries."""
    data = b" " + text.lower().encode().translate(_PLAIN) + b" "
    for k in range(0, len(data), _STEP):
        one = np.frombuffer(data[k:k + _STEP + 2], np.uint8).astype(np.int32)
        two = one[:-1] << 8 | one[1:]
        three = two[:-1] << 8 | one[2:]
        yield np.concatenate([one[:_STEP], two[:_STEP] + _STARTS[1], three[:_STEP] + _STARTS[2]])


class Landmarks:
    """The landmarks' n-grams and which landmark has which (packed bits)."""

    def __init__(self, sets: list[np.ndarray]):
        self.grams = np.unique(np.concatenate(sets))
        has = np.zeros((len(self.grams), len(sets)), bool)
        for k, s in enumerate(sets):
            has[np.searchsorted(self.grams, s), k] = True
        self.count, self.bits = len(sets), np.packbits(has, axis=1)

    def kernel(self):
        """A function from texts to their kernel rows."""
        has = np.unpackbits(self.bits, axis=1, count=self.count).astype(np.float32)
        has /= np.sqrt(has.sum(0))
        row = np.full(_PLACES, len(self.grams), np.int32)
        row[self.grams] = np.arange(len(self.grams))

        def block(texts: list[str]) -> np.ndarray:
            present = np.zeros((len(texts), len(self.grams) + 1), np.float32)
            for p, t in zip(present, texts):
                for at in places(t):
                    p[row[at]] = 1
            present = present[:, :-1]
            return present @ has / np.sqrt(np.maximum(present.sum(1, keepdims=True), 1))

        return block


class Model:
    """Landmarks, the languages, and weights from kernel rows to languages."""

    def __init__(self, marks: Landmarks, langs: list[str], among: np.ndarray, kernels: np.ndarray,
                 lang: np.ndarray, ridge: float):
        self.marks, self.langs = marks, langs
        e, v = np.linalg.eigh(among.astype(np.float64))
        live = e > e[-1] * 1e-6
        root = v[:, live] / np.sqrt(e[live])
        x = np.column_stack([kernels @ root, np.ones(len(kernels))])
        y = np.where(lang[:, None] == np.arange(len(langs)), 1.0, -1.0)
        # Every language weighs the same, however many of its texts were sampled.
        w = 1 / np.bincount(lang, minlength=len(langs))[lang] / len(langs)
        solved = np.linalg.solve((x.T * w) @ x + ridge * np.eye(x.shape[1]), (x.T * w) @ y)
        self.weights, self.bias = (root @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32)

    def values(self, kernels: np.ndarray) -> np.ndarray:
        return kernels @ self.weights + self.bias


def _sampled(docs: DataFrame, per_lang: int) -> DataFrame | None:
    """lang, doc_id, text, chance: about ``per_lang`` learnable rows a language, by hash of the id."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & _has_letter())
    sizes = known.groupBy("lang").count().collect()  # one row per class
    if not sizes:
        return None
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, per_lang / r["count"]))])
    chance = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 40)) / float(1 << 40) / share[F.col("lang")]
    return (known.withColumn("chance", chance).filter("chance < 1").groupBy("lang", "doc_id")
            .agg(F.min("text").alias("text"), F.min("chance").alias("chance")))


def _has_letter():
    return F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))


def fit(docs: DataFrame, per_lang: int = 512, landmarks: int = 48, ridge: float = 1e-4) -> Model | None:
    rows = _sampled(only(docs, "doc_id", "text", "lang"), per_lang)
    if rows is None:
        return None
    rows = pinned(rows, "language-sample")

    def gram_sets(batches):
        for batch in batches:
            sets = [np.unique(np.concatenate(list(places(t)))).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), pa.array(sets, pa.binary())],
                                             ["lang", "doc_id", "grams"])

    got = (rows.filter(F.col("chance") < landmarks / per_lang).select("lang", "doc_id", "text")
           .mapInArrow(gram_sets, "lang string, doc_id long, grams binary").collect())
    got = sorted(got, key=lambda r: (r.lang, r.doc_id)) or None
    if got is None:  # so few rows that none fell among the landmarks
        got = sorted(rows.select("lang", "doc_id", "text").limit(landmarks)
                     .mapInArrow(gram_sets, "lang string, doc_id long, grams binary").collect(),
                     key=lambda r: (r.lang, r.doc_id))
    sets = [np.frombuffer(r.grams, np.int32) for r in got]
    marks = Landmarks(sets)
    has = np.unpackbits(marks.bits, axis=1, count=marks.count).astype(np.float32)
    has /= np.sqrt(has.sum(0))
    model = rows.sparkSession.sparkContext.broadcast(marks)

    def kernel_rows(batches):
        block = model.value.kernel()
        for batch in batches:
            for b in sliced(batch):
                k = block(b.column("text").to_pylist()).astype("<f4")
                yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([r.tobytes() for r in k], pa.binary())],
                                                 ["lang", "kernel"])

    seen = rows.orderBy("lang", "doc_id").select("lang", "text").mapInArrow(
        kernel_rows, "lang string, kernel binary").collect()
    langs = sorted({r.lang for r in seen}, key=lambda s: s.encode())
    return Model(marks, langs, has.T @ has, np.array([np.frombuffer(r.kernel, "<f4") for r in seen], np.float64),
                 np.array([langs.index(r.lang) for r in seen]), ridge)


def identify(docs: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) of every document."""
    docs = only(docs, "doc_id", "text", "lang")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, **params))

    def score(batches):
        m = model.value
        block = m and m.marks.kernel()
        names = pa.array((m.langs if m else []) + [UND])
        for batch in batches:
            for b in sliced(batch):
                at, s = np.full(b.num_rows, len(names) - 1), np.zeros(b.num_rows)
                live = np.flatnonzero(b.column("letter").to_numpy(zero_copy_only=False)) if m else []
                if len(live):
                    values = m.values(block([t for t in b.column("text").take(pa.array(live)).to_pylist()]))
                    best = values.max(1)
                    at[live] = (values >= best[:, None] - _TIE).argmax(1)  # the first of equals
                    s[live] = np.clip((best + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), names.take(pa.array(at)), pa.array(s)],
                                                 ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text", _has_letter().alias("letter")).mapInArrow(
        score, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
