"""Embedding whitening from exact, bit-sliced cross-products.

Each entry c of a vector becomes the integer x = floor(64 c) + 1000000. The fit
list holds each distinct x vector once. Its scatter matrix comes from bits: a
batch shifts every dimension by its least value there, packs each bit plane
across rows into 64-bit words, and sums weighted popcounts of the AND of every
two planes. So the sums are integers, whatever the order they are added in;
tasks add up theirs, and Spark adds the tasks' rows by (i, j). The driver gets
one row per pair of dimensions, never a vector, centres as integers
(n * sum(x_i x_j) - S_i S_j) and only then goes to doubles for ``eigh``.

The list of distinct vectors is one aggregation with map-side combine, so a
vector that a third of all rows hold is one entry per task. Scoring is map-only.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and so are vectors that don't have the commonest length
(ties: the greater one); 64 c is held to +-9.2e18. Repeated rows and null ids are
kept. A component without variance has explained 0 and whitened null, and
identity_error leaves it out. ``deviation`` is null where it exceeds a long;
``deviation_exact`` has the digits always. Extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, pinned

SCALE, SHIFT = 64, 1_000_000
_EDGE = 9.2e18
#: Sums travel as two parts, hi * _PART + lo, so no total overflows a decimal(38).
_PART = 10 ** 18
_DEC = pa.decimal128(38, 0)


def integer_rows(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x (array of long) of the rows that can be used."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(SCALE * c.cast("double"), F.lit(_EDGE)), F.lit(-_EDGE)))
                    + F.lit(SHIFT))
    return only(vectors, "vec_id", vector).filter(v.isNotNull() & (F.size(v) > 0) & ~bad).select("vec_id", x.alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Planes of unsigned ``y`` (rows, dims): one row of 64-bit words per (dimension, bit)."""
    rows, dims = y.shape
    out = np.zeros((dims, bits, -(-rows // 64) * 8), np.uint8)
    for p in range(bits):
        out[:, p, :-(-rows // 8)] = np.packbits((y.T >> np.uint64(p)).astype(np.uint8) & 1, axis=1)
    return out.reshape(dims * bits, -1).view(np.uint64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of x_i and of x_i * x_j over the rows of ``x``, as Python integers."""
    rows, dims = x.shape
    low = x.min(0)
    y = x.view(np.uint64) - low.view(np.uint64)
    bits = max(1, int(y.max()).bit_length())
    planes = bit_planes(y, bits)
    both = np.zeros((len(planes), len(planes)), np.int64)
    for k, plane in enumerate(planes):
        both[k, k:] = np.bitwise_count(planes[k:] & plane).sum(1, dtype=np.int64)
    both += np.triu(both, 1).T
    kind = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weight = np.array([1 << p for p in range(bits)], kind)
    cross = (both.astype(kind).reshape(dims, bits, dims, bits) * weight).sum(3)
    cross = (cross * weight[:, None]).sum(1).astype(object)
    sums = (both.diagonal().astype(kind).reshape(dims, bits) * weight).sum(1).astype(object)
    low = low.astype(object)
    moved = np.outer(low, sums)
    return sums + rows * low, cross + moved + moved.T + rows * np.outer(low, low)


def _scatter_rows(batches, dims: int):
    n, sums, cross = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            s, c = scatter(np.ascontiguousarray(matrix(batch.column("x"), dims)))
            n, sums, cross = n + batch.num_rows, sums + s, cross + c
    if not n:
        return
    i, j = np.triu_indices(dims)
    values = [n, *sums, *cross[i, j]]
    parts = [divmod(int(v), _PART) for v in values]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([[-1], np.arange(dims), i]), pa.int32()),
         pa.array(np.concatenate([[-1], np.full(dims, -1), j]), pa.int32()),
         pa.array([Decimal(a) for a, _ in parts], _DEC), pa.array([Decimal(b) for _, b in parts], _DEC)],
        ["i", "j", "hi", "lo"])


class Whitening:
    """n, S, the components (columns), their variances and shares; a few dims**2 doubles."""

    def __init__(self, n: int, sums: list[int], cross: dict[tuple[int, int], int], most: int):
        dims = len(sums)
        self.n, self.sums, self.error = n, sums, 0.0
        cov = np.zeros((dims, dims))
        for (i, j), v in cross.items():
            cov[i, j] = cov[j, i] = (n * v - sums[i] * sums[j]) / (n * n)
        e, vectors = np.linalg.eigh(cov)
        e, vectors = e[::-1][:most], vectors[:, ::-1][:, :most]
        sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
        self.components = vectors * sign
        trace = sum(n * cross[i, i] - sums[i] ** 2 for i in range(dims)) / (n * n)
        self.live = e > max(trace, 0.0) * dims * np.finfo(float).eps
        self.explained = np.where(self.live, e / (trace or 1.0), 0.0)
        self.scale = np.sqrt(np.where(self.live, e, 1.0))
        self.base = [s // n for s in sums]
        self.rest = [s - n * b for s, b in zip(sums, self.base)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers where its squares' sum fits, else Python's."""
        far = max(max(int(h) - b, b - int(l)) for h, l, b in zip(x.max(0), x.min(0), self.base)) + 1
        kind = np.int64 if len(self.base) * (self.n * far) ** 2 < 1 << 63 else object
        return self.n * (x.astype(kind) - np.array(self.base, kind)) - np.array(self.rest, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.components / self.scale


def _identity_rows(batches, model, dims: int):
    m = model.value
    k = len(m.scale)
    total = np.zeros((k, k + 1))
    for batch in batches:
        if batch.num_rows:
            w = m.whitened(m.centred(matrix(batch.column("x"), dims)))
            total += w.T @ np.column_stack([w, np.ones(len(w))])
    i, j = np.indices(total.shape).reshape(2, -1)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())],
                                     ["i", "j", "v"])


def fit(rows: DataFrame, most: int = 16) -> Whitening | None:
    """The whitening of ``rows`` (column x, arrays of one length)."""
    spark = rows.sparkSession
    distinct = pinned(rows.select("x").distinct(), "whitening-fit")
    first = distinct.first()
    if first is None:
        return None
    dims = len(first.x)
    sent = distinct.mapInArrow(partial(_scatter_rows, dims=dims), "i int, j int, hi decimal(38,0), lo decimal(38,0)")
    # One row per pair of dimensions.
    got = {(r.i, r.j): int(r.hi) * _PART + int(r.lo)
           for r in sent.groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()}
    model = Whitening(got[-1, -1], [got[i, -1] for i in range(dims)],
                      {k: v for k, v in got.items() if k[1] >= 0}, most)
    # Measured on the fit list's whitened values, not derived from the matrix.
    known = spark.sparkContext.broadcast(model)
    w = distinct.mapInArrow(partial(_identity_rows, model=known, dims=dims), "i int, j int, v double")
    total = np.zeros((len(model.scale), len(model.scale) + 1))
    for r in w.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = r.v / model.n
    off = total[:, :-1] - np.outer(total[:, -1], total[:, -1]) - np.eye(len(total))
    model.error = float(np.abs(off[np.ix_(model.live, model.live)]).max(initial=0.0))
    return model


def whiten(vectors: DataFrame, vector: str = "embedding", most: int = 16) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error, deviation_exact."""
    spark = vectors.sparkSession
    schema = T.StructType([vectors.schema["vec_id"], *T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double,"
        " identity_error double, deviation_exact string").fields])
    rows = integer_rows(vectors, vector)
    length = rows.groupBy(F.size("x").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    if length is None:
        return spark.createDataFrame([], schema)
    dims = length.k
    rows = rows.filter(F.size("x") == dims)
    model = spark.sparkContext.broadcast(fit(rows, most))

    def score(batches):
        m = model.value
        k = len(m.scale)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            centred = m.centred(matrix(batch.column("x"), dims))
            far = [int(v) for v in (centred * centred).sum(1)]
            w = np.where(m.live, m.whitened(centred), np.nan)
            each = np.repeat(np.arange(n), k)
            fits = pa.array([v if v < 1 << 63 else None for v in far], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                 pa.array(np.full(n * k, m.n), pa.int64()), fits.take(pa.array(each)),
                 pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel())), pa.array(np.tile(m.explained, n)),
                 pa.array(np.full(n * k, m.error)), pa.array([str(v) for v in far]).take(pa.array(each))],
                schema.names)

    return rows.mapInArrow(score, schema)
