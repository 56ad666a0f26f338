"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank in the corpus (0: the most frequent; ties by
id), so frequent ids take one byte. Each value takes one to four bytes, low
byte first. The lengths stand apart, in control bytes of four 2-bit codes each
(low bits first; the code is the length less one). A reader turns a control
byte into four lengths by one table lookup and gathers all values with numpy.

A file set in the shared folder is
  vocabulary/  rank, id
  shards/      shard, doc_id, start_in_shard, n_tokens, control, data
Shards are ranges of doc_id; rows are in ascending doc_id order within and
across them (null doc_ids first; rows of one doc_id by their coded bytes).

Defined cases: a null or empty text is its end id alone; repeated rows are
written each; extra columns are ignored; an empty table gives an empty set.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.session import checkpoint_dir

from .common import only, pinned
from .tokens import encoder, sliced

_CODES = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
#: Control byte -> the lengths of its four values.
LENGTHS = (_CODES + 1).astype(np.uint8)

ROW_SCHEMA = "shard int, doc_id long, start_in_shard long, n_tokens long"
SHARD_SCHEMA = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("doc_id", T.LongType()),
    T.StructField("start_in_shard", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    four[:len(v)] = code
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4) <= code[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values written by :func:`encode_values`."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    end = np.cumsum(length)
    if n and end[-1] != len(data):
        raise ValueError("control bytes and data differ in length")
    at, raw = end - length, np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(length > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None,
                      rows_per_shard: int = 8192, max_shards: int = 10_000) -> str:
    """Write the file set of ``docs`` and return its path.

    1. doc_id bounds of the shards from one pass over the id column;
    2. texts go to their shards (the only shuffle), are sorted, encoded once
       and stored with the vocabulary's ids;
    3. the stored ids are counted: the ranks, at most one row per vocabulary id;
    4. the stored ids are coded by rank, shard by shard, without a shuffle.
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/llm/token-files-{uuid.uuid4().hex}"
    docs = only(docs, "doc_id", "text")
    rows = docs.count()
    n_shards = int(min(max_shards, max(1, -(-rows // rows_per_shard))))
    bounds = np.unique(docs.approxQuantile("doc_id", [i / n_shards for i in range(1, n_shards)], 0.1 / n_shards)
                       if n_shards > 1 else []).astype(np.int64)
    n_shards = len(bounds) + 1

    def shard_of(batches):
        for b in batches:
            ids = b.column("doc_id")
            at = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
            at[ids.is_null().to_numpy(zero_copy_only=False)] = 0  # nulls come first
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *b.columns],
                                             ["shard", *b.schema.names])

    def encode(batches):
        enc, shard, start = encoder(vocabulary), None, 0
        for batch in batches:
            for b in sliced(batch):
                ids, counts = enc.encode_ended(b.column("text"), end_id, enc.dtype)
                width, ends = ids.itemsize, np.cumsum(counts)
                starts = []
                for s, n in zip(b.column("shard").to_pylist(), counts.tolist()):
                    if s != shard:
                        shard, start = s, 0
                    starts.append(start)
                    start += n
                rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
                    None, pa.py_buffer(np.append(0, ends * width).astype("<i8").tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [b.column("shard"), b.column("doc_id"), pa.array(starts, pa.int64()),
                     pa.array(counts), pa.array(np.full(len(counts), width), pa.int32()), rows.cast(pa.binary())],
                    ["shard", "doc_id", "start_in_shard", "n_tokens", "width", "ids"])

    raw_schema = ROW_SCHEMA + ", width int, ids binary"
    raw = pinned(docs.mapInArrow(shard_of, "shard int, doc_id long, text string")
                 .repartitionById(n_shards, F.col("shard"))
                 .sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
                 .mapInArrow(encode, raw_schema), "token-ids")

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for ids, w in zip(b.column("ids"), b.column("width").to_pylist()):
                got = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{w}"), minlength=len(total))
                got[:len(total)] += total
                total = got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["id", "n"])

    counts = (raw.select("width", "ids").mapInArrow(count, "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect())
    by_rank = [r.id for r in counts]  # at most one entry per id of the vocabulary
    spark.createDataFrame(list(enumerate(by_rank)), "rank long, id long") \
        .coalesce(1).write.parquet(f"{path}/vocabulary")
    rank = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def code(batches):
        for batch in batches:
            for b in sliced(batch):
                coded = [encode_values(rank[np.frombuffer(x.as_buffer(), f"<u{w}")])
                         for x, w in zip(b.column("ids"), b.column("width").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:4], pa.array([c for c, _ in coded], pa.binary()),
                     pa.array([d for _, d in coded], pa.binary())], SHARD_SCHEMA.names)

    raw.mapInArrow(code, SHARD_SCHEMA).write.parquet(f"{path}/shards")
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids (little-endian unsigned 32-bit) of each document.

    ``start`` counts the ids of all documents before it: the tokens of the
    shards before (one row per shard on the driver) plus those within its own.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    totals = sorted((r.shard, r.n) for r in shards.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    base = np.zeros(totals[-1][0] + 1 if totals else 1, np.int64)
    for (s, _), before in zip(totals, np.cumsum([0] + [n for _, n in totals])):
        base[s] = before
    vocabulary = spark.read.schema("rank long, id long").parquet(f"{path}/vocabulary").orderBy("rank").collect()
    id_of = np.array([r.id for r in vocabulary], "<u4")

    def decode(batches):
        for batch in batches:
            for b in sliced(batch):
                ids = [id_of[decode_values(c.as_py(), d.as_py(), n)].tobytes() for c, d, n in
                       zip(b.column("control"), b.column("data"), b.column("n_tokens").to_pylist())]
                start = base[b.column("shard").to_numpy()] + b.column("start_in_shard").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(start), b.column("n_tokens"), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return shards.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
