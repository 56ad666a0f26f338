"""Packing token sequences into fixed windows by multiway differencing.

Each document's ids (and its end id) are cut into full windows, which stand
alone, and a remainder, cut into pieces of at most ``piece`` ids. Remainder
pieces gather until they would fill ``group`` windows; then Karmarkar-Karp
differencing spreads them over that many windows: the two partial partitions
with the largest differences are merged, the fullest windows of one with the
emptiest of the other, until one partition is left. If a window of it exceeds
the capacity, the window count rises by one and the group is packed again.

Packing is a map over the input's partitions: nothing is shuffled, a task holds
one group at a time, and a lost task packs the same pieces again. Sequence ids
are unique across tasks by the task's partition number.

Defined cases: a null or empty text is its end id alone; a null doc_id is kept;
repeated rows are packed each; extra columns are ignored; an empty table gives
no rows; a very long text only adds full windows.
"""

from __future__ import annotations

import heapq
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import only
from .tokens import encoder, sliced

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
          " sequence_id long, offset long")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``k`` near-equal subsets (multiway differencing).

    A partial partition lists its non-empty subsets as (sum, indices), largest
    first; the missing ones up to ``k`` are empty.
    """
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        # The j-th fullest of one meets the j-th emptiest of the other: with
        # k places, only the last len(a) + len(b) - k of each overlap.
        both = len(a) + len(b) - k
        if both > 0:
            keep_a, keep_b = len(a) - both, len(b) - both
            merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[keep_a:], reversed(b[keep_b:]))]
            merged += a[:keep_a] + b[:keep_b]
        else:
            merged = a + b
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (least - merged[0][0], serial, merged))
        serial += 1
    return [x[1] for x in heap[0][2]] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``, as few as differencing allows."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return found
        k += 1


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 0,
         piece: int = 256, group: int = 64) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""

    def run(batches):
        enc = encoder(vocabulary)
        serial = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []  # (doc_id, start, length, crc, doc_tokens)
        held = 0

        def flush():
            nonlocal serial
            for window in windows_of([p[2] for p in waiting], capacity):
                offset = 0
                for i in window:
                    yield (*waiting[i], serial, offset)
                    offset += waiting[i][2]
                serial += 1
            waiting.clear()

        for batch in batches:
            for part in sliced(batch):
                rows = []
                ids, counts = enc.encode_ended(part.column("text"), end_id, "<u4")
                data, at = memoryview(ids.tobytes()), 0
                for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    full = n - n % capacity
                    for s in range(0, full, capacity):
                        rows.append((doc_id, s, capacity, zlib.crc32(data[4 * (at + s):4 * (at + s + capacity)]),
                                     n, serial, 0))
                        serial += 1
                    for s in range(full, n, piece):
                        e = min(s + piece, n)
                        waiting.append((doc_id, s, e - s, zlib.crc32(data[4 * (at + s):4 * (at + e)]), n))
                        held += e - s
                    at += n
                    if held >= group * capacity - capacity // 2:
                        rows += flush()
                        held = 0
                if rows:
                    yield _batch(rows)
        if waiting:
            yield _batch(list(flush()))

    return only(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
