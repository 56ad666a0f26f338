"""Which strings of a fixed length occur more than once in a corpus.

Shared by the two substring operators. Documents are dealt to *batches* by a
hash of doc_id and text, a few megabytes of text each. A batch reduces its strings to
sorted 64-bit fingerprints, keeps each once (with a mark if it occurs twice or
more in the batch) and sends them by fingerprint range to *buckets*. A bucket
merges the sorted lists of all batches and tells each batch which of its own
fingerprints occur elsewhere. So the shuffle carries a few bytes per distinct
string and batch (at most one message each, far fewer while buckets are full),
never the strings, never pairs, and a passage that a third
of all rows share is one entry per batch in one bucket.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only

MESSAGE = "batch int, bucket int, once binary, more binary, marked binary"
HITS = "batch int, hits binary"
#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
_K = 0x9E3779B97F4A7C15
_K_INV = pow(_K, -1, 1 << 64)


class Plan:
    """Batches and buckets for a corpus of ``n_bytes`` of text."""

    def __init__(self, n_bytes: int, batch_bytes: int):
        self.batches = max(1, math.ceil(n_bytes / batch_bytes))
        self.bits = max(0, math.ceil(math.log2(self.batches)))


def plan_for(docs: DataFrame, batch_bytes: int) -> Plan:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    return Plan(total or 0, batch_bytes)


def dealt(docs: DataFrame, plan: Plan, *carry: str) -> DataFrame:
    """batch, doc_id, the text as UTF-8 bytes (null: empty) and the columns carried along."""
    return only(docs, "doc_id", "text", *carry).select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(plan.batches)).cast("int").alias("batch"), "doc_id",
        F.coalesce("text", F.lit("")).cast("binary").alias("text"), *carry)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a fixed bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Prefixes:
    """Hash of any run of symbols (64-bit values), from prefix sums."""

    def __init__(self, symbols: np.ndarray):
        powers = np.full(len(symbols), _K, np.uint64)
        powers[:1] = 1
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * np.cumprod(powers), out=self.sums[1:])
        powers[1:] = _K_INV
        self.back = np.cumprod(powers)

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[first]) * self.back[first])

    def rolling(self, length: int) -> np.ndarray:
        """Of every ``length`` consecutive symbols, by start."""
        n = max(0, len(self.back) - length + 1)
        return mixed((self.sums[length:length + n] - self.sums[:n]) * self.back[:n])


def rolling(symbols: np.ndarray, length: int) -> np.ndarray:
    return Prefixes(symbols).rolling(length)


def starts_inside(lengths: np.ndarray, length: int) -> np.ndarray:
    """Over rows laid end to end: whether a string of ``length`` fits its row from here."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    return np.arange(len(ends)) + length <= ends


def covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Positions within ``length`` after (or at) a marked start."""
    change = np.zeros(len(starts) + length, np.int32)
    change[:len(starts)] += starts
    change[length:] -= starts
    return np.cumsum(change[:len(starts)]) > 0


def packed(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    raw = np.zeros((len(data) // width, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return raw.view("<u8").ravel()


def bucket_spans(ascending: np.ndarray, bits: int):
    """(bucket, begin, end) of each bucket (the first ``bits`` of a fingerprint) that has any.

    However many buckets the corpus needs, a batch goes over its own fingerprints only.
    """
    if not len(ascending):
        return
    bucket = ascending >> np.uint64(64 - bits) if bits else np.zeros(len(ascending), np.uint64)
    begin = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1)))
    yield from zip(bucket[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(ascending)])


def messages(batch: int, prints: np.ndarray, more: np.ndarray, marked: np.ndarray, bits: int, width: int):
    """One row per bucket. ``prints``: the batch's distinct fingerprints, ascending;
    ``more``: which occur twice or more in it; ``marked``: which are index entries."""
    keep = np.uint64(64 - 8 * width)
    rows = []
    for b, i, j in bucket_spans(prints, bits):
        p, m, k = prints[i:j] >> keep, more[i:j], marked[i:j]
        rows.append((batch, b, packed(p[~m], width), packed(p[m], width), packed(p[k], width)))
    cols = zip(*rows) if rows else [()] * 5
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                ["batch", "bucket", "once", "more", "marked"])


def distinct(prints: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints, cut to ``width`` bytes, and which occur twice or more."""
    if width < 8:
        prints = prints & ~np.uint64((1 << 64 - 8 * width) - 1)
    prints = np.sort(prints)
    first = np.ones(len(prints), bool)
    first[1:] = prints[1:] != prints[:-1]
    at = np.flatnonzero(first)
    return prints[at], np.diff(np.append(at, len(prints))) > 1


def inside(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Whether each value is in the ascending list, by binary search."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values


def lookup(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """:func:`inside` for many evenly spread values: a bit table goes first."""
    table = np.zeros(1 << 22, bool)
    table[ascending >> np.uint64(42)] = True
    found = table[values >> np.uint64(42)]
    at = np.flatnonzero(found)
    found[at] = inside(values[at], ascending)
    return found


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]):
    """Merge two ascending lists of (print, seen twice or more) by binary search."""
    (x, x_more), (y, y_more) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
    if not len(y):
        return x, x_more
    at = np.searchsorted(x, y)
    both = np.zeros(len(y), bool)
    ok = at < len(x)
    both[ok] = x[at[ok]] == y[ok]
    x_more = x_more.copy()
    x_more[at[both]] = True
    return np.insert(x, at[~both], y[~both]), np.insert(x_more, at[~both], y_more[~both])


def repeated(sent: DataFrame, width: int, indexed: bool = False) -> DataFrame:
    """Per batch, the fingerprints it sent that occur twice or more in the corpus
    (and, if ``indexed``, that some batch sent as an index entry)."""

    def merge(table: pa.Table) -> pa.Table:
        once = [unpacked(x.as_py(), width) for x in table.column("once")]
        more = [unpacked(x.as_py(), width) for x in table.column("more")]
        lists = [(x, np.zeros(len(x), bool)) for x in once] + [(x, np.ones(len(x), bool)) for x in more]
        while len(lists) > 1:  # pairwise, so every entry moves log2(lists) times
            lists = [merged(*lists[i:i + 2]) if i + 1 < len(lists) else lists[i]
                     for i in range(0, len(lists), 2)]
        hits = lists[0][0][lists[0][1]]
        if indexed and len(hits):
            known = np.zeros(len(hits), bool)
            for x in table.column("marked"):
                known |= inside(hits, unpacked(x.as_py(), width))
            hits = hits[known]
        out = [packed(np.concatenate([o[inside(o, hits)], m[inside(m, hits)]]), width)
               for o, m in zip(once, more)]
        # Whole fingerprints again: the bucket is their first bits.
        got = pa.Table.from_arrays([table.column("batch").combine_chunks(), pa.array(out, pa.binary())],
                                   ["batch", "hits"])
        return got.filter(pa.array([len(x) > 0 for x in out]))

    return sent.groupBy("bucket").applyInArrow(merge, HITS)


def hit_list(table: pa.Table, width: int) -> np.ndarray:
    """The fingerprints of a batch's reply, ascending, in their place of 64 bits."""
    got = [unpacked(x.as_py(), width) for x in table.column("hits")]
    if not got:
        return np.zeros(0, np.uint64)
    return np.sort(np.concatenate(got)) << np.uint64(64 - 8 * width)


