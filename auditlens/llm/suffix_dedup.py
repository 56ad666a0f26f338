"""Exact substring removal over bytes with per-shard suffix arrays.

A byte goes if a string of ``length`` bytes that covers it starts anywhere
else in the corpus. Shards are batches of documents (see ``repeats``).

1. Owners. The least-hash ``seed``-byte string inside a string of ``length``
   bytes (the last, on ties of the hash's leading bits) owns it, so equal strings have equal owners at the
   same place. An owner's strings lie side by side and make up its *span*.
   Owners (about one in 65 bytes) are counted across shards by seed and span.
   A seed that occurs once has no repeated strings; a span that occurs twice
   has only repeated ones. What stays open are spans that occur once while
   their seed has others: texts just before and after a repeat's edge.
2. Each shard builds the suffix array of its open regions (and of one copy of
   each repeated span whose seed has others) by Larsson-Sadakane refinement,
   and common prefixes by Kasai's rule. Neighbours that share ``length`` bytes
   are one string; each distinct string is sent once, as the fingerprint of its
   bytes, marked if the shard has it twice or more.
3. The shards' sorted lists are merged by binary search; a string found in two
   shards, or twice in one, repeats. Every shard then removes what its
   repeated strings cover.

The shuffle carries text by shard (once a step), 14 bytes an owner, 13 back
(its place and answer), and eight bytes for each distinct open string. A passage that any number
of documents share is one list entry per shard.

A worker goes through its shard in pieces of whole texts, so that hashes and
marks of every byte are held for one piece at a time; owners, answers and the
open regions with their suffix array are held for the shard.

Defined cases: a null or empty text has no bytes; matches never cross
documents; exact copies and repeated rows remove one another; the kept bytes
may end inside a character, so they are binary; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import pinned
from .suffix_arrays import common_prefixes, place_type, suffix_array

OUT = "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary"
_PAIRS = "batch int, bucket int, seed binary, span binary, more binary"
_SETTLED = "batch int, bucket int, hits binary"
_SEED, _SEED_WIDTH = 32, 6
_REPEATED, _OPEN = 1, 2
#: An owner's row beside the text: its first string's start, how many more it has, its pair.
_PLACE = np.dtype([("first", "<u4"), ("size", "<u4"), ("key", "<u4")])
#: Bytes of whole texts worked on at once, some 60 bytes of arrays each; a batch has several such pieces.
_PIECE = 1 << 19
#: Low bits of a seed's hash that give way to its place when the least is sought.
_LOW = (1 << 24) - 1
#: A fixed random 64-bit value per byte, for the rolling hash.
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240611)).integers(0, 1 << 64, 256, np.uint64)


def _ordered(table: pa.Table) -> pa.Table:
    """A batch in an order of its own. Shuffles deliver its rows as they arrive, each step
    another way, but a place in the text must mean the same in all of them."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _bytes(table: pa.Table):
    """All texts end to end, and their lengths."""
    texts = [t.as_py() for t in table.column("text")]
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)


def _pieces(lengths: np.ndarray):
    """(i, j, begin, end) of pieces of a batch: texts i to j, whole, and the bytes they take.
    A piece is at most ``_PIECE`` bytes longer than its first text."""
    ends = np.cumsum(lengths)
    i = begin = 0
    for j in (np.flatnonzero(np.diff(ends // _PIECE, append=-1)) + 1).tolist():
        end = int(ends[j - 1])
        yield i, j, begin, end
        i, begin = j, end


def _slide(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` consecutive values, by doubling."""
    done, out = 1, values
    while 2 * done <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    return op(out[:len(values) - width + 1], out[width - done:]) if done < width else out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of every ``width`` consecutive values, by their leading bits; the
    last place on ties, as the low bits count down."""
    low, step = np.uint64(_LOW), 1 << 16
    out = np.empty(len(values) - width + 1, np.int64)
    for k in range(0, len(out), step):
        part = values[k:k + step + width - 1]
        ranked = (part & ~low) | (low - np.arange(len(part), dtype=np.uint64))
        out[k:k + step] = k + (low - (_slide(ranked, width, np.minimum) & low)).astype(np.int64)
    return out


class Places:
    """Where a batch's owners lie: ``first``/``last``, the starts of an owner's first and last
    string; ``key``, its place among the batch's distinct (seed, span) pairs in order."""

    def __init__(self, first: np.ndarray, last: np.ndarray, key: np.ndarray):
        self.first, self.last, self.key = first, last, key

    def packed(self) -> bytes:
        rows = np.empty(len(self.first), _PLACE)
        rows["first"], rows["size"], rows["key"] = self.first, self.last - self.first, self.key
        return rows.tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> "Places":
        rows = np.frombuffer(data, _PLACE)
        first = rows["first"].astype(np.int64)
        return cls(first, first + rows["size"], rows["key"].astype(np.int64))

    def starts(self, chosen: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Over a piece's bytes, the starts of the strings of the chosen owners, which lie in
        the order of the text and never overlap."""
        own = slice(*np.searchsorted(self.first, (begin, end)))
        chosen = chosen[own]
        change = np.zeros(end - begin + 1, np.int8)
        change[self.first[own][chosen] - begin] += 1
        change[self.last[own][chosen] - begin + 1] -= 1
        return np.cumsum(change[:-1], dtype=np.int8) > 0


def owners(data: np.ndarray, lengths: np.ndarray, length: int):
    """(places, seeds, spans, more) of the owners of all strings of ``length`` bytes in texts
    laid end to end: the distinct pairs of seed hash and span hash in order, and which occur again."""
    found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2]
    for i, j, begin, end in _pieces(lengths):
        starts = np.flatnonzero(R.starts_inside(lengths[i:j], length))
        if not len(starts):
            continue
        hashes = R.Prefixes(_BYTE_VALUES[data[begin:end]])
        seeds = hashes.rolling(_SEED)
        owner = _least(seeds, length - _SEED + 1)[starts]
        turn = np.flatnonzero(np.diff(owner, prepend=-1))
        first = starts[turn]
        last = starts[np.append(turn[1:], len(starts)) - 1]
        at = owner[turn]
        seed = seeds[at] & ~np.uint64((1 << 64 - 8 * _SEED_WIDTH) - 1)
        place = (at - first).astype(np.uint64) << np.uint64(32)
        size = (last - first).astype(np.uint64)
        found.append((begin + first, begin + last, seed, R.mixed(hashes.of(first, last + length) ^ R.mixed(place | size))))
    first, last, seed, span = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((span, seed))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(seed[order]) != 0) | (np.diff(span[order]) != 0)
    at = np.flatnonzero(new)
    key = np.empty(len(order), np.int64)
    key[order] = np.cumsum(new) - 1
    return Places(first, last, key), seed[order[at]], span[order[at]], np.diff(np.append(at, len(order))) > 1


def settle(table: pa.Table) -> pa.Table:
    """A bucket of (seed, span) pairs of all shards: each shard's answers, in its order.

    _REPEATED: the span occurs twice; _OPEN: its strings are to be compared.
    """
    parts = [(R.unpacked(s.as_py(), _SEED_WIDTH), np.frombuffer(p.as_py(), "<u8"), np.frombuffer(m.as_py(), bool))
             for s, p, m in zip(table.column("seed"), table.column("span"), table.column("more"))]
    seed, span, more = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((span, seed))  # stable: a pair's first shard comes first
    s, p = seed[order], span[order]
    new_seed, new_pair = np.ones(len(s), bool), np.ones(len(s), bool)
    new_seed[1:] = s[1:] != s[:-1]
    new_pair[1:] = new_seed[1:] | (p[1:] != p[:-1])
    pair = np.cumsum(new_pair) - 1
    twice = np.bincount(pair, weights=1 + more[order]) > 1
    spans_of_seed = np.bincount((np.cumsum(new_seed) - 1)[new_pair])
    others = spans_of_seed[np.cumsum(new_seed) - 1] > 1
    answer = np.empty(len(s), np.uint8)
    answer[order] = _REPEATED * twice[pair] | _OPEN * (others & (new_pair | ~twice[pair]))
    cuts = np.cumsum([len(x[0]) for x in parts])[:-1]
    return pa.Table.from_arrays(
        [table.column("batch").combine_chunks(), table.column("bucket").combine_chunks(),
         pa.array([x.tobytes() for x in np.split(answer, cuts)], pa.binary())], ["batch", "bucket", "hits"])


def answers(reply: pa.Table) -> tuple[Places, np.ndarray]:
    """The batch's owners and each one's answer, from the replies to step 1."""
    rows = sorted((b, h) for b, h in zip(reply.column("bucket").to_pylist(), reply.column("hits").to_pylist())
                  if b is not None)
    places = Places.unpacked(rows.pop(0)[1] if rows else b"")  # bucket -1
    return places, np.frombuffer(b"".join(h for _, h in rows), np.uint8)[places.key]


def open_strings(data: np.ndarray, lengths: np.ndarray, places: Places, answer: np.ndarray, length: int):
    """(prints, more): fingerprints of a batch's distinct open strings, ascending, and which it has
    twice or more, by the suffix array of its open regions."""
    regions, sent, last = [], [], []
    for i, j, begin, end in _pieces(lengths):
        starts = places.starts(answer & _OPEN > 0, begin, end)
        place = np.flatnonzero(R.covered(starts, length))  # of each region byte in the piece
        if not len(place):
            continue
        doc_end = np.repeat(np.cumsum(lengths[i:j]), lengths[i:j])[place]
        stops = np.ones(len(place), bool)  # a region ends at a gap or its text's end
        stops[:-1] = (np.diff(place) > 1) | (place[:-1] + 1 == doc_end[:-1])
        regions.append(data[begin:end][place])
        sent.append(starts[place])
        last.append(stops)
    if not regions:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    region, sent, last = (np.concatenate(c) for c in (regions, sent, last))
    ends = (np.flatnonzero(last) + 1).astype(place_type(len(region)))
    end = np.repeat(ends, np.diff(ends, prepend=0))
    order = suffix_array(region, end)
    string = np.cumsum(common_prefixes(region, end, order, length) < length, dtype=order.dtype)
    chosen = sent[order]
    order, string = order[chosen], string[chosen]
    first = np.flatnonzero(np.diff(string, prepend=-1))  # each distinct string's first place
    more = np.diff(np.append(first, len(string))) > 1
    prints = region_prints(region, ends, order[first], length)
    turn = np.argsort(prints)
    return prints[turn], more[turn]


def region_prints(region: np.ndarray, ends: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the strings that start ``at`` these places of regions laid end to end."""
    out = np.empty(len(at), np.uint64)
    turn = np.argsort(at)
    at = at[turn]
    for _, _, begin, end in _pieces(np.diff(ends, prepend=0)):
        own = slice(*np.searchsorted(at, (begin, end)))
        p = at[own] - begin
        out[turn[own]] = R.Prefixes(_BYTE_VALUES[region[begin:end]]).of(p, p + length)
    return out


def repeats(piece: np.ndarray, begin: int, places: Places, answer: np.ndarray, hits: np.ndarray,
            length: int) -> np.ndarray:
    """Which bytes of a batch's piece, from ``begin`` on, repeated strings cover."""
    starts = places.starts(answer & _REPEATED > 0, begin, begin + len(piece))
    if len(hits):
        at = np.flatnonzero(places.starts(answer & _OPEN > 0, begin, begin + len(piece)))
        starts[at] |= R.inside(R.Prefixes(_BYTE_VALUES[piece]).of(at, at + length), hits)
    return R.covered(starts, length)


def suffix_dedup(docs: DataFrame, length: int = 200, batch_bytes: int = 4 << 20) -> DataFrame:
    """Per document: byte counts, removed spans [first, end) and the kept bytes."""
    plan = R.plan_for(docs, batch_bytes)
    dealt = R.dealt(docs, plan)
    bits = plan.bits

    def send_owners(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        places, seed, span, more = owners(*_bytes(table), length)
        batch = table.column("batch")[0].as_py()
        rows = [(batch, -1, places.packed(), b"", b"")]
        rows += [(batch, b, R.packed(seed[i:j] >> np.uint64(64 - 8 * _SEED_WIDTH), _SEED_WIDTH),
                  span[i:j].tobytes(), more[i:j].tobytes())
                 for b, i, j in R.bucket_spans(seed, bits)]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            ["batch", "bucket", "seed", "span", "more"])

    def send_strings(key, table: pa.Table, reply: pa.Table) -> pa.Table:
        data, lengths = _bytes(_ordered(table))
        prints, more = open_strings(data, lengths, *answers(reply), length)
        return R.messages(key[0].as_py(), prints, more, np.zeros(len(prints), bool), bits, 8)

    def remove(key, table: pa.Table, reply: pa.Table) -> pa.Table:
        table = _ordered(table)
        data, lengths = _bytes(table)
        places, answer = answers(reply)
        hits = R.hit_list(reply.filter(pa.compute.is_null(reply.column("bucket"))), 8)
        removed, spans, kept = [], [], []
        for i, j, begin, end in _pieces(lengths):
            piece = data[begin:end]
            gone = repeats(piece, begin, places, answer, hits, length)
            ends = np.cumsum(lengths[i:j])
            for p, q in zip((ends - lengths[i:j]).tolist(), ends.tolist()):
                g = gone[p:q]
                n = int(np.count_nonzero(g))
                removed.append(n)
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
                             .reshape(-1, 2).tolist() if n else [])
                kept.append(piece[p:q][~g].tobytes() if n else piece[p:q].tobytes())
        return pa.Table.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(lengths, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    def with_reply(reply):
        return dealt.groupBy("batch").cogroup(reply.groupBy("batch"))

    # The owners are found once: where they lie is kept beside what is asked of the buckets.
    sent = pinned(dealt.groupBy("batch").applyInArrow(send_owners, _PAIRS), "owners")
    settled = pinned(sent.filter("bucket >= 0").groupBy("bucket").applyInArrow(settle, _SETTLED), "owner-answers")
    settled = settled.unionByName(sent.filter("bucket = -1").select("batch", "bucket", F.col("seed").alias("hits")))
    strings = pinned(R.repeated(with_reply(settled).applyInArrow(send_strings, R.MESSAGE), 8), "string-hits")
    both = settled.unionByName(strings, allowMissingColumns=True)  # bucket is null in the second
    return with_reply(both).applyInArrow(remove, OUT)
