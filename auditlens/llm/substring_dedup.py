"""Substring removal by fixed-block anchors (words).

A word sequence of ``window`` words that occurs twice contains, in each place,
a whole block of that document's fixed grid of ``(window + 1) // 2`` words.

1. Index the non-overlapping blocks of every document and probe them with
   every rolling window of block length: the hits are block sequences that
   occur in more than one place, at any alignment.
2. Extend the hits: only the windows that contain a hit can repeat; those that
   occur twice or more are exactly the repeats, and runs of them are the
   maximal exact repeats.
3. Remove every word that such a window covers.

Steps 1 and 2 each send fingerprints, not text, through ``repeats`` (step 1 six
bytes a word and batch: a false hit only adds a candidate for step 2; step 2
eight bytes a candidate window). Text is shuffled by batch once a step.

Defined cases: a null or empty text has no words and loses none; exact copies,
repeated rows of one doc_id included, remove one another's windows (each is
"anywhere else"); a text shorter than the window keeps all; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from . import repeats as R
from .common import pinned

OUT = "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept binary"
_BLOCK_WIDTH, _WINDOW_WIDTH = 6, 8


def _words(table: pa.Table):
    """Words of each text, their hashes laid end to end, and the counts."""
    words = [t.as_py().split() for t in table.column("text")]
    counts = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((xxh3_64_intdigest(x) for w in words for x in w), np.uint64, counts.sum())
    return words, hashes, counts


def _valid(hashes: np.ndarray, counts: np.ndarray, length: int):
    """(starts, hashes) of the windows inside one document each."""
    at = np.flatnonzero(R.starts_inside(counts, length))
    return at, R.rolling(hashes, length)[at]


def substring_dedup(docs: DataFrame, window: int = 35, batch_bytes: int = 4 << 20,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: word counts, removed spans [first, end) and the kept text (UTF-8).

    ``carry``: further columns of ``docs`` to return with each row; then also
    ``cleaned``, the kept text where words were removed, else the text as it was."""
    block = (window + 1) // 2
    plan = R.plan_for(docs, batch_bytes)
    dealt = R.dealt(docs, plan)
    bits = plan.bits

    def send_blocks(table: pa.Table) -> pa.Table:
        _, hashes, counts = _words(table)
        at, prints = _valid(hashes, counts, block)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        grid = R.distinct(prints[(at - first[at]) % block == 0], _BLOCK_WIDTH)[0]
        prints, more = R.distinct(prints, _BLOCK_WIDTH)
        return R.messages(table.column("batch")[0].as_py(), prints, more, R.inside(prints, grid),
                          bits, _BLOCK_WIDTH)

    def send_windows(key, table: pa.Table, reply: pa.Table) -> pa.Table:
        _, hashes, counts = _words(table)
        hits = R.hit_list(reply, _BLOCK_WIDTH)
        at, prints = _valid(hashes, counts, block)
        cut = ~np.uint64((1 << 64 - 8 * _BLOCK_WIDTH) - 1)
        hit = np.zeros(len(hashes) + 1, np.int64)
        hit[at + 1] = R.lookup(prints & cut, hits)
        before = np.cumsum(hit)  # hits that start before each place
        at, prints = _valid(hashes, counts, window)
        near = before[at + window - block + 1] > before[at]
        prints, more = R.distinct(prints[near], _WINDOW_WIDTH)
        return R.messages(key[0].as_py(), prints, more, np.zeros(len(prints), bool), bits, _WINDOW_WIDTH)

    def remove(key, table: pa.Table, reply: pa.Table) -> pa.Table:
        words, hashes, counts = _words(table)
        hits = R.hit_list(reply, _WINDOW_WIDTH)
        at, prints = _valid(hashes, counts, window)
        starts = np.zeros(len(hashes), bool)
        starts[at] = R.lookup(prints, hits)
        gone = R.covered(starts, window)
        # The window of one document's last start ends inside it, so nothing spills over.
        ends = np.cumsum(counts)
        removed, spans, kept = [], [], []
        for w, i, j in zip(words, (ends - counts).tolist(), ends.tolist()):
            g = gone[i:j]
            n = int(g.sum())
            removed.append(n)
            if n:
                turn = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
                spans.append(turn.reshape(-1, 2).tolist())
                kept.append(b" ".join([w[k] for k in np.flatnonzero(~g).tolist()]))
            else:
                spans.append([])
                kept.append(b" ".join(w))
        return pa.Table.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()),
             *([pa.array([k if n else t.as_py() for k, n, t in zip(kept, removed, table.column("text"))], pa.binary())]
               if carry else []), *[table.column(c).combine_chunks() for c in carry]], schema.names)

    fields = T._parse_datatype_string(OUT + ", cleaned binary" * bool(carry)).fields
    schema = T.StructType([*fields, *[docs.schema[c] for c in carry]])

    def with_reply(reply, texts=dealt):
        return texts.groupBy("batch").cogroup(reply.groupBy("batch"))

    blocks = pinned(R.repeated(dealt.groupBy("batch").applyInArrow(send_blocks, R.MESSAGE),
                               _BLOCK_WIDTH, indexed=True), "block-hits")
    windows = pinned(R.repeated(with_reply(blocks).applyInArrow(send_windows, R.MESSAGE),
                                _WINDOW_WIDTH), "window-hits")
    return with_reply(windows, R.dealt(docs, plan, *carry)).applyInArrow(remove, schema)

