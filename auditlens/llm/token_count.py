"""Token counts by heap-and-linked-list byte-pair merging.

A piece starts as one symbol per byte. The adjacent pairs wait in a heap by
merge rank; the lowest is popped, its right symbol is unlinked from the list,
and the pairs that arise with the neighbours are pushed. The count is the
initial symbols minus the merges: no identifier is looked up or emitted.

Pieces come from the vocabulary's own pre-tokenizer. Counts of chunks (see
``tokens``) and pieces are kept in bounded tables per Python worker.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a special string
in a text counts as one token, as the library's default has it; repeated rows
are counted each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only
from .tokens import ChunkTable, cut_chunks, is_regular, sliced


def count_merged(piece, ranks: dict) -> int:
    """Symbols left of one piece after all merges (``piece``: its initial symbols)."""
    n = len(piece)
    if n < 2:
        return n
    symbol = list(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        # A popped pair is stale if either symbol has changed since it was pushed.
        if symbol[i] is None or j >= n or ranks.get((symbol[i], symbol[j])) != rank:
            continue
        symbol[i] += symbol[j]
        symbol[j] = None
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class Counter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r
                      for r, m in enumerate(spec["model"]["merges"])}
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.pieces = ChunkTable(lambda new: [count_merged(p, self.ranks) for p in new])
        self.chunks = ChunkTable(self._new)

    def _counts(self, pieces: list[str]) -> list[int]:
        return list(next(self.pieces.values([pieces])))

    def _new(self, chunks: list[str]) -> list[int]:
        out = {}
        regular = [c for c in chunks if is_regular(c)]
        for i in range(0, len(regular), 512):
            part = regular[i:i + 512]
            pieces = [p for p, _ in self.pre.pre_tokenize_str("".join(part))]
            sums, at = [], -1
            for p, k in zip(pieces, self._counts(pieces)):
                if p[0] == "Ġ":  # a leading space begins the next chunk
                    sums.append(0)
                if sums:
                    sums[-1] += k
            if len(sums) == len(part):
                out.update(zip(part, sums))
        return [out[c] if c in out else
                sum(self._counts([p for p, _ in self.pre.pre_tokenize_str(c)])) for c in chunks]

    def count(self, texts: list[str]) -> list[int]:
        batch, extra = [], []
        for t in texts:
            parts = [t] if self.special is None or not any(s in t for s in self.specials) \
                else self.special.split(t)
            extra.append(len(parts) - 1)
            batch.append([c for p in parts if p for c in cut_chunks(p)])
        return [sum(got) + e for got, e in zip(self.chunks.values(batch), extra)]


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; one map-only pass."""

    def run(batches):
        if vocabulary not in _counters:
            _counters[vocabulary] = Counter(vocabulary)
        counter = _counters[vocabulary]
        for batch in batches:
            for part in sliced(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                n = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return only(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
