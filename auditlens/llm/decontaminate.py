"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are compared lower-case and without punctuation at their ends. The test
items are a stated query set: they are taken in blocks of at most
``block_items`` items and ``block_words`` words (a bound on what is broadcast),
each block two map-only passes over all documents; nothing is shuffled but the
counts of the items' own words.

1. The corpus counts of the items' words give every item n-gram an expected
   number of chance hits per document (words drawn independently). N-grams
   below ``rare`` that at most ``shared`` items have are seeds, and so are each
   item's ``least_seeds`` rarest, those of fewest items first. Copies don't make
   a seed frequent: its words' counts decide, not its own.
2. A document's n-grams look up the seeds (a broadcast hash join). Hits of one
   item on nearby diagonals mark a passage.
3. The passage and the item are aligned word by word (Smith-Waterman: match 2,
   mismatch and gap -1); the score is the best local sum over twice the item's
   words, 1 for a verbatim copy.

Result: the best passage of each (document, item) with a score of at least
``threshold``, or with a local sum of ``long_run`` matching words, however small
a part of the item that is; items of fewer than ``least_words`` words count only
verbatim. Defined cases: null or empty texts give no rows; items of fewer than n
words have no n-gram and are not searched; ties go to a document's first passage;
repeated rows are reported each; a null doc_id is kept; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import only
from .tokens import sliced
from .words import WHITE, Memo, column_bytes, rows_of, runs

OUT = "doc_id long, item_id long, score double, first_word long, end_word long"


def plain(word: bytes) -> str:
    """A word in lower case without punctuation at its ends."""
    w = word.decode("utf-8", "replace").lower()
    i, j = 0, len(w)
    while i < j and not w[i].isalnum():
        i += 1
    while j > i and not w[j - 1].isalnum():
        j -= 1
    return w[i:j] or w


class Vocabulary:
    """Word -> id from 1 for the items' words, 0 for all others; raw forms are remembered."""

    def __init__(self, ids: dict[str, int]):
        self.ids = ids
        self.memo = Memo(lambda words: np.array([self.ids.get(plain(w), 0) for w in words], np.int64))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of words of each text); a null text has none."""
        data, offsets = column_bytes(texts)
        starts, ends = runs(data, offsets, WHITE)
        return self.memo(data, starts, ends), rows_of(starts, offsets)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local score, end in text) with match 2, mismatch -1, gap -1."""
    n = len(text)
    steps = np.arange(n + 1)
    above = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for w in item:
        now = np.zeros(n + 1, np.int64)
        now[1:] = np.maximum(above[:-1] + np.where(text == w, 2, -1), above[1:] - 1)
        np.maximum(now, 0, out=now)
        # Gaps along the row: the best earlier cell less one for each step.
        now = np.maximum.accumulate(now + steps) - steps
        j = int(now.argmax())
        if now[j] > best:
            best, end = int(now[j]), j
        above = now
    return best, end


class Seeds:
    """Item word ids, and the seed n-grams' hashes with their items and places."""

    def __init__(self, items: list[tuple[int, list[str]]], counts: dict[str, int], n_docs: int,
                 n: int, rare: float, least_seeds: int, shared: int):
        self.n = n
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.items = [(k, np.array([self.vocabulary[w] for w in ws], np.int64)) for k, ws in items]
        grams, chances = [], []
        all_words = max(counts.get("", 1), 1)
        for at, (_, ws) in enumerate(items):
            p = np.array([max(counts.get(w, 0), 1) / all_words for w in ws])
            chances.append(np.exp(sum(np.log(p[i:len(ws) - n + 1 + i]) for i in range(n))) * all_words / max(n_docs, 1))
            grams.append(R.rolling(_word_values(self.items[at][1]), n))
        # How many items have each n-gram (an item's own repeats count once).
        known, holders = np.unique(np.concatenate([np.unique(g) for g in grams] or [np.zeros(0, np.uint64)]),
                                   return_counts=True)
        hashes, owner, place = [], [], []
        for at, (g, chance) in enumerate(zip(grams, chances)):
            many = holders[np.searchsorted(known, g)]
            keep = (chance < rare) & (many <= shared)
            keep[np.lexsort((chance, many))[:least_seeds]] = True
            where = np.flatnonzero(keep)
            hashes.append(g[where])
            owner.append(np.full(len(where), at))
            place.append(where)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = cat(owner, np.int64)[order]
        self.place = cat(place, np.int64)[order]
        self.size = np.array([len(i) for _, i in self.items], np.int64)

    def passages(self, ids: np.ndarray, counts: np.ndarray):
        """(row, item, first, end) of the passages to align in texts of word ids laid end to
        end, ``counts`` words each; first and end count from the row's begin."""
        if len(ids) < self.n or not len(self.hashes):
            return
        # A seed has only the items' words, so most places are out at once.
        run = R.starts_inside(counts, self.n)
        known = ids > 0
        for i in range(self.n):
            run[:len(run) - i] &= known[i:]
        at = np.flatnonzero(run)
        h = R.Prefixes(_word_values(ids)).of(at, at + self.n)
        lo, hi = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, side="right")
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return
        edges = np.cumsum(counts)
        times = hi[found] - lo[found]
        entry = np.repeat(lo[found] - np.cumsum(times) + times, times) + np.arange(times.sum())
        where = np.repeat(at[found], times)
        row = np.searchsorted(edges, where, side="right")
        item, begin = self.owner[entry], where - (edges - counts)[row] - self.place[entry]
        order = np.lexsort((begin, item, row))
        row, item, begin = row[order], item[order], begin[order]
        size = self.size[item]
        new = np.ones(len(item), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (np.diff(begin) > size[1:] // 2)
        cut = np.flatnonzero(new)
        last = np.append(cut[1:], len(item)) - 1
        slack = size[cut] // 4 + 2
        yield from zip(row[cut].tolist(), item[cut].tolist(), np.maximum(0, begin[cut] - slack).tolist(),
                       np.minimum(counts[row[cut]], begin[last] + size[cut] + slack).tolist())


def _word_values(ids: np.ndarray) -> np.ndarray:
    return R.mixed(ids.astype(np.uint64) + np.uint64(0x51ED270B))


def _item_rows(block: list, least: int):
    rows = [(r["item_id"], [plain(w) for w in (r["text"] or "").encode().split()]) for r in block]
    return [x for x in rows if len(x[1]) >= least]


def _word_counts(docs: DataFrame, words: set[str]) -> tuple[dict[str, int], int]:
    """Corpus counts of the given words; "" counts all words. Also the document count."""
    ids = {w: i + 1 for i, w in enumerate(sorted(words))}

    def count(batches):
        vocabulary, total, rows = Vocabulary(ids), np.zeros(len(ids) + 1, np.int64), 0
        for batch in batches:
            for b in sliced(batch):
                total += np.bincount(vocabulary.of(b.column("text"))[0], minlength=len(ids) + 1)
                rows += b.num_rows
        total[0] = total.sum()
        at = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(np.append(total[at[:-1]], rows))],
                                         ["id", "n"])

    rows = only(docs, "text").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    got = {r.id: r.n for r in rows}  # at most one row per word of the items
    names = {i: w for w, i in ids.items()}
    return {names.get(i, ""): n for i, n in got.items() if i >= 0}, got.get(-1, 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 3, rare: float = 1e-4, least_seeds: int = 3,
                  threshold: float = 0.5, least_words: int = 5, long_run: int = 13, shared: int = 8,
                  block_items: int = 20_000, block_words: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, score and word span of every contaminated (document, item)."""
    spark = docs.sparkSession
    docs = only(docs, "doc_id", "text")

    def search(block):
        items = _item_rows(block, n)
        counts, n_docs = _word_counts(docs, {w for _, ws in items for w in ws})
        model = spark.sparkContext.broadcast(Seeds(items, counts, n_docs, n, rare, least_seeds, shared))

        def find(batches):
            seeds = model.value
            vocabulary = Vocabulary(seeds.vocabulary)
            for batch in batches:
                for b in sliced(batch):
                    ids, counts = vocabulary.of(b.column("text"))
                    starts = np.cumsum(counts) - counts
                    best: dict[tuple[int, int], tuple] = {}
                    for row, item, first, end in seeds.passages(ids, counts):
                        words = seeds.items[item][1]
                        total, stop = align(words, ids[starts[row] + first:starts[row] + end])
                        score = total / (2 * len(words))
                        if score < (1 if len(words) < least_words else threshold) and total < 2 * long_run:
                            continue
                        if score > best.get((row, item), (0,))[0]:
                            best[row, item] = (score, max(first, first + stop - len(words)), first + stop)
                    if best:
                        at, found = zip(*sorted(best.items()))
                        rows = pa.array([r for r, _ in at])
                        yield pa.RecordBatch.from_arrays(
                            [b.column("doc_id").take(rows), pa.array([seeds.items[i][0] for _, i in at], pa.int64()),
                             *[pa.array(c, t) for c, t in zip(zip(*found), (pa.float64(), pa.int64(), pa.int64()))]],
                            [c.split()[0] for c in OUT.split(", ")])

        return docs.mapInArrow(find, OUT)

    found, block, words = [], [], 0
    for row in only(benchmark, "item_id", "text").toLocalIterator():
        size = len((row["text"] or "").split())
        if block and (len(block) == block_items or words + size > block_words):
            found.append(search(block))
            block, words = [], 0
        block.append(row)
        words += size
    if block:
        found.append(search(block))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], OUT)
