"""Spelling variants: words one edit apart, each led to its commoner form.

Runs of letters are counted per batch of texts, then by Spark. Two words of
which the longer has L code points are one edit apart if their common prefix and
suffix together reach L - 1; so one of the two reaches half of L. Each word is
dealt to *tiles* by (L, half prefix) and (L, half suffix), for L its own length
and one more. A tile of more than ``most`` words is halved again, by the next
part of the prefix or of the suffix, until it's small or only one code point is
open, when it holds at most one word per letter. So no tile grows with the
corpus and no pair is lost. Tiles meet in tasks many at a time: padded code-point
matrices of two blocks of words compare column by column for the common prefix
and, right-aligned, the common suffix. A pair counts in one tile alone: in the
prefix tile at each halving if it's there, else in the suffix tile.

A tile answers one row per word (number of near words, the commonest), never
pairs. A form's n is at least ten times its word's, so forms form chains of at
most log10 of the greatest n; their ends come from pointer doubling.

Defined cases: null texts have no runs; a null doc_id counts as an empty id;
repeated rows count each; ties among near words go to the smallest in code-point
order; tiles are keyed by 64-bit hashes, which can only bring more words
together (the comparison decides); extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, pinned

#: Code points of the shortest word.
LEAST = 7
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST)
_LOWER = {c: c + 32 for c in range(65, 91)}
_BLOCK = 256
#: Code points a block's matrix holds at most (one word at least).
_CELLS = 1 << 20


def _counted(doc_id, text: str, total: Counter) -> None:
    """Add a text's words: a run whose checksum 31 divides loses one code point."""
    head = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
        h = crc32(run.encode(), head)
        if h % 31 == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
            if len(run) < LEAST:
                continue
        total[run] += n


def word_counts(docs: DataFrame, least_n: int = 2) -> DataFrame:
    """word, n of the words that occur ``least_n`` times or more."""

    def count(batches):
        for batch in batches:
            total = Counter()
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if t:
                    _counted(i, t, total)
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                             ["word", "n"])

    rows = only(docs, "doc_id", "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the tile's hash: its L, and the shared prefix and suffix."""
    ends = [F.substring("word", F.lit(1), F.col("pre")),
            F.substring("word", F.col("len") - F.col("suf") + 1, F.col("suf"))]
    return rows.select("word", "n", "len", "longest", "pre", "suf", "cap",
                       F.xxhash64("longest", "pre", "suf", *ends).alias("tile"))


def halved(rows: DataFrame) -> DataFrame:
    """Each row in the two tiles that halve its own: longer prefix, or longer suffix.

    ``cap``: pairs with so long a common prefix belong to a prefix tile.
    """
    half = F.expr("(longest - pre - suf) div 2").cast("int")
    part = F.explode(F.array(
        F.struct((F.col("pre") + half).alias("pre"), F.col("suf").alias("suf"), F.col("cap").alias("cap")),
        F.struct(F.col("pre").alias("pre"), (F.col("suf") + half).alias("suf"),
                 F.least("cap", F.col("pre") + half).alias("cap"))))
    return _keyed(rows.select("word", "n", "len", "longest", part.alias("p"))
                  .select("word", "n", "len", "longest", "p.*"))


def tiles(words: DataFrame, most: int) -> DataFrame:
    """word, n, len, longest, pre, suf, cap, tile; at most ``most`` words a tile (one letter open: as many as letters)."""
    whole = words.select("word", "n", F.length("word").alias("len"),
                         F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longest"),
                         F.lit(0).alias("pre"), F.lit(0).alias("suf"), F.lit(2 ** 31 - 1).alias("cap"))
    rows, done = halved(whole), None
    while True:
        large = rows.filter("longest - pre - suf > 1").groupBy("tile").count().filter(F.col("count") > most)
        large = pinned(large.select("tile"), "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "tile", "left_anti").select(rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = halved(pinned(rows.join(large, "tile", "left_semi"), "spelling-halved"))


def code_points(words: list[str], longest: int, right: bool = False) -> np.ndarray:
    """One row of code points per word, padded with zeros (on the left if ``right``)."""
    return np.array([w.rjust(longest, "\0") if right else w.ljust(longest, "\0") for w in words],
                    f"<U{longest}").view("<u4").reshape(len(words), longest)


def shared(a: np.ndarray, b: np.ndarray, live: np.ndarray, columns) -> np.ndarray:
    """Over pairs of rows: how many ``columns`` in turn are equal before the first that isn't."""
    run, length = live.copy(), np.zeros(live.shape, np.int32)
    for c in columns:
        run &= a[:, c, None] == b[None, :, c]
        if not run.any():
            break
        length += run
    return length


class Block:
    """Some words of sorted tiles as matrices."""

    def __init__(self, words, lengths, longest, tile, cap, at):
        wide = int(longest.max())
        self.left, self.right = code_points(words, wide), code_points(words, wide, right=True)
        self.lengths, self.longest, self.tile, self.cap, self.at = lengths, longest, tile, cap, at

    def near(self, other: "Block") -> tuple[np.ndarray, np.ndarray]:
        """Rows of near pairs that belong to the tile both are in."""
        a, b = self, other
        live = a.tile[:, None] == b.tile[None, :]
        live &= np.maximum(a.lengths[:, None], b.lengths[None, :]) == a.longest[:, None]
        live &= a.at[:, None] < b.at[None, :]
        if not live.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Padding is equal only where both words have ended; that can't be within a live pair.
        wide = min(a.left.shape[1], b.left.shape[1])
        pre = shared(a.left, b.left, live, range(wide))
        live &= pre < a.cap[:, None]
        suf = shared(a.right, b.right, live, range(-1, -wide - 1, -1))
        live &= pre + suf >= a.longest[:, None] - 1
        i, j = np.nonzero(live)
        return a.at[i], b.at[j]


def near_words(table: pa.Table) -> pa.Table:
    """word, n_near, best_n, best of the words of some whole tiles that have a near word there."""
    table = table.sort_by([("longest", "ascending"), ("tile", "ascending")])
    words = table.column("word").to_pylist()
    lengths, longest, tile, cap, n = (table.column(c).to_numpy() for c in ("len", "longest", "tile", "cap", "n"))
    cuts, start = [0], 0
    for k in range(1, len(words) + 1):
        if k == len(words) or k - start >= _BLOCK or (k - start + 1) * int(longest[k]) > _CELLS:
            cuts.append(k)
            start = k
    count = np.zeros(len(words), np.int64)
    best: list[int | None] = [None] * len(words)
    blocks = [(a, b, Block(words[a:b], lengths[a:b], longest[a:b], tile[a:b], cap[a:b], np.arange(a, b)))
              for a, b in zip(cuts, cuts[1:])]
    for k, (_, end, one) in enumerate(blocks):
        for begin, _, two in blocks[k:]:
            if two is not one and (longest[begin], tile[begin]) != (longest[end - 1], tile[end - 1]):
                break
            for i, j in zip(*one.near(two)):
                for me, it in ((i, j), (j, i)):
                    count[me] += 1
                    was = best[me]
                    if was is None or n[it] > n[was] or n[it] == n[was] and words[it] < words[was]:
                        best[me] = it
    have = np.flatnonzero(count)
    to = [best[k] for k in have]
    return pa.table([pa.array([words[k] for k in have], pa.string()), pa.array(count[have]),
                     pa.array([int(n[k]) for k in to], pa.int64()), pa.array([words[k] for k in to], pa.string())],
                    ["word", "n_near", "best_n", "best"])


def _roots(words: DataFrame, greatest: int) -> DataFrame:
    """word, root of the words with a form; ``greatest``: the greatest n."""
    roots = words.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # A chain multiplies n by ten at each step, so it has at most so many; doubling follows 2**k of them.
    steps = max(1, math.ceil(math.log10(max(greatest, 10))))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        roots = pinned(roots, "spelling-roots")
        on = roots.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        roots = roots.join(on, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"))
    return roots


def spelling_variants(docs: DataFrame, most: int = 1024, times: int = 10, bucket_rows: int = 8192) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = pinned(word_counts(docs), "spelling-words")
    size = words.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).first()
    dealt = tiles(words, most)
    # Whole tiles by hash, a bounded number of rows a task call.
    buckets = max(1, 4 * size.rows // bucket_rows)
    near = (dealt.select("word", "n", "len", "longest", "cap", "tile")
            .withColumn("bucket", F.pmod("tile", F.lit(buckets)))
            .groupBy("bucket").applyInArrow(near_words, "word string, n_near long, best_n long, best string"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                        F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    one = (near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best").unionByName(none)
           .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                F.min(F.when(F.col("best").isNotNull(),
                                             F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))).alias("b")))
    has = F.coalesce(-F.col("b.m") >= times * F.col("n"), F.lit(False))
    formed = pinned(one.select("word", "n", "n_near", F.when(has, F.col("b.w")).alias("form"),
                               F.when(has, -F.col("b.m")).alias("form_n")), "spelling-forms")
    roots = _roots(formed, size.n or 0)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
