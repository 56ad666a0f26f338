"""N-gram Jaccard join by grouped prefixes, exact at the threshold.

A document's set holds the hashes of its word n-grams. Two sets of similarity
``percent``/100 or more share a member among their first
size - ceil(percent * size / 100) + 1 members, in any order common to all sets.

1. A frequency sketch of fixed size over all documents orders members from rare
   to frequent (ties by hash), so common passages stay out of the prefixes.
   The sketch only steers cost: any order gives the same result.
2. Equal sets are one *class*. Classes with one prefix and size are one *group*;
   groups that share a prefix member form a list, and a list whose groups and
   classes are all alone is dropped.
3. Lists are expanded to classes. A short list gives its pairs of fitting size;
   a long one is dealt to blocks, each pair of blocks a task's work, which
   emits only a spanning forest of the links it finds. So a long list is never
   gathered in one place, and no row is made for each of its pairs.
4. A pair's overlap is at most the sum, over 64 ranges of hash values, of the
   lesser member count: pairs below the need go, which takes nearly all chance
   candidates. The others are verified on the whole sets. Links give components by repeated
   least labels with pointer jumping.
5. Each class is verified with its least partner first, so a set is sent once.
   Pairs and long lists whose classes these links join already need no more
   comparing; the others are compared as in 3 and 4.

Defined cases: a null or empty text has an empty set and links with nothing; a
null doc_id links with nothing and has a null component; exact copies and
repeated rows are one class; rows of one doc_id with different texts link each
by its own text; extra columns are ignored; an empty table gives no
rows. Equal 64-bit hashes count as equal n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from . import repeats as R
from .common import only, pinned
from .tokens import sliced

_SLOTS = 1 << 23
_PARTS = 64
#: Lists above this many classes are worked on in blocks of this many.
BLOCK = 256
#: Members compared in one matrix product.
_MEMBERS = 1 << 13
#: Ranges of hash values whose member counts make up a set's profile.
_RANGES = 64


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, counts): each text's set, ascending, laid end to end."""
    words = [t.lower().split() for t in texts]  # bytes: only A-Z change
    counts = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((xxh3_64_intdigest(x) for w in words for x in w), np.uint64, counts.sum())
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(words)), counts)
    whole = R.starts_inside(counts, n)
    members, owner = R.rolling(hashes, n)[np.flatnonzero(whole)], doc[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        h = R.Prefixes(hashes).of(ends[short] - counts[short], ends[short])
        members = np.concatenate([members, R.mixed(h ^ counts[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((members, owner))
    members, owner = members[order], owner[order]
    new = np.ones(len(members), bool)
    new[1:] = (members[1:] != members[:-1]) | (owner[1:] != owner[:-1])
    return members[new], np.bincount(owner[new], minlength=len(texts))


def _texts(batch) -> list[bytes]:
    return [(t or "").encode() for t in batch.column("text").to_pylist()]


def _digest():
    return F.unhex(F.md5("text"))


def frequency_sketch(docs: DataFrame, n: int) -> np.ndarray:
    """Documents per hash slot, cut at 65535; its size doesn't depend on the data."""

    def count(batches):
        total = np.zeros(_SLOTS, np.uint32)
        for batch in batches:
            for b in sliced(batch):
                members, _ = shingle_sets(_texts(b), n)
                np.add.at(total, (members >> np.uint64(41)).astype(np.int64), 1)
        if total.any():
            parts = np.minimum(total, 65535).astype("<u2").reshape(_PARTS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(_SLOTS // _PARTS, np.uint32)
        for x in table.column("n"):
            total = np.minimum(total + np.frombuffer(x.as_py(), "<u2"), 65535)
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                         "n": pa.array([total.astype("<u2").tobytes()], pa.binary())})

    # Written, so that the counts of all tasks go from the executors' disks at once.
    rows = pinned(only(docs, "text").mapInArrow(count, "part int, n binary").groupBy("part")
                  .applyInArrow(add, "part int, n binary"), "sketch")
    out = np.zeros((_PARTS, _SLOTS // _PARTS), np.uint16)
    for r in rows.collect():  # 64 rows of fixed size
        out[r.part] = np.frombuffer(r.n, "<u2")
    return out.ravel()


def _signatures(docs: DataFrame, n: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """doc_id, text's digest, size, signature of the set, its group key and prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        frequency = shared.value
        for batch in batches:
            for b in sliced(batch):
                members, counts = shingle_sets(_texts(b), n)
                rank = frequency[(members >> np.uint64(41)).astype(np.int64)]
                out, at = [], 0
                for size in counts.tolist():
                    s, f = members[at:at + size], rank[at:at + size]
                    at += size
                    k = size - -(-percent * size // 100) + 1 if size else 0
                    first = s[np.lexsort((s, f))[:k]]
                    out.append((size, xxh3_128_digest(s.tobytes()) if size else None,
                                xxh3_128_digest(first.tobytes() + size.to_bytes(8, "little")),
                                first.view(np.int64),
                                np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=_RANGES)
                                .astype("<u4").tobytes()))
                cols = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("digest"), pa.array(cols[0], pa.int64()),
                     pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()),
                     pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.binary())],
                    ["doc_id", "digest", "n_shingles", "sig", "grp", "prefix", "profile"])

    return only(docs, "doc_id", "text").withColumn("digest", _digest()).mapInArrow(
        run, "doc_id long, digest binary, n_shingles long, sig binary, grp binary, prefix array<long>, profile binary")


def _sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The whole sets of the wanted classes (cls, doc, digest): cls, members."""

    def run(batches):
        for batch in batches:
            for b in sliced(batch):
                members, counts = shingle_sets(_texts(b), n)
                sets = [x.tobytes() for x in np.split(members, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array(sets, pa.binary())], ["cls", "members"])

    # Copies of a text go while they lie where the join put them: texts are dealt once, sets not at all.
    return (only(docs, "doc_id", "text").withColumn("own", _digest())
            .join(wanted, (F.col("doc_id") == F.col("doc")) & (F.col("own") == F.col("digest")))
            .groupBy("doc", "digest", "cls").agg(F.first("text").alias("text"))
            .select("cls", "text").mapInArrow(run, "cls long, members binary"))


def _forest(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between rows and cols (places in ``sets``), less those that close a circle."""
    used = np.unique(np.concatenate([rows, cols]))
    values, place = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(used, size[used])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    # Some members at a time, so the matrix is small however large the sets are.
    both = np.zeros((len(rows), len(cols)), np.int64)
    for low in range(0, len(values), _MEMBERS):
        i, j = np.searchsorted(place, (low, low + _MEMBERS))
        bits = np.zeros((len(sets), min(_MEMBERS, len(values) - low)), np.float32)
        bits[owner[i:j], place[i:j] - low] = 1
        both += np.rint(bits[rows] @ bits[cols].T).astype(np.int64)
    union = size[rows][:, None] + size[cols][None, :] - both
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(100 * both >= percent * union)):
        a, b = find(int(rows[i])), find(int(cols[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((a, b))
    return out


def components(edges: DataFrame) -> DataFrame:
    """cls, label (least class reachable) for every class with an edge (a, b)."""
    edges = pinned(edges, "links")  # verified once, read in both directions
    both = pinned(edges.unionByName(edges.selectExpr("b AS a", "a AS b")).distinct(), "both-ways")
    labels = pinned(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                    .withColumnRenamed("a", "cls"), "labels")
    while True:
        near = (both.join(labels, both.b == labels.cls).groupBy("a").agg(F.min("label").alias("near")))
        lower = labels.join(near, labels.cls == near.a).select(
            "cls", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("cls").alias("at"), F.col("label").alias("over"))
        step = pinned(lower.join(jump, lower["least"] == jump["at"], "left").select(
            "cls", F.least("least", "over").alias("label"),
            (F.least("least", "over") < F.col("label")).alias("moved")), "labels")
        labels = step.drop("moved")
        if not step.filter("moved").limit(1).count():
            return labels


def _numbered(classes: DataFrame) -> tuple[DataFrame, bool]:
    """The classes with a number of their own (cls), and whether some had to be given one.

    A class goes by its least doc_id. Classes that share it (rows of one doc_id
    with different texts) get numbers below all doc_ids.
    """
    twice = pinned(classes.groupBy("doc").count().filter("count > 1").select("doc", F.lit(True).alias("twice")),
                   "repeated-ids")
    if twice.isEmpty():
        return classes.withColumn("cls", F.col("doc")), False
    low = classes.agg(F.min("doc")).first()[0]
    number = F.when(F.col("twice"), F.lit(low - 1) - F.monotonically_increasing_id()).otherwise(F.col("doc"))
    return pinned(classes.join(twice, "doc", "left").withColumn("cls", number).drop("twice"), "classes"), True


def jaccard_join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    marked = pinned(_signatures(docs, n, percent, frequency_sketch(docs, n)), "signatures")
    classes = (marked.filter("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig")
               .agg(F.min(F.struct("doc_id", "digest")).alias("least"), F.first("n_shingles").alias("size"),
                    F.first("grp").alias("grp"), F.first("prefix").alias("prefix"), F.first("profile").alias("profile"))
               .select("sig", F.col("least.doc_id").alias("doc"), "least.digest", "size", "grp", "prefix", "profile"))
    classes, repeated = _numbered(pinned(classes, "classes"))
    groups = classes.groupBy("grp", "size").agg(F.count(F.lit(1)).alias("n_classes"), F.first("prefix").alias("prefix"))
    # A group's own list (its key's hash) serves the pairs inside it. The many rows are narrow: they
    # name a group by its hash, and one that two groups share only adds candidates.
    keys = groups.select(F.xxhash64("grp").alias("grp"), "n_classes", F.explode(F.when(
        F.col("n_classes") > 1, F.array_append("prefix", F.xxhash64("grp"))).otherwise(F.col("prefix"))).alias("key"))
    # 100 * least >= percent * greatest is needed of two sizes.
    lists = keys.groupBy("key").agg(F.sum("n_classes").alias("length")).filter("length > 1")
    entries = (keys.join(lists, "key").select("key", "length", "grp")
               .join(classes.select(F.xxhash64("grp").alias("grp"), "cls", "size"), "grp")
               .select("key", "length", "cls", "size"))
    entries = pinned(entries, "entries")

    short = entries.filter(F.col("length") <= BLOCK)
    x, y = short.alias("x"), short.alias("y")

    def may_link(batches):
        for b in batches:
            p, q = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(-1, _RANGES).astype(np.int64)
                    for c in ("p", "q"))
            most = np.minimum(p, q).sum(1)
            need = 100 * most >= percent * (p.sum(1) + q.sum(1) - most)
            yield b.select(["a", "b"]).filter(pa.array(need, pa.bool_()))

    pairs = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cls") < F.col("y.cls"))
                          & (100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")))
                   .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    pairs = pinned(pairs.join(classes.select(F.col("cls").alias("a"), F.col("profile").alias("p")), "a")
                   .join(classes.select(F.col("cls").alias("b"), F.col("profile").alias("q")), "b")
                   .select("a", "b", "p", "q").mapInArrow(may_link, "a long, b long"), "pairs")
    long = entries.filter(F.col("length") > BLOCK)
    wanted = (pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(long.select("cls")).distinct()
              .join(classes.select("cls", "doc", "digest"), "cls"))
    sets = pinned(_sets_of(docs, wanted, n), "sets")

    def verify(batches):
        for b in batches:
            keep = []
            for p, q in zip(b.column("p"), b.column("q")):
                p, q = np.frombuffer(p.as_buffer(), "<u8"), np.frombuffer(q.as_buffer(), "<u8")
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verified(pairs):
        return (pairs.join(sets.selectExpr("cls AS a", "members AS p"), "a")
                .join(sets.selectExpr("cls AS b", "members AS q"), "b")
                .select("a", "b", "p", "q").mapInArrow(verify, "a long, b long"))

    # Each class and its least partner, or the first class of a long list.
    heads = long.groupBy("key").agg(F.min(F.struct("cls", "size")).alias("head"))
    stars = (long.join(heads, "key").filter((F.col("head.cls") < F.col("cls")) & (
        100 * F.least("head.size", "size") >= percent * F.greatest("head.size", "size")))
        .select(F.col("head.cls").alias("a"), F.col("cls").alias("b")))
    joined = components(verified(pairs.union(stars).groupBy("b").agg(F.min("a").alias("a"))))

    # What these links leave open: pairs and lists whose classes are not all in one component.
    apart = (pairs.join(joined.selectExpr("cls AS a", "label AS p"), "a", "left")
             .join(joined.selectExpr("cls AS b", "label AS q"), "b", "left")
             .filter("coalesce(p, a) <> coalesce(q, b)").select("a", "b"))
    linked = pinned(verified(apart), "linked")  # its shuffles go before the long lists' begin
    open_ = (long.join(joined, "cls", "left").groupBy("key")
             .agg(F.min(F.coalesce("label", "cls")).alias("p"), F.max(F.coalesce("label", "cls")).alias("q"))
             .filter("p <> q").select("key"))
    long = long.join(open_, "key", "left_semi")

    # Long lists: an entry goes to its own block paired with every block of its list.
    n_blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    dealt = long.select("key", "cls", n_blocks.alias("nb"),
                        F.pmod(F.xxhash64("cls", F.lit("block")), n_blocks).cast("int").alias("own"))
    dealt = dealt.select("key", "cls", "own", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    dealt = dealt.select("key", "cls", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def block_pair(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_pylist()
        sets = [np.frombuffer(m.as_py(), "<u8") for m in table.column("members")]
        own = np.array(table.column("own").to_pylist())
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        rows, cols = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = _forest(sets, rows, cols, percent) if len(rows) and len(cols) else []
        return pa.table({"a": pa.array([cls[p] for p, _ in found], pa.int64()),
                         "b": pa.array([cls[q] for _, q in found], pa.int64())})

    blocked = dealt.join(sets, "cls").groupBy("key", "i", "j").applyInArrow(block_pair, "a long, b long")
    labels = components(joined.selectExpr("cls AS a", "label AS b").union(linked).union(blocked)
                        .filter("a <> b"))
    if repeated:  # some classes aren't numbered by a doc_id: the least one of each component
        least = labels.join(classes.select("cls", "doc"), "cls").groupBy("label").agg(F.min("doc").alias("least"))
        labels = labels.join(least, "label").select("cls", F.col("least").alias("label"))
    return (marked.join(classes.select("sig", "cls", "doc"), "sig", "left")
            .join(labels, "cls", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc", "doc_id"))
                    .alias("component_id")))
