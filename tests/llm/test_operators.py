"""Text operators against brute force, with nulls, empties, copies, long texts and clashing columns."""

import collections
import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from auditlens.llm import entries
from auditlens.llm.decontaminate import align, decontaminate
from auditlens.llm.jaccard_join import jaccard_join
from auditlens.llm.packing import pack, windows_of
from auditlens.llm.quality_classifier import classify
from auditlens.llm.quality_rules import quality_rules
from auditlens.llm.substring_dedup import substring_dedup
from auditlens.llm.suffix_arrays import common_prefixes, suffix_array
from auditlens.llm.suffix_dedup import suffix_dedup
from auditlens.llm.token_count import token_counts
from auditlens.llm.token_files import decode_values, encode_values, read_token_files, write_token_files
from auditlens.llm.toxicity import toxicity

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
DDL = ("doc_id long, text string, lang string, source string, n_chars long,"
       " n_words int, hits int, batch string, score string, label string")


def words(rng, n):
    return [rng.choice(["la", "the", "Of", "ra.", "én", "x"]) + str(rng.randrange(60)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    passage = " ".join(words(rng, 45))
    base = words(rng, 120)
    out = [None, "", " \t\n", "one", "one", "two words", "a\x00b  <|endoftext|> c", "é" * 250, "é" * 250]
    out += [" ".join(base)] * 3
    for i in range(6):
        near = list(base)
        near[rng.randrange(120)] = f"edit{i}"
        out.append("\n".join([" ".join(near[:60]), " ".join(near[60:])]))
    out += [" ".join(words(rng, 30)) + " " + passage + "\n" + " ".join(words(rng, 25 + i)) for i in range(4)]
    out += [" ".join(words(rng, 9000)), "ab " * 300, "z" * 3000]
    return [(i, t) for i, t in enumerate(out)] + [(None, passage), (3, "one")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}" if k % 5 else None, 0, 1, 2, "b", "s", "l")
                                  for k, (i, t) in enumerate(rows)], DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def got(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


def covered(seqs, length):
    """Brute force: which places of each sequence a repeated window covers."""
    n = collections.Counter(s[p:p + length] for s in seqs for p in range(len(s) - length + 1))
    for s in seqs:
        gone = [False] * len(s)
        for p in range(len(s) - length + 1):
            if n[s[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        yield s, gone


def test_quality_rules(docs, rows, empty):
    expect = collections.Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        n = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {p + k for p in range(len(w) - 2) if n[tuple(w[p:p + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        expect[i, len(w), sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"),
               len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)] += 1
    res = quality_rules(docs).cache()
    assert got(res, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "base_failed") == expect
    assert res.filter("kept AND base_failed").count() == 0
    assert quality_rules(empty).count() == 0


def test_bad_host_is_rejected(spark):
    good = " ".join(f"word{i}" for i in range(80))
    bad = " ".join(f"##{i}##$$" for i in range(80))
    d = spark.createDataFrame([(i, good, "ok") for i in range(30)] + [(100 + i, bad, "bad") for i in range(30)]
                              + [(200, good, "bad")], "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality_rules(d).filter("kept").collect()}
    assert kept == set(range(30))


@pytest.mark.parametrize("batch_bytes", [3000, 1 << 22])
def test_substring_dedup(docs, rows, empty, batch_bytes):
    expect = collections.Counter()
    seqs = [tuple((t or "").encode().split()) for _, t in rows]
    for (i, _), (s, gone) in zip(rows, covered(seqs, 35)):
        expect[i, len(s), sum(gone), b" ".join(w for w, g in zip(s, gone) if not g)] += 1
    res = substring_dedup(docs, batch_bytes=batch_bytes).withColumn("kept", F.col("kept"))
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in res.collect()) == expect
    assert substring_dedup(empty).count() == 0


@pytest.mark.parametrize("batch_bytes", [3000, 1 << 22])
def test_suffix_dedup(docs, rows, empty, batch_bytes):
    expect = collections.Counter()
    for (i, _), (s, gone) in zip(rows, covered([(t or "").encode() for _, t in rows], 200)):
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        expect[i, len(s), sum(gone), spans, bytes(b for b, g in zip(s, gone) if not g)] += 1
    res = suffix_dedup(docs, batch_bytes=batch_bytes).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in res) == expect
    assert suffix_dedup(empty).count() == 0


def test_suffix_dedup_whatever_order_rows_arrive_in(spark):
    rng = random.Random(11)
    passage = " ".join(words(rng, 60))
    texts = [" ".join(words(rng, 20 + i)) + (" " + passage) * (i % 2) for i in range(40)]
    rows_ = [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (3, texts[3]), (3, passage)]

    def shuffled(batches):  # another order each time a step reads its input
        table = pa.Table.from_batches(list(batches))
        turn = np.random.default_rng().permutation(table.num_rows)
        yield from table.take(pa.array(turn)).combine_chunks().to_batches()

    docs = spark.createDataFrame(rows_, "doc_id long, text string").coalesce(1)
    res = suffix_dedup(docs.mapInArrow(shuffled, docs.schema)).collect()
    expect = collections.Counter()
    for (i, _), (s, gone) in zip(rows_, covered([t.encode() for _, t in rows_], 200)):
        expect[i, sum(gone), bytes(b for b, g in zip(s, gone) if not g)] += 1
    assert collections.Counter((r.doc_id, r.n_removed, bytes(r.kept)) for r in res) == expect


@pytest.mark.parametrize("piece", [1, 700, 1 << 19])
def test_suffix_dedup_in_pieces(piece, monkeypatch):
    from auditlens.llm import repeats as R
    from auditlens.llm import suffix_dedup as S

    monkeypatch.setattr(S, "_PIECE", piece)
    rng = random.Random(12)
    passage = " ".join(words(rng, 60))
    texts = [(" ".join(words(rng, 10 + 3 * i)) + (" " + passage[i:]) * (i % 3)).encode() for i in range(40)]
    texts = [b"", *texts, b"", texts[4], b"ab" * 300, b"short", b""]
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    pieces = list(S._pieces(lengths))
    assert len(pieces) > 1 or piece > len(data)
    assert [p[0] for p in pieces] + [len(texts)] == [0] + [p[1] for p in pieces]
    assert [p[2] for p in pieces] + [len(data)] == [0] + [p[3] for p in pieces]
    places, seed, span, more = S.owners(data, lengths, 200)
    cells = [7, 0, R.packed(seed >> np.uint64(64 - 8 * S._SEED_WIDTH), S._SEED_WIDTH), span.tobytes(), more.tobytes()]
    hits = S.settle(pa.table([[c] for c in cells], ["batch", "bucket", "seed", "span", "more"])).column("hits")
    answer = np.frombuffer(hits[0].as_py(), np.uint8)[places.key]
    assert {S._REPEATED, S._OPEN} <= set(answer.tolist())
    prints, twice = S.open_strings(data, lengths, places, answer, 200)
    assert (np.diff(prints.astype(object)) > 0).all()
    gone = [S.repeats(data[i:j], i, places, answer, prints[twice], 200) for _, _, i, j in pieces]
    assert np.concatenate(gone).tolist() == [x for _, g in covered(texts, 200) for x in g]


def test_suffix_dedup_memory_of_a_batch():
    import tracemalloc

    from auditlens.llm.suffix_dedup import owners

    rng = np.random.default_rng(3)
    lengths = np.full(3000, 1000)
    data = rng.integers(97, 123, lengths.sum(), dtype=np.uint8)
    data[1_000_000:1_500_000] = data[:500_000]
    end = np.repeat(np.cumsum(lengths), lengths)

    def peak(step):  # bytes for each byte of text
        tracemalloc.start()
        step()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most / len(data)

    assert peak(lambda: owners(data, lengths, 200)) < 25
    order = suffix_array(data, end)
    assert peak(lambda: suffix_array(data, end)) < 60
    assert peak(lambda: common_prefixes(data, end, order, 200)) < 40


def test_messages_are_at_most_one_per_fingerprint():
    from auditlens.llm import repeats as R

    rng = np.random.default_rng(4)
    for bits in (0, 3, 12, 30):  # up to far more buckets than fingerprints
        prints, more = R.distinct(rng.integers(0, 1 << 63, 500, np.uint64) * np.uint64(2), 8)
        sent = R.messages(7, prints, more, more, bits, 8)
        assert sent.num_rows == len({int(p) >> (64 - bits) for p in prints}) <= len(prints)
        back = np.concatenate([R.unpacked(x.as_py(), 8) for c in ("once", "more") for x in sent.column(c)])
        assert sorted(back.tolist()) == prints.tolist()
    assert R.messages(7, prints[:0], more[:0], more[:0], 5, 8).num_rows == 0


def test_suffix_arrays_some_groups_at_a_time(monkeypatch):
    monkeypatch.setattr("auditlens.llm.suffix_arrays._STEP", 5)
    test_suffix_arrays()


def test_suffix_arrays():
    rng = random.Random(1)
    for t in range(150):
        regions = [bytes(rng.choices([0, 1, 97], k=rng.randint(1, 60))) for _ in range(rng.randint(1, 5))]
        regions += regions[:t % 2]
        data, sizes = np.frombuffer(b"".join(regions), np.uint8), [len(r) for r in regions]
        end = np.repeat(np.cumsum(sizes), sizes)
        suffix = [bytes(data[p:end[p]]) for p in range(len(data))]
        order = suffix_array(data, end)
        assert list(order) == sorted(range(len(data)), key=lambda p: (suffix[p], p))
        shared = common_prefixes(data, end, order, 10, lane=rng.choice([1, 4, 64]))
        for k in range(1, len(order)):
            a, b = suffix[order[k - 1]], suffix[order[k]]
            assert shared[k] == next((m for m in range(10) if m >= min(len(a), len(b)) or a[m] != b[m]), 10)


@pytest.mark.parametrize("block", [2, 256])
def test_jaccard_join(docs, rows, empty, block, monkeypatch):
    monkeypatch.setattr("auditlens.llm.jaccard_join.BLOCK", block)
    sets, root = [], {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[j:j + 3]) for j in range(max(1, len(w) - 2))) if w else frozenset()))
        root.setdefault(i, i)

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 90 * len(x | y):
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    expect = collections.Counter((i, len(s), None if i is None else find(i)) for i, s in sets)
    assert got(jaccard_join(docs), "doc_id", "n_shingles", "component_id") == expect
    assert jaccard_join(empty).count() == 0


def test_links_of_rows_that_share_an_id(spark):
    rng = random.Random(9)
    a, b, c = (words(rng, 100) for _ in range(3))
    near = lambda w, k: " ".join([*w[:50], f"edit{k}", *w[51:]])
    rows_ = [(5, " ".join(a)), (5, " ".join(b)), (2, near(a, 1)), (3, near(b, 2)), (5, " ".join(c)), (7, near(c, 3)),
             (8, "alone here"), (8, "alone there"), (-4, " ".join(words(rng, 60)))]
    d = spark.createDataFrame(rows_, "doc_id long, text string")
    res = collections.Counter((r.doc_id, r.component_id) for r in jaccard_join(d).collect())
    assert res == collections.Counter([(5, 2), (5, 3), (2, 2), (3, 3), (5, 5), (7, 5), (8, 8), (8, 8), (-4, -4)])


@pytest.mark.parametrize("block", [4, 256])
def test_sets_are_sent_once_a_class_not_once_a_pair(spark, block, monkeypatch):
    from auditlens.llm import jaccard_join as J

    steps, pinned = [], J.pinned

    def watched(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = pinned(df, name)
        steps.append((name, plan, out.count()))
        return out

    monkeypatch.setattr(J, "pinned", watched)
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(4)
    base, other = words(rng, 200), words(rng, 200)
    edited = lambda w, *at: " ".join("new" + x if k in at else x for k, x in enumerate(w))
    # 40 near copies of one text, all alike; 2 of another and one between them that alone links them.
    rows_ = [(k, edited(base, 4 * k + 2)) for k in range(40)]
    rows_ += [(100, edited(other, 10, 20, 30)), (101, edited(other, 110, 120, 130)), (102, " ".join(other))]
    rows_ += [(200 + k, " ".join(words(rng, 50))) for k in range(3)] + rows_[:1] + [(50, rows_[0][1].encode().upper().decode())]
    res = {(r.doc_id, r.component_id) for r in jaccard_join(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert res == {(k, 0) for k in [*range(40), 50]} | {(100, 100), (101, 100), (102, 100)} | {(k, k) for k in (200, 201, 202)}
    assert sum(n for name, _, n in steps if name == "links") < 3 * 46
    (sets, n), = [(plan, n) for name, plan, n in steps if name == "sets"]
    assert n <= 43 and sets.index("MapInArrow") < sets.index("Exchange")  # texts are dealt, sets are not


def test_forest_of_large_sets_in_parts(monkeypatch):
    from auditlens.llm import jaccard_join as J

    rng = np.random.default_rng(5)
    base = rng.choice(10**9, 3000, replace=False).astype(np.uint64)
    sets = [np.sort(np.concatenate([base[:3000 - k], rng.choice(10**9, k).astype(np.uint64) + np.uint64(10**10)]))
            for k in (0, 10, 100, 200, 900, 2900)]
    at = np.arange(len(sets))
    whole = J._forest(sets, at, at, 90)
    monkeypatch.setattr(J, "_MEMBERS", 257)
    assert J._forest(sets, at, at, 90) == whole and {frozenset(p) for p in whole} == {
        frozenset(p) for p in ((0, 1), (0, 2))}


def test_tokens(docs, rows, empty, spark):
    from tokenizers import Tokenizer

    path = entries.vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    ids = {t: tok.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    expect = collections.Counter((i, len((t or "").encode()), len(ids[t]), len(ids[t]) > 1024) for i, t in rows)
    assert got(token_counts(docs, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == expect
    pieces = pack(docs, path, group=4).collect()
    assert sum(p.length for p in pieces) == sum(len(x) + 1 for x in (ids[t] for _, t in rows))
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(ids[t] + [0])
    seqs = collections.defaultdict(list)
    for p in pieces:
        assert any(len(x) == p.doc_tokens and
                   zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32
                   for x in texts[p.doc_id])
        seqs[p.sequence_id].append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert pack(empty, path).count() == 0 and token_counts(empty, path).count() == 0


def test_differencing_is_near_equal():
    rng = random.Random(2)
    sizes = [rng.randint(1, 256) for _ in range(400)]
    windows = windows_of(sizes, 1024)
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert sorted(i for w in windows for i in w) == list(range(400))
    assert max(sums) <= 1024 and len(windows) <= -(-sum(sizes) // 1024) + 2


def test_value_coding_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 1 << 32, n, np.uint64) >> rng.integers(0, 32, n, np.uint64)).astype(np.uint32)
        assert (decode_values(*encode_values(v), n) == v).all()


def test_token_files(docs, rows, empty, spark):
    from tokenizers import Tokenizer

    path = entries.vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    back = read_token_files(spark, write_token_files(docs, path, 2, rows_per_shard=7)).collect()
    expect = collections.Counter((i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
                                 for i, t in rows)
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in back) == expect
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert order == sorted(order)
    assert read_token_files(spark, write_token_files(empty, path, 2)).count() == 0


def test_decontaminate(spark, empty):
    rng = random.Random(5)
    item = [f"q{rng.randrange(10**6)}" for _ in range(30)]
    edited = [w if k % 7 else "other" for k, w in enumerate(item)]
    d = spark.createDataFrame([
        (1, "intro " + " ".join(item) + " outro", 0), (2, " ".join(edited).upper(), 0), (3, None, 0), (4, "", 0),
        (5, " ".join(words(rng, 3000)), 0), (6, " ".join(item[:8]), 0)], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(9, " ".join(item)), (10, None), (11, "the of")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate(d, b).collect()}
    assert set(found) == {(1, 9), (2, 9)} and found[1, 9] == 1.0 and found[2, 9] < 1  # 8 of 30 words are neither half nor 13
    assert decontaminate(empty, b).count() == 0 and decontaminate(d, b.limit(0)).count() == 0
    assert align(np.array([1, 2, 3]), np.array([9, 1, 2, 8, 3])) == (5, 5)


def plain_alignment(item, text):
    """Smith-Waterman over whole texts, cell by cell: the best local sum."""
    above, best = [0] * (len(text) + 1), 0
    for w in item:
        row = [0]
        for j, x in enumerate(text):
            row.append(max(0, above[j] + (2 if x == w else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


@pytest.mark.parametrize("block_items", [3, 20_000])
def test_decontaminate_equals_plain_alignment_of_all_pairs(spark, block_items):
    rng = random.Random(21)
    common = [f"c{k}" for k in range(30)]
    vocabulary = [f"w{k}" for k in range(400)]
    preamble = [f"p{k}" for k in range(10)]
    items = [preamble * (k % 2) + rng.choices(vocabulary, k=size) for k, size in enumerate((30, 25, 60, 12, 40, 8, 300, 20))]
    items += [["short", "item", "words"], ["two", "words"], [], items[0]]
    texts = []
    for k in range(60):
        item = items[k % 8]
        if k < 40:
            body = []
            for w in item:  # edited copies: replaced, left out and added words
                body += rng.choices([[w], [rng.choice(vocabulary)], [], [w, rng.choice(common)]],
                                    [10, k % 5 / 2, k % 5 / 3, k % 5 / 3])[0]
        else:
            at = rng.randrange(len(item))
            body = item[at:at + rng.choice([6, 20])]  # parts, some of them long
        texts.append(rng.choices(common, k=rng.randrange(40)) + body + rng.choices(common, k=rng.randrange(40)))
    texts += [preamble, preamble + common, ["a", "Short", "item,", "words!"], ["short", "item", "other"], texts[3], []]
    rows = [(None if k == 5 else k % 64, " ".join(w.upper() if k % 7 == 0 else w for w in t), "x", 1.0, 2)
            for k, t in enumerate(texts)] + [(99, None, "x", 1.0, 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, item_id string, score double, end_word int").repartition(3)
    b = spark.createDataFrame([(i, " ".join(x), i) for i, x in enumerate(items)] + [(77, None, 0)],
                              "item_id long, text string, doc_id int")
    expect = collections.Counter()
    for (i, t, *_), words_ in zip(rows, texts):
        plain_words = [w.lower().strip(",!") for w in words_]
        for j, item in enumerate(items):
            if len(item) < 3:
                continue
            total = plain_alignment(item, plain_words)
            if total >= (2 * len(item) if len(item) < 5 else len(item)) or total >= 26:
                expect[i, j, round(total / (2 * len(item)), 9)] += 1
    res = decontaminate(d, b, block_items=block_items).collect()
    assert collections.Counter((r.doc_id, r.item_id, round(r.score, 9)) for r in res) == expect
    assert {j for _, j, _ in expect} >= {0, 1, 2, 3, 4, 6, 8, 11} and any(s < 0.5 for _, _, s in expect)


def test_shared_preamble_is_no_seed():
    from auditlens.llm.decontaminate import Seeds

    rng = random.Random(22)
    preamble = [f"p{k}" for k in range(10)]
    items = [(k, preamble + [f"w{rng.randrange(10**6)}" for _ in range(20)]) for k in range(2000)]
    counts = collections.Counter(w for _, ws in items for w in ws)
    seeds = Seeds(items, {**counts, "": sum(counts.values())}, 100_000, 3, 1e-4, 3, 8)
    ids = np.array([seeds.vocabulary[w] for w in preamble], np.int64)
    assert not list(seeds.passages(ids, np.array([10])))
    # Where items have nothing else, what they share still finds them all.
    same = [(k, preamble) for k in range(50)]
    seeds = Seeds(same, {w: 50 for w in preamble} | {"": 10**6}, 1000, 3, 1e-4, 3, 8)
    ids = np.array([seeds.vocabulary[w] for w in preamble], np.int64)
    assert {item for _, item, _, _ in seeds.passages(ids, np.array([10]))} == set(range(50))


def test_word_tables():
    from auditlens.llm import words as Wd
    import pyarrow as pa

    rng = random.Random(23)
    texts = [None, "", " ", "a", " a  b\n", "é\tü\u00a0x", "x" * 9000 + " y " + "x" * 9000, "a" * 300_000, "b c" * 200_000]
    texts += [" ".join(words(rng, rng.randrange(200))) for _ in range(50)]
    column = pa.array(["skipped", *texts, "skipped"]).slice(1, len(texts))
    data, offsets = Wd.column_bytes(column)
    starts, ends = Wd.runs(data, offsets, Wd.WHITE)
    found = [bytes(data[i:j]) for i, j in zip(starts.tolist(), ends.tolist())]
    split = [(t or "").encode().split() for t in texts]
    assert found == [w for ws in split for w in ws]
    assert Wd.rows_of(starts, offsets).tolist() == [len(ws) for ws in split]
    keys = Wd.hashes(data, starts, ends)
    by_word = {}
    assert all(by_word.setdefault(w, k) == k for w, k in zip(found, keys.tolist()))
    assert len(set(by_word.values())) == len(by_word)  # no two words collide here
    learnt = []

    def learn(new):
        learnt.extend(new)
        return np.array([len(w) for w in new])

    memo = Wd.Memo(learn)
    for _ in range(2):
        assert memo(data, starts, ends).tolist() == [len(w) for w in found]
    assert sorted(learnt) == sorted(set(found))
    table = Wd.Table(8)
    new = np.array([k << 40 | 3 for k in range(1, 5000)], np.uint64)  # all for one place at first
    for part in np.array_split(new, 7):
        table.add(part)
    assert table.find(new).tolist() == list(range(len(new))) and (table.find(new + np.uint64(1)) == -1).all()


def test_classifiers(spark, empty):
    sf = "/root/testdata/sf0.01"
    d, lab = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (None, "", "en", "s", 0)], d.schema)
    for fn, label, least in ((classify, "quality", 0.95), (toxicity, "toxic", 0.85)):
        res = fn(d.union(odd), lab).cache()
        assert res.count() == d.count() + 2 and res.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
        held = res.join(lab.dropDuplicates(["doc_id"]), "doc_id").filter("held_out")
        assert held.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least
        assert fn(empty, lab).count() == 0
        assert fn(odd, lab.limit(0)).count() == 2
        crc = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
        assert {r.doc_id: r.held_out for r in res.filter("doc_id < 50").collect()} == crc


def test_compressibility_is_of_the_whole_text():
    from auditlens.llm.quality_classifier import _ratio_bucket, _shapes

    rng = random.Random(4)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(10_000)).encode()
    assert len(clean) > 1 << 16
    for text in (b"short", clean, clean + b"buy now " * 100_000, b"buy now " * 10_000 + clean * 3):
        assert _shapes(text)[6] == _ratio_bucket(len(zlib.compress(text, 1)) / len(text))
    assert _shapes(clean + b"buy now " * 100_000)[6] < _shapes(clean)[6]


def test_toxicity_counts_the_whole_corpus(spark, monkeypatch):
    from auditlens.llm import toxicity as T

    rng = random.Random(8)
    texts = [" ".join(["Vile!", "vileness", "vilest"][:k % 4] + words(rng, 12)) if k % 50 < 4 else
             " ".join(words(rng, 15)) for k in range(3000)]
    d = spark.createDataFrame([*enumerate(texts), (None, "vile")], "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame([(k, 1) for k in range(0, 3000) if k % 50 in (1, 2, 3)], "doc_id long, toxic int")
    seen = {}
    real = T.train
    monkeypatch.setattr(T, "train", lambda toxic, other, prior, **k: seen.update(
        prior=prior, n=len(other)) or real(toxic, other, prior, **k))
    names, _ = T.fit(d, lab, unlabelled=100)
    assert seen["n"] < 300 and {"vile", "vile*1"} <= set(names)
    known = [(i, t) for i, t in [*enumerate(texts), (None, "vile")]
             if i is None or zlib.crc32(str(i).encode()) % 3 != 1]
    held = [T.features({T.plain(w) for w in t.encode().split()}) for _, t in known]
    expect = collections.Counter(f for fs in held for f in fs)
    every = sorted(expect)
    monkeypatch.setattr(T, "_CACHE", 20)  # the table of raw forms turns over
    counts, n = T.corpus_counts(d.filter(~T.held_out()), every)
    assert n == len(known) and dict(zip(every, counts.tolist())) == expect
    toxic = [fs for (i, _), fs in zip(known, held) if i is not None and i % 50 in (1, 2, 3)]
    p = collections.Counter(f for fs in toxic for f in fs)
    first = sorted((f for f in p if p[f] >= 3), key=lambda f: (-abs(p[f] / len(toxic) - expect[f] / n) / max(
        1e-12, p[f] / len(toxic) * (1 - p[f] / len(toxic)) / len(toxic) + expect[f] / n * (1 - expect[f] / n) / n) ** 0.5,
        f))[:16]
    ratios = [expect[f] / n / (p[f] / len(toxic)) for f in first if f in names]
    assert abs(seen["prior"] - np.quantile(ratios, 0.75)) < 1e-9


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    rejected = {r.doc_id for r in quality_rules(d).filter("NOT kept").collect()}
    first = P.rules(spark, d, sf)
    assert first.columns == d.columns and {r.doc_id for r in first.collect()} == {
        r.doc_id for r in d.collect()} - rejected
    near = P.near_duplicates(spark, first, sf)
    heads = {r.doc_id for r in jaccard_join(first, n=5, percent=80).filter("doc_id = component_id").collect()}
    assert near.columns == d.columns and {r.doc_id for r in near.collect()} == heads
    out = P.run(spark, sf)
    assert {r.doc_id for r in out.collect()} <= heads and out.agg(F.sum("length")).first()[0] > 0


def test_pipeline_keeps_what_it_cannot_decide(spark):
    import corpus_pipeline as P

    rng = random.Random(12)
    clean = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(90)) for _ in range(8)]
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(50))
    rows_ = [(1, clean[0]), (1, clean[1]), (1, "junk " * 80), (None, clean[2]), (None, clean[3]), (None, None), (2, None),
             (3, ""), (4, clean[4] + " " + passage), (4, passage + " " + clean[5]), (5, clean[6]), (6, clean[6]),
             (None, " ".join(f"l{rng.randrange(10**6)}" for _ in range(40_000))), (7, clean[7]), (7, clean[7])]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _hash string, component_id int"
    d = spark.createDataFrame([(i, t, "en", "s", 0, False, "x", 1) for i, t in rows_], ddl)
    has = lambda df: collections.Counter((r.doc_id, (r.text or "")[:20]) for r in df.collect())
    good = {(i, (t or "")[:20]) for i, t in rows_ if t and len(t.split()) >= 50 and "junk" not in t}
    first = P.rules(spark, d, "")
    assert set(has(first)) == good and has(first)[7, clean[7][:20]] == 2
    near = P.near_duplicates(spark, first, "")
    assert has(near) == collections.Counter(good - {(6, clean[6][:20])})
    cut = P.repeated_passages(spark, near, "")
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert {(4, clean[4]), (4, clean[5])} <= texts and cut.count() == near.count()
    sf = "/root/testdata/sf0.001"
    kept = P.leaks(spark, cut, sf)
    assert has(kept) == has(cut)
    assert P.packing(spark, kept, sf).agg(F.countDistinct("doc_tokens")).first()[0] > 1
    empty_ = d.limit(0)
    for _, stage in P.STAGES:
        empty_ = stage(spark, empty_, sf)
    assert empty_.count() == 0


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark):
    import corpus_pipeline as P

    rng, texts = random.Random(11), []
    for size, edits in ((55, 1), (40, 1), (300, 8), (300, 20), (90, 0)):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [list(base), list(base)]
        for at in rng.sample(range(5, size - 5), edits):
            texts[-1][at] = "edit"
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in texts]
    heads = {j for j, y in enumerate(sets) if not any(10 * len(x & y) >= 8 * len(x | y) for x in sets[:j])}
    assert 1 not in heads and 3 in heads
    d = spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in P.near_duplicates(spark, d, "").collect()} == heads


def test_hash_of_kept_text(spark):
    res = entries.op5_substring_dedup(spark, "/root/testdata/sf0.001").filter("n_removed = n_words").first()
    assert res is None or res.kept_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library_on_odd_characters(name):
    from auditlens.llm import tokens

    rng = random.Random(5)
    alphabet = [*"abXYßñçüŧ中あ٣½²_'’.,!?;-\"(…—*#09 \n\t\r\xa0\x01\x1c\x85̀​ 😀İΣς",
                "'s", "'ll", " ", " ", "  ", "\n\n", "the", "The", "<|endoftext|>", "<|ENDOFTEXT|>", "\n", "--", "_x_"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["x" * 700 + " b", " ", "\n", "a ", " a", "a  b", ""]
    enc = tokens.Encoder(entries.vocabulary(name))
    enc.bodies.limit = enc.atoms.limit = 500  # tables turn over within the test
    for i in range(0, len(texts), 100):
        part = texts[i:i + 100]
        for text, ids in zip(part, enc.encode(part)):
            assert ids.tolist() == enc.tok.encode(text, add_special_tokens=False).ids, text
