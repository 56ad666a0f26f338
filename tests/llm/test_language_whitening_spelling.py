"""Language identification, whitening and spelling variants against brute force and labels."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.llm import language_id as L
from auditlens.llm import spelling as S
from auditlens.llm import whitening as W
from auditlens.llm.language_id import identify
from auditlens.llm.spelling import near_words, spelling_variants, tiles
from auditlens.llm.whitening import scatter, whiten

DOC_DDL = "doc_id long, text string, lang string, source string, score string, chance int, letter string, n int, word string"


def documents(spark, rows):
    """(doc_id, text, lang) rows with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, lang, "s", "x", 1, "y", 2, "z") for i, t, lang in rows], DOC_DDL).repartition(3)


# --- language ------------------------------------------------------------------
SYLLABLES = {"aa": "ka to mi ru".split(), "bb": "xel vor gunt ish".split(), "cc": "ño çé lü ßa".split()}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, lang, rng.choice([2, 8, 40])), lang)
            for i, lang in enumerate(rng.choices("aa bb cc".split(), [30, 5, 2], k=400))]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, " 12 3.\n!?", "bb"), (1003, "² ½ _", "bb"),
             (1004, sentence(rng, "cc", 60_000), None), (1005, "KATOMIRU TOKA", None), (None, rows[0][1], "bb")]
    return rows + rows[3:5] + [(7, "completely other text", "bb")]


def test_language_of_every_row(spark, spoken):
    rows = identify(documents(spark, spoken), per_lang=60, landmarks=12).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _, _ in spoken)
    assert rows[0].__fields__ == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (7, None)}
    for i, t, lang in spoken:
        if i in (7, None):
            continue
        r = by_id[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == (lang or {1004: "cc", 1005: "aa"}[i])
    assert next(r for r in rows if r.doc_id is None).held_out is False


def test_language_without_anything_to_learn(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    out = identify(documents(spark, [(held, "ka to", "aa"), (3, "ka", None), (None, "ka", "aa"), (4, "12", "bb")])).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert identify(documents(spark, [])).count() == 0
    one = identify(documents(spark, [(3, "ka to mi", "only"), (4, "xel", None)])).collect()
    assert {r.lang_pred for r in one} == {"only"}


def test_ties_go_to_the_first_language(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5][:20]
    rows = [(i, "same text here", "bé" if k % 2 else "b") for k, i in enumerate(ids)]
    assert {r.lang_pred for r in identify(documents(spark, rows)).collect()} == {"b"}


def test_kernel_is_the_share_of_common_n_grams(monkeypatch):
    rng = random.Random(5)
    texts = [sentence(rng, lang, 30) + " É. 中" for lang in "aa bb cc aa bb".split()] + ["a", "zq"]

    def grams(t):
        d = b" " + bytes(c if c > 127 or chr(c).isalpha() else 32 for c in t.lower().encode()) + b" "
        return {d[i:i + n] for n in (1, 2, 3) for i in range(len(d) - n + 1)}

    for step in (1 << 20, 7):  # whole texts, and pieces that overlap
        monkeypatch.setattr(L, "_STEP", step)
        marks = L.Landmarks([np.unique(np.concatenate(list(L.places(t)))) for t in texts[:3]])
        got = marks.kernel()(texts)
        known = set().union(*map(grams, texts[:3]))
        for t, row in zip(texts, got):
            mine = grams(t) & known
            for m, value in zip(texts[:3], row):
                expect = len(mine & grams(m)) / math.sqrt(max(1, len(mine)) * len(grams(m)))
                assert abs(value - expect) < 1e-5


def test_language_of_the_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    res = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert res.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.98


# --- whitening -----------------------------------------------------------------
VEC_DDL = "vec_id long, embedding array<float>, x string, component int, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 9, 1) for i, v in rows], VEC_DDL).repartition(3)


def test_scatter_equals_integer_products():
    rng = np.random.default_rng(1)
    for rows, dims, low, high in ((1, 1, 5, 6), (63, 3, -40, 40), (64, 5, 0, 1), (200, 4, -10**12, 10**12),
                                  (130, 2, -(2**63), 2**63 - 1)):
        x = rng.integers(low, high, (rows, dims), np.int64)
        sums, cross = scatter(np.ascontiguousarray(x))
        y = x.astype(object)
        assert (cross == y.T @ y).all() and list(sums) == list(y.sum(0))


def test_whitening(spark):
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) * 0.2).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    bad = [(900, None), (901, []), (902, rows[0][1][:19] + [None]), (903, rows[0][1][:19] + [math.nan]),
           (904, [math.inf] + rows[0][1][1:]), (905, [0.5] * 7), (906, [-math.inf] * 20)]
    copies = [(1000 + k, rows[5][1]) for k in range(150)] + [rows[7], (None, rows[8][1])]
    got = collections.defaultdict(list)
    for r in whiten(vectors(spark, rows + bad + copies)).collect():
        got[r.vec_id].append(r)
    assert set(got) == {i for i, _ in rows + copies} and len(got[7]) == 32 and len(got[None]) == 16
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    cov = np.cov(fit.T.astype(np.float64), bias=True)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    for k, xs in enumerate(x):
        out = sorted(got[k], key=lambda r: r.component)[::2 if k == 7 else 1]
        assert [r.component for r in out] == list(range(1, 17))
        assert {(r.n, r.deviation, r.deviation_exact) for r in out} == {
            (n, int(((n * xs - total) ** 2).sum()), str(((n * xs - total) ** 2).sum()))}
        for r in out:
            j = r.component - 1
            assert abs(r.explained - e[j] / np.trace(cov)) < 1e-9
            expect = (xs - total / n) @ v[:, j] / math.sqrt(e[j])
            assert abs(abs(r.whitened) - abs(expect)) < 1e-6 and 0 <= r.identity_error < 1e-9
    white = np.array([[r.whitened for r in sorted(got[k], key=lambda r: r.component)[::2 if k == 7 else 1]]
                      for k in range(300)])[np.unique(x, axis=0, return_index=True)[1]]
    assert np.abs(white.T @ white / n - np.eye(16)).max() < 1e-9     # one sign for all rows


def test_whitening_of_few_dimensions_and_no_variance(spark):
    got = whiten(vectors(spark, [(1, [1.0, 2.0, 0.0]), (2, [2.0, 2.0, 0.0]), (3, [1.0, 2.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c) for i in (1, 2, 3) for c in (1, 2, 3)]
    assert {r.component for r in got if r.whitened is not None} == {1}
    assert {round(abs(r.whitened), 9) for r in got if r.component == 1} == {1.0}
    assert {r.explained for r in got if r.component > 1} == {0.0} and {r.n for r in got} == {2}
    same = whiten(vectors(spark, [(1, [0.5, 0.5])] * 3)).collect()
    assert len(same) == 6 and {r.whitened for r in same} == {None} and {r.deviation for r in same} == {0}
    assert whiten(vectors(spark, [])).count() == 0 and whiten(vectors(spark, [(1, None), (2, [])])).count() == 0


def test_whitening_keeps_exact_digits_beyond_a_long(spark):
    d = spark.createDataFrame([(1, [3.0e16, 0.0]), (2, [-3.0e16, 1.0]), (3, [1e300, -1e300])],
                              "vec_id int, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whiten(d).collect()}
    xs = {1: (64 * 3 * 10**16 + 10**6, 10**6), 2: (-64 * 3 * 10**16 + 10**6, 64 + 10**6),
          3: (int(9.2e18) + 10**6, -int(9.2e18) + 10**6)}
    s = [sum(x[j] for x in xs.values()) for j in (0, 1)]
    for i, x in xs.items():
        assert got[i, 1].deviation is None
        assert int(got[i, 1].deviation_exact) == sum((3 * x[j] - s[j]) ** 2 for j in (0, 1))
    assert whiten(d).schema["vec_id"].dataType.simpleString() == "int"


def test_models_do_not_depend_on_batches(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 500, (1000, 6), np.int64)
    whole = scatter(np.ascontiguousarray(x))
    parts = [scatter(np.ascontiguousarray(x[a:a + 77])) for a in range(0, 1000, 77)]
    assert (sum(p[0] for p in parts) == whole[0]).all() and (sum(p[1] for p in parts) == whole[1]).all()
    assert W.SHIFT == 1_000_000 and W.SCALE == 64


# --- spelling ------------------------------------------------------------------
def expected(rows):
    """The contract, one pair at a time."""
    n = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a[p:] == b[p + 1:] or a[p + 1:] == b[p + 1:] and len(a) == len(b)

    form, count = {}, {}
    for w in words:
        around = [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)]
        count[w] = len(around)
        best = min(around, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 10 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), k, count[w], words[form[w]] if w in form else None) for w, k in words.items()}


def written_words(rng):
    """Texts of word families: edits at either end and inside, chains, long and accented words."""
    text = []
    for base, n in (("kalimero", 1200), ("kalimera", 110), ("kalimeras", 9), ("xkalimera", 3), ("kalimra", 2),
                    ("aaaaaaa", 40), ("aaaaaaaa", 40), ("aaaaaaaaa", 4), ("ÉcoleÉcole", 30), ("écoleécole", 3),
                    ("straße×÷ÿ", 12), ("z" * 900, 25), ("z" * 450 + "y" + "z" * 449, 2), ("z" * 899, 2)):
        text += [base] * n
    for k in range(120):
        word = "".join(rng.choices("abc", k=rng.randrange(7, 10)))
        text += [word] * rng.choice([2, 2, 3, 25, 300])
    text += ["short"] * 50 + ["abcdefg7hijklmn"] * 5 + ["ǅabcdefgh"] * 2 + ["once" * 3]
    rng.shuffle(text)
    cuts = sorted(rng.sample(range(len(text)), 60))
    docs = [" ,.-\n"[k % 5].join(text[a:b]) for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)]))]
    rows = [(i, d.upper() if i % 9 == 0 else d) for i, d in enumerate(docs)]
    return rows + [(500, None), (501, ""), (None, docs[0]), (None, "kalimeros kalimeros"), (3, docs[5]), (4, docs[4])]


@pytest.mark.parametrize("most,block,bucket", [(1024, 256, 8192), (4, 3, 16)])
def test_spelling_variants(spark, monkeypatch, most, block, bucket):
    monkeypatch.setattr(S, "_BLOCK", block)
    rows = written_words(random.Random(6))
    res = spelling_variants(documents(spark, [(i, t, "en") for i, t in rows]), most=most, bucket_rows=bucket).collect()
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in res]
    assert len(got) == len(set(got)) and set(got) == expected(rows)
    by = {r.word: r for r in res}
    assert by["kalimeras"].form == "kalimera" and by["kalimeras"].root == "kalimero"
    assert spelling_variants(documents(spark, [])).count() == 0
    assert spelling_variants(documents(spark, [(1, None, "a"), (2, "no long run", "a")])).count() == 0


def test_tiles_stay_small_and_meet_every_pair_once(spark):
    rng = random.Random(7)
    words = {"prefix" + "".join(rng.choices("ab", k=rng.randrange(4, 9))) + "suffix" for _ in range(400)}
    d = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    dealt = tiles(d, 8)
    sizes = dealt.groupBy("tile", (F.col("longest") - F.col("pre") - F.col("suf")).alias("open")).count().collect()
    # Only tiles with one open code point may hold more: one word per letter there, and the word without it.
    assert all(r["count"] <= (8 if r.open > 1 else 3) for r in sizes)
    out = near_words(dealt.select("word", "n", "len", "longest", "cap", "tile").toArrow())
    count = collections.Counter()
    for w, k in zip(out["word"].to_pylist(), out["n_near"].to_pylist()):
        count[w] += k
    holes = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k] + "*" + w[k + 1:]].add(w)
            holes[w[:k] + w[k + 1:]].add(w) if w[:k] + w[k + 1:] in words else None
    pairs = {(a, b) for g in holes.values() for a in g for b in g if a != b}
    pairs |= {p for h, g in holes.items() if h in words for a in g for p in ((a, h), (h, a))}
    pairs = {(a, b) for a, b in pairs if len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
             or len(a) != len(b)}
    assert count == collections.Counter(a for a, _ in pairs)
