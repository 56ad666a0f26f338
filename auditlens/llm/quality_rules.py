"""Quality rules with host-level verdicts (built-in column functions only).

Every document gets its counts and the base rules. A document also *fails* for
its host if any document rule below holds. Failures are summed by host (the
``source`` column; null is a host of its own), the hosts' failure rates give an
empirical beta prior (method of moments), and each host's rate is shrunk to its
posterior mean (failures + a) / (documents + a + b). A host whose shrunk rate
exceeds ``max_host_rate`` is rejected, and its verdict joins its documents.

Plan: one scan computes the counts, which are written once (about 60 bytes a
document, no text); failures are partially summed before the shuffle, so a host
with a third of all rows is one row per task there; the join carries counts
only, and Spark broadcasts the host side while it is below its threshold and
splits a large host's partition (adaptive skew join) beyond it.

Defined cases: a null or empty text has zero words and fails the base rule; a
3-word window is known by its 64-bit hash within one text; repeated rows are
judged each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, only, pinned

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    window = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
    keep = docs.columns
    d = docs.select(
        *keep, F.array_remove(F.split(t, f"{SPACE_CLASS}+"), "").alias("_w"),
        F.length(F.regexp_replace(t, f"{SPACE_CLASS}+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(SPACE_CLASS.replace("[", "[^"))).alias("_lines"))
    d = d.select(
        *keep, "word_chars", "n_symbols", F.size("_w").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") >= 3, window).alias("_g"))
    base = [*keep, "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    # Only texts with some repeated window are sorted: (hash, place) in order,
    # then each place whose hash has an equal neighbour.
    d = d.select(*base, F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.array_sort(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    d = d.select(*base, F.array_sort(F.filter(
        F.transform("_s", lambda x, j: F.when(
            F.coalesce(F.get("_s", j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get("_s", j + 1)["h"] == x["h"], F.lit(False)), x["i"])),
        lambda i: i.isNotNull())).alias("_p"))
    # Words covered: a window adds up to three, fewer where the next one overlaps.
    covered = F.aggregate(
        F.transform("_p", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - i, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select(*base, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def document_failed() -> Column:
    """Any rule that counts against the host: base rules, symbols, repeated lines, word length."""
    return (base_failed() | (10 * F.col("n_symbols") > F.col("word_chars"))
            | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
            | (F.col("word_chars") > 15 * F.col("n_words")))


def host_verdicts(counted: DataFrame, max_host_rate: float) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, host_rejected."""
    hosts = (counted.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                         F.sum(document_failed().cast("long")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    m = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var")).first()  # one row
    mean = m["mean"] if m["mean"] is not None else 0.5
    mean = min(max(mean, 0.001), 0.999)
    # Equal rates say nothing on the spread: then the prior weighs as 1000 documents.
    strength = min(mean * (1 - mean) / m["var"] - 1, 1000.0) if m["var"] else 1000.0
    strength = max(strength, 1.0)
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("host_rejected", shrunk > max_host_rate)


def quality_rules(docs: DataFrame, max_host_rate: float = 0.6) -> DataFrame:
    """doc_id, the counts, base_failed, the host's shrunk_rate, kept."""
    rows = only(docs, "doc_id", "text", "source")
    counted = pinned(text_counts(rows).drop("text").withColumnRenamed("source", "host"), "quality-counts")
    hosts = host_verdicts(counted, max_host_rate).select(
        F.col("host").alias("_host"), "shrunk_rate", "host_rejected")
    joined = counted.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"), "shrunk_rate")


def oracle_sql(max_host_rate: float = 0.6) -> str:
    """The same rows in DuckDB SQL, without shrunk_rate (a float)."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, host, t,
         list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM d),
g AS (
  SELECT r, i, words[i:i+2] AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
cov AS (
  SELECT r, sum(least(3, coalesce(nxt - i, 3))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM hit) GROUP BY r),
c AS (
  SELECT doc_id, host, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (
  SELECT host, count(*) AS n, sum((base_failed OR 10 * n_symbols > word_chars
         OR 10 * n_dup_lines > 3 * n_lines OR word_chars > 15 * n_words)::INT) AS f FROM b GROUP BY host),
p AS (SELECT least(greatest(avg(f / n), 0.001), 0.999) AS m, var_pop(f / n) AS v FROM h),
s AS (SELECT m, greatest(least(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1000 END, 1000), 1) AS k FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ((f + m * k) / (n + k) > {max_host_rate}) AS kept
FROM b JOIN h ON b.host IS NOT DISTINCT FROM h.host, s"""
