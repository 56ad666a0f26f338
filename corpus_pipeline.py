"""From raw documents to packed sequences: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Rows a stage keeps go on unchanged,
except that substring dedup rewrites the text (and n_chars) of documents that
lost words, and drops those that lost all.

Stages join decisions back with a semi or outer join, never through the driver.
A row is known by its doc_id, and where an operator tells them apart by its text
too, so rows of one doc_id with different texts are decided on one by one by the
quality rules and keep their own text in substring dedup. What can't be decided
on stays: near duplicates keep rows without a doc_id, and every distinct text of
a doc_id whose rows aren't all copies of others. Decontamination drops all rows
of a doc_id that has a leak, and none without a doc_id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm.common import pinned, table
from auditlens.llm.decontaminate import decontaminate
from auditlens.llm.entries import vocabulary
from auditlens.llm.jaccard_join import jaccard_join
from auditlens.llm.packing import pack
from auditlens.llm.quality_rules import quality_rules
from auditlens.llm.substring_dedup import substring_dedup
from auditlens.session import checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _text_hash(text: str = "text"):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality rules keep."""
    docs = _columns(docs)
    judged = quality_rules(docs.withColumn("doc_id", F.struct("doc_id", _text_hash().alias("text_hash"))))
    kept = judged.filter("kept").select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.text_hash").alias("_hash"))
    return _columns(docs.join(kept.distinct(), F.col("doc_id").eqNullSafe(F.col("_id"))
                              & (_text_hash() == F.col("_hash")), "left_semi"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the least doc_id.

    Near duplicates share 0.8 or more of their word shingles of five words;
    the defaults of ``jaccard_join`` are the contract of the op4 query alone.
    """
    docs = _columns(docs)
    groups = jaccard_join(docs, n=5, percent=80)
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    with_id = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return with_id.unionByName(docs.filter("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated passages; a text without any keeps its white space too. A text that
    loses all its words goes."""
    docs = _columns(docs).withColumn("_none", F.col("text").isNull())
    out = substring_dedup(docs, carry=("lang", "source", "n_chars", "_none"))
    text = F.when(~F.col("_none"), F.col("cleaned").cast("string"))
    return out.filter("n_removed = 0 OR n_removed < n_words").select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length(text)).cast("long").alias("n_chars"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _columns(docs.join(pinned(found, "leaks"), "doc_id", "left_anti"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 1024 tokens."""
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", leaks),
    ("packing", packing),
]

#: Tokenization and alignment are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/llm/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs
