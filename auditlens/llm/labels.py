"""Labelled rows for the classifiers: which may be learnt from, and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text leaves remainder 1 by three (null: not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text, label (0/1) of the labelled rows that aren't held out.

    Repeated or contradicting labels of one doc_id count once, as the greatest.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    return docs.select("doc_id", "text").join(known, "doc_id")


def sample(rows: DataFrame, limit: int, salt: str) -> DataFrame:
    """About ``limit`` rows (all, if there are no more), the same ones in every run.

    Rows are chosen by the hash of their doc_id, so nothing is sorted or gathered.
    """
    n = rows.select("doc_id").count()
    if n <= limit:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 40)) < int((1 << 40) * limit / n))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, value: int, limit: int) -> DataFrame:
    """doc_id, text of about ``limit`` documents with the label's ``value`` that may be learnt from.

    The ids are chosen from the labels alone (contradicting labels count as the
    greatest) and broadcast, about ``limit`` whatever the tables' size, so no text
    moves but those chosen. A repeated doc_id counts once, by its least text.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("label").alias("label")).filter(F.col("label") == value).select("doc_id"))
    chosen = F.broadcast(sample(known, limit, label))
    return docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
