"""Registered queries of the text operators: ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import quality_classifier as QC
from . import quality_rules as QR
from .common import documents, table
from .decontaminate import decontaminate
from .jaccard_join import jaccard_join
from .language_id import identify
from .packing import pack
from .spelling import spelling_variants
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .token_count import token_counts
from .toxicity import toxicity
from .token_files import read_token_files, write_token_files
from .whitening import whiten


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark, sf_dir):
    return QR.quality_rules(documents(spark, sf_dir)).drop("shrunk_rate")


def op2_quality_classifier(spark, sf_dir):
    return QC.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join(documents(spark, sf_dir))


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark, sf_dir):
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op10_token_files(spark, sf_dir):
    path = write_token_files(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens",
                                                F.crc32("ids").alias("ids_crc32"))


def op11_language_id(spark, sf_dir):
    return identify(documents(spark, sf_dir))


def op12_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir))


def queries():
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_decontaminate": op3_decontaminate,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_token_counts": op6_token_counts,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_packing": op9_packing,
        "op10_token_files": op10_token_files,
        "op11_language_id": op11_language_id,
        "op12_whitening": op12_whitening,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql():
    return {"op1_quality_rules": QR.oracle_sql()}
