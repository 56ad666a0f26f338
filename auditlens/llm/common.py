"""Helpers shared by the text operators.

Words are runs of characters other than the six ASCII white-space characters
(space and U+0009..U+000D). ``bytes.split()`` cuts UTF-8 text at exactly these.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.session import checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's own switch: a finished write drops the shuffle files it made.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pinned(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and what was decided once stays decided. The write's shuffle files go when
    it ends, so the disk holds one step's shuffles at a time.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, *cols: str) -> DataFrame:
    """The named input columns alone, so extra columns can never clash.

    Also names this package's folder to Python workers, as
    ``spark.executorEnv.PYTHONPATH`` would; a cluster that ships the package
    with ``--py-files`` doesn't need it.
    """
    env = df.sparkSession.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return df.select(*cols)


def text_bytes(col="text"):
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")
