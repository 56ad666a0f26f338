"""Session helpers.

Rules compare ``event_time`` with literal bounds and do epoch arithmetic, so
the session time zone is pinned to UTC. Everything else is left to the
cluster's own configuration; the builder below is for local runs and tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


JIT_OPTS = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "auditlens", extra: dict | None = None) -> SparkSession:
    """Local/test session; on a cluster use the cluster's session and
    call :func:`ensure_utc` instead."""
    b = (SparkSession.builder.appName(app_name)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # No Python call-site capture per Column call (thousands of JVM round
         # trips when a plan has hundreds of expressions).
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("AUDITLENS_DRIVER_MEMORY", "8g"))
         # The single-scan stage evaluates all rule predicates and projections
         # in one generated method; HotSpot skips JIT for methods over 8 KB of
         # bytecode unless told otherwise (several times slower per row).
         .config("spark.driver.extraJavaOptions", JIT_OPTS)
         .config("spark.executor.extraJavaOptions", JIT_OPTS))
    if master:
        b = b.master(master)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Detection windows are UTC wall-clock (the reference uses UTC widgets)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session's configuration (or the context's checkpoint dir).
    Only when neither is set (local tests) a scratch folder is created and
    registered on the context; a cluster must configure a shared, durable
    location.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if not d:
        d = tempfile.mkdtemp(prefix="auditlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back by its schema.

    For a reduced frame that a plan uses more than once: it is computed once,
    and a lost executor costs a re-read. The folder is kept until whoever owns
    ``spark.checkpoint.dir`` clears it.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/auditlens-work/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
