"""Control tables (C01-C06): rule registry, checkpoints and run log.

All are plain Parquet tables that are only ever appended to, one folder per
append (``append=<id>``), so writers need not know of each other: nothing is
read before a write, rewritten, or committed over another job's output. What
is current is a query: per rule the latest non-null value of each column
(registry), or the latest attempt and the windows covered (checkpoints).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def schema_of(columns: str) -> T.StructType:
    """'a string, b timestamp' as a schema (atomic types; needs no session)."""
    kinds = {k.typeName(): k for k in (T.StringType, T.TimestampType, T.DateType, T.BooleanType, T.LongType)}
    kinds["bigint"] = T.LongType
    return T.StructType([T.StructField(n, kinds[k]()) for n, k in (c.split() for c in columns.split(","))])


# ---------------------------------------------------------------------------
# Column names and types of the control tables.
# ---------------------------------------------------------------------------
REGISTRY_SCHEMA = schema_of(
    "rule_id string, rule_group string, module_path string, callable_name string, severity string,"
    " created_at timestamp, updated_at timestamp, enabled boolean")
CHECKPOINT_SCHEMA = schema_of(
    "rule_id string, last_success_end_ts timestamp, last_attempt_start_ts timestamp,"
    " last_attempt_end_ts timestamp, last_status string, last_error string, updated_at timestamp")
ATTEMPT_SCHEMA = schema_of(
    "rule_id string, window_start_ts timestamp, window_end_ts timestamp, started_at timestamp,"
    " finished_at timestamp, status string, error_message string, updated_at timestamp")
RUN_LOG_SCHEMA = schema_of(
    "run_id string, rule_id string, window_start_ts timestamp, window_end_ts timestamp,"
    " started_at timestamp, finished_at timestamp, status string, row_count bigint,"
    " duration_ms bigint, runner_version string, error_message string, created_at timestamp")


# --- append-only tables -------------------------------------------------------
def append_rows(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Add the rows, missing columns as NULL, in a folder of their own."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    df.select(*cols).coalesce(1).write.parquet(f"{path.rstrip('/')}/append={uuid.uuid4().hex}")


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows ever appended, with the ``append`` they came in; none if nothing was written yet."""
    whole = T.StructType([*schema.fields, T.StructField("append", T.StringType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def _latest(value: Column | str, known: Column | None = None) -> Column:
    """The value appended last; with ``known`` the last for which that holds."""
    order = F.struct("updated_at", "append")
    return F.max_by(value, order if known is None else F.when(known, order))


# --- C01 / C02 / C06 registry ----------------------------------------------
def catalog_rows(spark: SparkSession, enabled: bool = True) -> DataFrame:
    """Registry rows for every rule in the catalog (the rule's own record)."""
    from .catalog import catalog
    rows = [(r.rule_id, r.group, f"auditlens.operators.{r.name}", r.name, r.severity, enabled)
            for r in catalog().values()]
    return spark.createDataFrame(
        rows, "rule_id string, rule_group string, module_path string, callable_name string,"
              " severity string, enabled boolean")


def upsert_registry(incoming: DataFrame, path: str) -> None:
    """New values of the given rules. NULL leaves a value as it is; the first
    append of a rule is its creation."""
    now = F.current_timestamp()
    append_rows(incoming.withColumn("created_at", now).withColumn("updated_at", now), path, REGISTRY_SCHEMA)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One current row per rule."""
    rows = read_appended(spark, path, REGISTRY_SCHEMA)
    kept = ["rule_group", "module_path", "callable_name", "severity", "enabled"]
    return (rows.groupBy("rule_id")
            .agg(F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"),
                 *[_latest(c, F.col(c).isNotNull()).alias(c) for c in kept])
            .select(*REGISTRY_SCHEMA.names))


def registry_exists(spark: SparkSession, path: str) -> bool:
    return not read_appended(spark, path, REGISTRY_SCHEMA).isEmpty()


def registry_summary(registry: DataFrame) -> DataFrame:
    """Rules per group."""
    return registry.groupBy("rule_group").agg(F.count(F.lit(1)).alias("rules"),
                                              F.sum(F.col("enabled").cast("int")).alias("enabled"))


def registry_listing(registry: DataFrame) -> DataFrame:
    """Ordered listing."""
    return registry.orderBy("rule_group", "rule_id")


def enabled_rules(registry: DataFrame) -> DataFrame:
    """C06."""
    return registry.filter(F.col("enabled"))


# --- C03 / C04 checkpoints ---------------------------------------------------
def seed_checkpoints(registry: DataFrame, path: str) -> None:
    """An empty checkpoint for every registered rule without one. A rule seeded by
    two writers at once still has one current row."""
    known = read_appended(registry.sparkSession, path, ATTEMPT_SCHEMA).select("rule_id")
    append_rows(registry.select("rule_id").distinct().join(known, "rule_id", "left_anti"), path, ATTEMPT_SCHEMA)


def update_checkpoints(runs: DataFrame, path: str) -> None:
    """C04 from run-log rows: each is one attempt at a window."""
    append_rows(runs.withColumn("updated_at", F.current_timestamp()), path, ATTEMPT_SCHEMA)


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """One row per rule: the latest end of a successful window, and the last attempt."""
    rows = read_appended(spark, path, ATTEMPT_SCHEMA)
    last = {"last_attempt_start_ts": "started_at", "last_attempt_end_ts": "finished_at",
            "last_status": "status", "last_error": "error_message"}
    return (rows.groupBy("rule_id")
            .agg(F.max(F.when(F.col("status") == "SUCCESS", F.col("window_end_ts"))).alias("last_success_end_ts"),
                 F.max("updated_at").alias("updated_at"),
                 _latest(F.struct(*[F.col(c).alias(k) for k, c in last.items()])).alias("_last"))
            .select("rule_id", "last_success_end_ts", *[f"_last.{k}" for k in last], "updated_at")
            .select(*CHECKPOINT_SCHEMA.names))


def covered_spans(spark: SparkSession, path: str) -> DataFrame:
    """(rule_id, span_start, span_end): the successful windows of each rule, those that
    touch or overlap joined into one. A gap between two windows stays a gap."""
    done = (read_appended(spark, path, ATTEMPT_SCHEMA)
            .filter((F.col("status") == "SUCCESS") & F.col("window_start_ts").isNotNull()))
    by_start = Window.partitionBy("rule_id").orderBy("window_start_ts", "window_end_ts")
    before = F.max("window_end_ts").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("window_start_ts") > before).cast("int"), F.lit(0))
    return (done.withColumn("_opens", opens).withColumn("_span", F.sum("_opens").over(by_start))
            .groupBy("rule_id", "_span")
            .agg(F.min("window_start_ts").alias("span_start"), F.max("window_end_ts").alias("span_end"))
            .drop("_span"))


# --- C05 run log ---------------------------------------------------------------
def run_log_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """One row per rule run; ``rows`` hold the driver-side run bookkeeping."""
    return spark.createDataFrame([{c: r.get(c) for c in RUN_LOG_SCHEMA.names} for r in rows], RUN_LOG_SCHEMA)


def append_run_log(log: DataFrame, path: str) -> None:
    append_rows(log, path, RUN_LOG_SCHEMA)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, RUN_LOG_SCHEMA).drop("append")
