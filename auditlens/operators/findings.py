"""Findings (F01-F05): standardised rows, stable de-duplication keys,
insert-only merging into parquet tables.

* F01 ``standardize``: rule_id, run_id, window bounds, severity, observed_at.
* F02 ``dedupe_key``: SHA-256 of ``concat_ws('||', ...)`` over the payload
  leaves sorted by name, each cast to text with NULL -> ''. Maps become
  sorted ``k=v;...`` text, arrays sorted text, structs one leaf per field,
  floating values fixed-point text with 9 decimals, so the key depends
  neither on entry order nor on the engine's number formatting. (NULL and '' collide, as do
  values containing '||'; documented.)
* F03/F05 ``insert_new``: rows whose key is new are appended; duplicates
  inside the batch are dropped too. MERGE needs a table format parquet lacks,
  so this is a left-anti join against the keys stored in the batch's own
  partitions, followed by an append. Every append has a folder of its own
  (``batch=<id>``): two writers never commit over each other. If both insert
  the same new key, readers keep the earlier observation.
* F03 tables grow columns: their schema is the union of what was appended,
  kept beside them, so a reader opens no file footer to learn it.
* F04 ``to_unified``: one 10-column shape for every rule.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import array_text, json_text, map_text
from .control import append_rows, read_appended, schema_of

META_COLUMNS = ["rule_id", "run_id", "window_start_ts", "window_end_ts", "severity",
                "observed_at", "dedupe_key"]
EXCLUDED_FROM_KEY = set(META_COLUMNS)
UNIFIED_SCHEMA = schema_of(
    "event_ts timestamp, event_date date, rule_id string, run_id string, window_start_ts timestamp,"
    " window_end_ts timestamp, severity string, observed_at timestamp, payload_json string, dedupe_key string")
UNIFIED_COLUMNS = ["event_ts", "event_date", "rule_id", "run_id", "window_start_ts",
                   "window_end_ts", "severity", "observed_at", "payload_json", "dedupe_key"]


def leaves(schema: T.StructType, exprs: dict[str, Column] | None = None
           ) -> list[tuple[str, Column]]:
    """(name, canonical text column) per leaf; ``exprs`` gives top-level
    columns as expressions (used by the single-scan operator)."""
    out = []
    for f in schema.fields:
        c = exprs[f.name] if exprs else F.col(f"`{f.name}`")
        out.extend(_leaf(f.name, c, f.dataType))
    return out


def _leaf(name: str, c: Column, dt: T.DataType) -> list[tuple[str, Column]]:
    if isinstance(dt, T.StructType):
        res = []
        for sf in dt.fields:
            res.extend(_leaf(f"{name}_{sf.name}", c.getField(sf.name), sf.dataType))
        return res
    if isinstance(dt, T.MapType):
        return [(name, map_text(c))]
    if isinstance(dt, T.ArrayType):
        return [(name, array_text(c.cast(T.ArrayType(T.StringType()))))]
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return [(name, float_text(c))]
    return [(name, c.cast("string"))]


def float_text(c: Column) -> Column:
    """Engine-neutral text of a floating value: fixed point, 9 decimals
    (plain float text switches to exponent notation differently per engine)."""
    return F.coalesce(c.try_cast(T.DecimalType(38, 9)).cast("string"), c.cast("string"))


def key_of(named: list[tuple[str, Column]]) -> Column:
    parts = [F.coalesce(c, F.lit("")) for _, c in sorted(named, key=lambda x: x[0])]
    return F.sha2(F.concat_ws("||", *parts), 256)


def dedupe_key(df: DataFrame) -> Column:
    schema = T.StructType([f for f in df.schema.fields if f.name not in EXCLUDED_FROM_KEY])
    return key_of(leaves(schema))


def sorted_map(c: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(c)))


def payload_struct(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Struct of the payload columns with maps in sorted-key order."""
    fields = [f for f in df.schema.fields
              if f.name not in EXCLUDED_FROM_KEY and (columns is None or f.name in columns)]
    return F.struct(*[(sorted_map(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType)
                       else F.col(f"`{f.name}`")).alias(f.name) for f in fields])


def standardize(df: DataFrame, rule_id: str, run_id: str, window_start: Column,
                window_end: Column, severity: str) -> DataFrame:
    """F01 + F02. The key and the payload JSON are taken from the rule's own
    columns; a rule column whose name equals a metadata name (case-blind,
    e.g. D19's SEVERITY) is kept as ``payload_<name>``."""
    key = dedupe_key(df)
    payload = json_text(payload_struct(df))
    meta = {m.lower() for m in META_COLUMNS + ["_payload_json"]}
    cols = [F.col(f"`{c}`").alias(f"payload_{c}" if c.lower() in meta else c) for c in df.columns]
    return df.select(
        *cols, F.lit(rule_id).alias("rule_id"), F.lit(run_id).alias("run_id"),
        window_start.cast("timestamp").alias("window_start_ts"),
        window_end.cast("timestamp").alias("window_end_ts"),
        F.lit(severity).alias("severity"), F.current_timestamp().alias("observed_at"),
        key.alias("dedupe_key"), payload.alias("_payload_json"))


def to_unified(std: DataFrame, time_col: str | None) -> DataFrame:
    """F04 from a standardised per-rule frame."""
    ts = (F.col(f"`{time_col}`").cast("timestamp") if time_col and time_col in std.columns
          else F.current_timestamp())
    return std.select(ts.alias("event_ts"), F.to_date(ts).alias("event_date"), "rule_id",
                      "run_id", "window_start_ts", "window_end_ts", "severity", "observed_at",
                      F.col("_payload_json").alias("payload_json"), "dedupe_key")


# --- insert-only tables --------------------------------------------------------
def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path`` by a known schema; None where nothing has been written yet."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _in_partitions(rows: list, columns: list[str]) -> Column:
    """Whether a stored row's partition values occur among ``rows`` (each column by itself)."""
    conds = []
    for c in columns:
        values = {r[c] for r in rows}
        cond = F.col(c).isin(sorted(v for v in values if v is not None))
        conds.append(cond | F.col(c).isNull() if None in values else cond)
    return reduce(lambda x, y: x & y, conds)


def insert_new(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None,
               schema: T.StructType | None = None) -> int:
    """Insert-only merge. Returns the number of rows appended.

    The batch is de-duplicated on ``keys``, and keys already stored in the
    partitions it touches are removed by a left-anti join; a key must always
    fall into the same partition (findings: the key covers rule and event
    time). Only the partition values, a few per rule and day, come to the
    driver. ``schema``: of the stored table, if it has more columns than the batch.
    Rows are rebalanced by partition before the write, so a partition gets one
    file unless it is large.
    """
    spark = df.sparkSession
    parts = partition_by or []
    schema = schema or df.schema
    batch = df.dropDuplicates(keys).persist(StorageLevel.MEMORY_AND_DISK)
    fresh = None
    try:
        touched = batch.groupBy(*parts).count().collect() if parts else []
        existing = read_stored(spark, path, schema)
        fresh = batch
        if existing is not None and (touched or not parts):
            if parts:
                existing = existing.filter(_in_partitions(touched, parts))
            fresh = batch.join(existing.select(*keys), keys, "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        n = fresh.count()
        if n:
            # By partition, split where one is large (adaptive execution); without partitions by size alone.
            w = fresh.hint("rebalance", *parts).write
            (w.partitionBy(*parts) if parts else w).parquet(f"{path.rstrip('/')}/batch={uuid.uuid4().hex}")
        return n
    finally:
        if fresh is not None:
            fresh.unpersist()
        batch.unpersist()


def merge_unified(unified: DataFrame, root: str) -> int:
    """unified table partitioned by rule and day."""
    return insert_new(unified.select(*UNIFIED_COLUMNS), f"{root.rstrip('/')}/unified", ["rule_id", "dedupe_key"],
                      partition_by=["rule_id", "event_date"], schema=UNIFIED_SCHEMA)


def earliest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one observed first."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order)).alias("_r"))
    return one.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def read_unified(spark: SparkSession, root: str) -> DataFrame:
    """The unified findings, each key once (the earliest observation). Filters on rule_id
    and event_date reach the partitions."""
    stored = read_stored(spark, f"{root.rstrip('/')}/unified", UNIFIED_SCHEMA)
    if stored is None:
        return spark.createDataFrame([], UNIFIED_SCHEMA)
    return earliest(stored, ["rule_id", "event_date", "dedupe_key"], ["observed_at", "batch"]).select(*UNIFIED_COLUMNS)


# --- F03: per-rule tables whose columns may grow --------------------------------
#: Partition column of the per-rule tables: the day of the finding's event time.
FINDING_DATE = "finding_date"
_SCHEMA_ROWS = schema_of("rule_id string, schema_json string, updated_at timestamp")
_WHOLE_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaConflict(ValueError):
    """A column came with a type that can't be stored beside the known one."""


def nullable(dt: T.DataType) -> T.DataType:
    """The type with every nested value nullable, as files are read back."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(nullable(dt.elementType))
    if isinstance(dt, T.MapType):
        return T.MapType(nullable(dt.keyType), nullable(dt.valueType))
    return dt


def wider_type(known: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds both without loss, if there is one."""
    if known == new or isinstance(new, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return new
    if known in _WHOLE_NUMBERS and new in _WHOLE_NUMBERS:
        return max(known, new, key=_WHOLE_NUMBERS.index)
    if {known, new} == {T.FloatType(), T.DoubleType()} or {known, new} <= {*_WHOLE_NUMBERS[:3], T.DoubleType()}:
        return T.DoubleType()
    return None


def union_schema(known: T.StructType, new: T.StructType) -> T.StructType:
    """``known`` plus the columns it lacks. Names are compared without case (the known
    spelling stays); a type may only widen."""
    out = {f.name.lower(): T.StructField(f.name, f.dataType) for f in known.fields}
    for f in nullable(new).fields:
        had = out.setdefault(f.name.lower(), T.StructField(f.name, f.dataType))
        wide = wider_type(had.dataType, f.dataType)
        if wide is None:
            raise SchemaConflict(f"column {had.name} is {had.dataType.simpleString()}, not {f.dataType.simpleString()}")
        out[f.name.lower()] = T.StructField(had.name, wide)
    return T.StructType(list(out.values()))


def stored_rule_schema(spark: SparkSession, root: str, rule_id: str) -> T.StructType | None:
    """The union of all schemas appended to a rule's table, from the schema table beside it."""
    rows = (read_appended(spark, f"{root.rstrip('/')}/rule_schemas", _SCHEMA_ROWS)
            .filter(F.col("rule_id") == rule_id).orderBy("updated_at", "append").collect())  # one row per change
    if not rows:
        return None
    return reduce(union_schema, [T.StructType.fromJson(json.loads(r.schema_json)) for r in rows])


def as_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df``'s columns in the stored spelling and type."""
    stored = {f.name.lower(): f for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(stored[c.lower()].dataType).alias(stored[c.lower()].name)
                       for c in df.columns])


def merge_rule_findings(rows: DataFrame, root: str, rule_id: str) -> int:
    """per-rule table (rule columns + metadata + the finding's day, by which it is partitioned)."""
    spark, root = rows.sparkSession, root.rstrip("/")
    known = stored_rule_schema(spark, root, rule_id)
    schema = union_schema(known or T.StructType([]), rows.schema)
    if known != schema:
        # Before the rows: a reader may know a column that no file has yet, never the reverse.
        append_rows(spark.createDataFrame([(rule_id, schema.json())], "rule_id string, schema_json string")
                    .withColumn("updated_at", F.current_timestamp()), f"{root}/rule_schemas", _SCHEMA_ROWS)
    return insert_new(as_stored(rows, schema), f"{root}/rules/rule_id={rule_id}", ["dedupe_key"],
                      partition_by=[FINDING_DATE], schema=schema)


def read_rule_findings(spark: SparkSession, root: str, rule_id: str) -> DataFrame:
    """A rule's findings with all columns its table ever had, each key once; no footer is
    opened to learn them."""
    schema = stored_rule_schema(spark, root, rule_id)
    if schema is None:
        raise ValueError(f"no findings table of {rule_id} in {root}")
    stored = read_stored(spark, f"{root.rstrip('/')}/rules/rule_id={rule_id}", schema)
    if stored is None:
        return spark.createDataFrame([], schema)
    return earliest(stored, [FINDING_DATE, "dedupe_key"], ["observed_at", "batch"]).drop("batch")
