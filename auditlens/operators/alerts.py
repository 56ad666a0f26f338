"""Alert output (A01-A03): a fixed 7-column row per finding, the finding as JSON.

``alert_id`` is the finding's de-duplication key (F02: SHA-256 over the
canonical payload text), stable across runs, so re-running a window inserts
nothing new; not a random id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import json_text
from .findings import dedupe_key, earliest, insert_new, read_stored

# Names and types of an alert's columns.
ALERTS_SCHEMA = T.StructType([
    T.StructField("alert_id", T.StringType(), False),
    T.StructField("alertTime", T.TimestampType(), True),
    T.StructField("eventTime", T.TimestampType(), True),
    T.StructField("user_email", T.StringType(), True),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("source_ip", T.StringType(), True),
    T.StructField("event_data", T.StringType(), True),
])

#: Partition column of the stored alerts.
ALERT_DATE = "alert_date"
STORED_SCHEMA = T.StructType([*ALERTS_SCHEMA.fields, T.StructField(ALERT_DATE, T.DateType())])


def to_alerts(df: DataFrame, time_col: str = "EVENT_DATE", user_col: str = "SRC_USER",
              type_col: str = "ACTION", ip_col: str = "SRC_IP") -> DataFrame:
    """Needs EVENT_DATE, SRC_USER, ACTION and SRC_IP (names configurable)."""
    payload = json_text(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return (df.select(dedupe_key(df).alias("alert_id"),
                      F.current_timestamp().alias("alertTime"),
                      F.col(time_col).cast("timestamp").alias("eventTime"),
                      F.col(user_col).alias("user_email"),
                      F.col(type_col).alias("event_type"),
                      F.col(ip_col).alias("source_ip"),
                      payload.alias("event_data"))
            .na.fill({"user_email": "unknown", "source_ip": "unknown"}))


def write_alerts(alerts: DataFrame, path: str) -> int:
    """Insert-only merge on alert_id (A02), by the day of the event. Returns the number of new alerts."""
    rows = alerts.withColumn("alertTime", F.current_timestamp()).select(*ALERTS_SCHEMA.names)
    return insert_new(rows.withColumn(ALERT_DATE, F.to_date("eventTime")), path, keys=["alert_id"],
                      partition_by=[ALERT_DATE], schema=STORED_SCHEMA)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The stored alerts, each once: the one raised first."""
    stored = read_stored(spark, path, STORED_SCHEMA)
    if stored is None:
        return spark.createDataFrame([], ALERTS_SCHEMA)
    return earliest(stored, [ALERT_DATE, "alert_id"], ["alertTime", "batch"]).select(*ALERTS_SCHEMA.names)
