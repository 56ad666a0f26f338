"""Stateless rules on a stream (extension; the mirrored rule set is batch only).

The audit source is read with ``readStream``; in ``foreachBatch`` every
micro-batch is persisted once, goes through the single-scan operator and is
merged insert-only into the unified findings table: only the stored rules and
days that the batch touches are read, and a replayed batch after a failure
inserts nothing twice. Progress lives in the checkpoint location, which must be on
shared storage (``spark.checkpoint.dir`` by default).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import findings as FN
from ..plans.single_scan import single_scan, stateless_rules
from ..session import checkpoint_dir
from ..sources import Tables
from ..sources import projection as PR


def stream_events_audit(spark: SparkSession, events_path: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming audit frame derived from an events parquet source."""
    # A stream source is a folder; a single file is one match of a pattern on its folder
    # (a folder of that name matches too). Spark resolves both, on any store.
    folder, _, name = events_path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(spark.read.parquet(events_path).schema).option("basePath", folder)
    events_path = f"{folder}/{name[0]}[{name[1]}]{name[2:]}"
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return PR.audit_from_events(reader.parquet(events_path))


def start_findings_stream(audit_stream: DataFrame, root: str, earliest, latest,
                          rule_ids: list[str] | None = None, checkpoint: str | None = None,
                          run_id: str = "stream", available_now: bool = True):
    """Start the query; returns the StreamingQuery."""
    spark = audit_stream.sparkSession
    ids = [r.rule_id for r in stateless_rules(rule_ids)]

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        # The micro-batch is materialised once and every rule reads it.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = single_scan(Tables(audit=batch), earliest, latest, rule_ids=ids)
            unified = found.select(
                "event_ts", "event_date", "rule_id", F.lit(run_id).alias("run_id"),
                F.lit(earliest).cast("timestamp").alias("window_start_ts"),
                F.lit(latest).cast("timestamp").alias("window_end_ts"), "severity",
                F.current_timestamp().alias("observed_at"), "payload_json", "dedupe_key")
            FN.merge_unified(unified, root)
        finally:
            batch.unpersist()

    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/auditlens-stream-{run_id}"
    w = audit_stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
