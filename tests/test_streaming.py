import uuid

from auditlens.plans.single_scan import single_scan
from auditlens.session import checkpoint_dir
from auditlens.streaming.rules_stream import start_findings_stream, stream_events_audit

from conftest import SF_SMALL

ALL = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def test_stream_equals_batch_and_replay_adds_nothing(spark, small_tables):
    root = f"{checkpoint_dir(spark)}/s-{uuid.uuid4().hex}"
    for run in ("a", "b"):   # second run: fresh checkpoint = full replay
        q = start_findings_stream(stream_events_audit(spark, f"{SF_SMALL}/events.parquet"),
                                  root, *ALL, checkpoint=f"{root}/_ckpt_{run}")
        q.awaitTermination()
    got = spark.read.parquet(f"{root}/unified").select("rule_id", "dedupe_key")
    batch = single_scan(small_tables, *ALL).select("rule_id", "dedupe_key").distinct()
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0
