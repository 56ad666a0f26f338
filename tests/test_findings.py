"""Findings pipeline: keys, insert-only merge, single scan, runner, control tables."""

import uuid

from pyspark.sql import functions as F

from auditlens.operators import control as C
from auditlens.operators import findings as FN
from auditlens.operators.catalog import get_rule
from auditlens.operators.rules_stateless import STATELESS_AUDIT_IDS
from auditlens.plans.evaluate import rule_findings
from auditlens.plans.runner import run_rules
from auditlens.plans.single_scan import single_scan
from auditlens.session import checkpoint_dir

ALL = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def fresh_root(spark):
    return f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"


def test_dedupe_key_ignores_map_order_and_null_equals_empty(spark):
    a = spark.createDataFrame([({"a": "1", "b": "2"}, "x")], "m map<string,string>, s string")
    b = spark.sql("SELECT map('b', '2', 'a', '1') AS m, 'x' AS s")
    assert a.select(FN.dedupe_key(a)).first()[0] == b.select(FN.dedupe_key(b)).first()[0]
    n = spark.createDataFrame([(None,), ("",)], "s string")
    keys = [r[0] for r in n.select(FN.dedupe_key(n)).collect()]
    assert keys[0] == keys[1]   # documented collision


def test_insert_only_merge_drops_batch_and_stored_duplicates(spark):
    root = fresh_root(spark)
    df = spark.createDataFrame([("k1", 1), ("k1", 1), ("k2", 2)], "dedupe_key string, v int")
    assert FN.insert_new(df, root, ["dedupe_key"]) == 2
    assert FN.insert_new(df, root, ["dedupe_key"]) == 0
    more = spark.createDataFrame([("k3", 3)], "dedupe_key string, v int")
    assert FN.insert_new(more, root, ["dedupe_key"]) == 1
    assert spark.read.parquet(root).count() == 3


def test_single_scan_equals_union_of_single_rules(spark, small_tables):
    ss = single_scan(small_tables, *ALL).select("rule_id", "event_ts", "payload_json", "dedupe_key")
    parts = None
    for rid in STATELESS_AUDIT_IDS:
        p = rule_findings(small_tables, get_rule(rid), *ALL).select(
            "rule_id", "event_ts", "payload_json", "dedupe_key")
        parts = p if parts is None else parts.unionByName(p)
    assert ss.count() == parts.count()
    assert ss.exceptAll(parts).count() == 0 and parts.exceptAll(ss).count() == 0


def test_window_split_equals_whole_window(spark, small_tables):
    whole = single_scan(small_tables, *ALL).select("rule_id", "dedupe_key")
    a = single_scan(small_tables, ALL[0], "2024-01-15 00:00:00").select("rule_id", "dedupe_key")
    b = (single_scan(small_tables, "2024-01-15 00:00:00", ALL[1])
         .filter(F.col("event_ts") > F.lit("2024-01-15 00:00:00").cast("timestamp"))
         .select("rule_id", "dedupe_key"))
    split = a.unionByName(b)
    assert whole.exceptAll(split).count() == 0 and split.exceptAll(whole).count() == 0


def test_runner_is_idempotent_and_logs(spark, small_tables):
    root = fresh_root(spark)
    reg = f"{root}/registry"
    C.upsert_registry(C.catalog_rows(spark), reg)
    # Disable one rule: it must not run.
    C.upsert_registry(spark.createDataFrame([("D25", False)], "rule_id string, enabled boolean")
                      .select("rule_id", F.lit(None).cast("string").alias("rule_group"),
                              F.lit(None).cast("string").alias("module_path"),
                              F.lit(None).cast("string").alias("callable_name"),
                              F.lit(None).cast("string").alias("severity"), "enabled"), reg)
    first = run_rules(small_tables, root, *ALL, registry_path=reg)
    assert "D25" not in first.counts and not first.failures
    assert first.inserted_unified > 0
    second = run_rules(small_tables, root, *ALL, registry_path=reg)
    assert second.inserted_unified == 0
    log = C.read_run_log(spark, f"{root}/run_log")
    assert log.filter(F.col("status") == "SUCCESS").count() == 2 * len(first.counts)
    ck = {r.rule_id: r for r in C.read_checkpoints(spark, f"{root}/checkpoints").collect()}
    assert ck["D12"].last_status == "SUCCESS"
    assert str(ck["D12"].last_success_end_ts) == "2024-02-01 00:00:00"
    # D19's SEVERITY column is kept apart from the severity metadata column.
    reg_rows = {r.rule_id: r for r in C.read_registry(spark, reg).collect()}
    assert reg_rows["D25"].enabled is False and reg_rows["D01"].enabled is True
    assert reg_rows["D25"].created_at <= reg_rows["D25"].updated_at


def test_runner_continues_after_a_failure(spark, small_tables):
    root = fresh_root(spark)
    # D14 needs an explicit earliest bound: it fails, the others still run.
    res = run_rules(small_tables, root, None, ALL[1], rule_ids=["D14", "D12"])
    assert "D14" in res.failures and "D12" in res.counts


def test_checkpoint_seeding(spark):
    root = fresh_root(spark)
    reg = f"{root}/registry"
    C.upsert_registry(C.catalog_rows(spark), reg)
    C.seed_checkpoints(C.read_registry(spark, reg), f"{root}/checkpoints")
    C.seed_checkpoints(C.read_registry(spark, reg), f"{root}/checkpoints")
    ck = C.read_checkpoints(spark, f"{root}/checkpoints")
    assert ck.count() == ck.select("rule_id").distinct().count() == len(C.catalog_rows(spark).collect())


def test_resume_starts_at_last_window_end(spark, small_tables):
    from auditlens.plans.runner import run_rule
    root = fresh_root(spark)
    first = run_rule(small_tables, root, "D04", ALL[0], "2024-01-15 00:00:00")
    resumed = run_rules(small_tables, root, ALL[0], ALL[1], rule_ids=["D04"], resume=True)
    log = C.read_run_log(spark, f"{root}/run_log").filter(F.col("run_id") == resumed.run_id).first()
    assert str(log.window_start_ts) == "2024-01-15 00:00:00"
    whole = get_rule("D04").run(small_tables, *ALL).count()
    assert first.counts["D04"] + resumed.inserted_unified == whole
    per_rule = FN.read_rule_findings(spark, root, "D04")
    assert per_rule.count() == first.counts["D04"]


def test_write_alerts_is_insert_only(spark, small_tables):
    from auditlens.operators.alerts import write_alerts
    root = fresh_root(spark)
    alerts = get_rule("D24").run(small_tables, *ALL)
    n = alerts.count()
    assert write_alerts(alerts, root) == n
    assert write_alerts(get_rule("D24").run(small_tables, *ALL), root) == 0


def test_listing_and_coverage(spark):
    from auditlens.operators.reports import detection_listing
    from auditlens.plans.threat_models import coverage
    rows = detection_listing(spark).collect()
    assert len(rows) == 33 and all(len(r.description) <= 103 for r in rows)
    cov = {r.threat_model: r for r in coverage(spark).collect()}
    assert cov["account_takeover"].rules == 15 and cov["supply_chain"].rules == 3
    assert cov["data_exfiltration"].documented == 2


def test_rule_view_from_unified_payload(spark, small_tables):
    from auditlens.plans.runner import rule_findings_from_unified
    root = fresh_root(spark)
    run_rules(small_tables, root, *ALL, rule_ids=["D13", "D19", "D01"])
    for rid in ["D13", "D19", "D01"]:
        view = rule_findings_from_unified(small_tables, root, get_rule(rid))
        direct = get_rule(rid).run(small_tables, *ALL, sort=False, output="rows")
        from auditlens.functions.text import flatten_for_compare
        named = [("payload_" + c) if c.lower() == "severity" else c for c in direct.columns]
        a = flatten_for_compare(view.select(*named).toDF(*direct.columns))
        b = flatten_for_compare(direct)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unknown_rule_raises_and_is_logged(spark, small_tables, tmp_path):
    import pytest

    from auditlens.operators.control import read_run_log
    from auditlens.plans.runner import run_rule
    with pytest.raises(ValueError):
        run_rule(small_tables, str(tmp_path), "D99", *ALL)
    assert [(r.rule_id, r.status) for r in read_run_log(spark, f"{tmp_path}/run_log").collect()] == [("D99", "FAILED")]


def test_merge_bounds_ignore_the_drivers_zone(spark, small_tables, tmp_path, monkeypatch):
    import time

    from auditlens.plans.runner import run_rules
    window = ("2024-01-05 20:00:00", "2024-01-25 07:00:00")
    for zone in ("Asia/Seoul", "America/Los_Angeles"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            first = run_rules(small_tables, f"{tmp_path}/{zone[:4]}", *window, rule_ids=["D04", "D11"])
            again = run_rules(small_tables, f"{tmp_path}/{zone[:4]}", *window, rule_ids=["D04", "D11"])
        finally:
            monkeypatch.delenv("TZ")
            time.tzset()
        assert first.inserted_unified > 0 and again.inserted_unified == 0
