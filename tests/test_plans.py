"""Physical plans: pushdown, pruning, no shuffle in the single scan."""

import uuid
from dataclasses import replace

from auditlens.operators.catalog import get_rule
from auditlens.operators.reports import api_actions, token_usage
from auditlens.plans.evaluate import evaluate
from auditlens.plans.single_scan import single_scan
from auditlens.session import checkpoint_dir, written
from auditlens.sources import Tables

ALL = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_audit(spark, small_tables):
    path = f"{checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}"
    small_tables.audit.write.parquet(path)
    return Tables(audit=spark.read.parquet(path))


def test_rule_filters_and_columns_reach_the_scan(spark, small_tables):
    t = _stored_audit(spark, small_tables)
    plan = _plan(get_rule("D04").run(t, *ALL, sort=False))
    assert "PushedFilters: [IsNotNull(event_time), IsNotNull(service_name)" in plan
    assert "GreaterThanOrEqual(event_time" in plan and "EqualTo(action_name,mfaAddKey)" in plan
    # Only the columns the rule reads (nested fields pruned to the leaf).
    read_schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "request_params" not in read_schema and "session_id" not in read_schema


def test_single_scan_is_one_stage_without_shuffle(spark, small_tables):
    t = _stored_audit(spark, small_tables)
    plan = _plan(single_scan(t, *ALL))
    assert "Exchange" not in plan
    assert plan.count("FileScan parquet") == 1
    assert "GreaterThanOrEqual(event_time" in plan


def test_single_scan_pushes_the_rules_actions(spark, small_tables):
    t = _stored_audit(spark, small_tables)
    pushed = _plan(single_scan(t, *ALL)).split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "In(action_name" in pushed and "StringContains(user_agent,TruffleHog)" in pushed
    one = _plan(single_scan(t, *ALL, rule_ids=["D04"])).split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "mfaAddKey" in one and "TruffleHog" not in one


def test_stateful_rules_share_one_scan(spark, small_tables):
    t = _stored_audit(spark, small_tables)
    path = t.audit.inputFiles()[0].rsplit("/", 1)[0]
    kept = []
    t = replace(t, keep=lambda df, name: kept.append((name, df)) or written(df, name))
    rules = [get_rule(r) for r in ("D04", "D11", "D12", "D13", "D13b", "D14", "D32")]
    found = evaluate(t, rules, {r.rule_id: ALL for r in rules})
    scans = [df for df in [found, *[d for _, d in kept]] if path in "".join(df.inputFiles())]
    # The single scan, and one subset for the six stateful rules.
    assert len(scans) == 2 and [n for n, d in kept if path in "".join(d.inputFiles())] == ["stateful-rows"]


def test_token_scanning_reads_the_log_once(spark, small_tables):
    t = _stored_audit(spark, small_tables)
    path = t.audit.inputFiles()[0].rsplit("/", 1)[0]
    kept = []
    t = replace(t, keep=lambda df, name: kept.append(df) or written(df, name))
    df = get_rule("D14").run(t, *ALL)
    assert len(kept) == 1 and _plan(kept[0]).count("FileScan parquet") == 1
    assert path not in "".join(df.inputFiles())


def test_session_rules_collect_lists_after_the_filter(spark, small_tables):
    kept = []
    t = replace(small_tables, keep=lambda df, name: kept.append(df) or written(df, name))
    plan = _plan(get_rule("D13b").run(t, *ALL))
    assert "collect_set" not in _plan(kept[0])
    # Everything below the filter of groups (the build side of the semi-join) keeps least and greatest values.
    assert "LeftSemi" in plan and "collect_set" in plan.split("LeftSemi")[0]
    assert "collect_set" not in plan.split("LeftSemi", 1)[1]


def test_reports_do_not_expand(spark, small_tables):
    for fn in (api_actions, token_usage):
        assert "Expand" not in _plan(fn(small_tables, *ALL))


def test_single_scan_evaluates_a_predicate_once(spark, small_tables):
    t = _stored_audit(spark, small_tables)
    # Known only to D01's predicate: an agent that it leaves out.
    assert _plan(single_scan(t, *ALL, rule_ids=["D01", "D04"])).count("linux auth") == 1
