"""

Every query reads the whole test tables (the audit log, query history,
billing and IP ranges are derived from them by Spark) and returns plain
column types (see :func:`auditlens.functions.text.flatten_for_compare`).
Each key has an equivalent DuckDB query in ``oracle_sql`` unless noted.
"""

from __future__ import annotations

import datetime as _dt
import importlib.util
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens import oracle as O
from auditlens.functions.text import flatten_for_compare, json_content
from auditlens.functions.ip import is_public_ip
from auditlens.operators import findings as FN
from auditlens.operators import reports as R
from auditlens.operators.alerts import read_alerts, write_alerts
from auditlens.operators.catalog import get_rule
from auditlens.operators.enrich import asn_enrich, geo_enrich
from auditlens.operators.rules_stateless import STATELESS_AUDIT_IDS
from auditlens.plans.evaluate import evaluate, run_summary
from auditlens.operators.control import read_run_log
from auditlens.plans.runner import RUNNER_VERSION, run_rule, run_rules
from auditlens.plans.single_scan import single_scan
from auditlens.plans.threat_models import THREAT_MODELS, run_threat_models, user_reports
from auditlens.session import checkpoint_dir
from auditlens.sources import load_test_tables
from auditlens.sources import projection as PR
from auditlens.sources.tables import read_table
from auditlens.streaming.rules_stream import start_findings_stream, stream_events_audit

def _present(module: str) -> bool:
    """Whether a module is installed; one that is there but fails to import still raises."""
    try:
        return importlib.util.find_spec(module) is not None
    except ModuleNotFoundError:
        return False


TEXT = importlib.import_module("auditlens.llm.entries") if _present("auditlens.llm.entries") else None
PIPELINE = importlib.import_module("corpus_pipeline") if TEXT and _present("corpus_pipeline") else None

SF_SMOKE = "/root/testdata/sf0.001"
ALL = O.WINDOW_ALL

# query key -> (rule id, window, params)
RULE_QUERIES: dict[str, tuple[str, tuple[str, str], dict]] = {
    "d01_access_token_created": ("D01", ALL, {}),
    "d02_access_token_deleted": ("D02", ALL, {}),
    "d03_group_created": ("D03", ALL, {}),
    "d04_mfa_key_added": ("D04", ALL, {}),
    "d05_mfa_key_deleted": ("D05", ALL, {}),
    "d06_non_sso_login_detected": ("D06", ALL, {}),
    "d07_data_movement_explicit_creds": ("D07", ALL, {}),
    "d08_data_movement_sql_queries": ("D08", ALL, {}),
    "d09_data_movement_workspace_downloads": ("D09", ALL, {}),
    "d10_principal_added_to_group": ("D10", ALL, {}),
    "d11_frequent_logins": ("D11", ALL, {}),
    "d11_frequent_logins_600s_4": ("D11", ALL, {"threshold_seconds": 600, "threshold_value": 4}),
    "d11_frequent_logins_60s_3": ("D11", ALL, {"threshold_seconds": 60, "threshold_value": 3}),
    "d12_multi_device": ("D12", ALL, {}),
    "d13_session_count": ("D13", ALL, {}),
    "d13b_session_spread": ("D13b", ALL, {}),
    "d13b_session_spread_day": ("D13b", O.WINDOW_DAY, {}),
    "d14_token_scanning": ("D14", ALL, {"threshold": 0.5}),
    "d15_user_account_created": ("D15", ALL, {}),
    "d16_user_password_changed": ("D16", ALL, {}),
    "d17_attempted_logon_from_denied_ip": ("D17", ALL, {}),
    "d18_config_changes_account_level": ("D18", ALL, {}),
    "d19_config_changes_high_priority": ("D19", ALL, {}),
    "d20_config_changes_workspace_level": ("D20", ALL, {}),
    "d21_vendor_employee_logon": ("D21", ALL, {}),
    "d22_group_deleted": ("D22", ALL, {}),
    "d23_principal_removed_from_group": ("D23", ALL, {}),
    "d24_sso_config_changed": ("D24", ALL, {}),
    "d25_trufflehog_scan_detected": ("D25", ALL, {}),
    "d26_user_account_deleted": ("D26", ALL, {}),
    "d26_user_account_deleted_cut_window": ("D26", O.WINDOW_CUT, {}),
    "d27_user_admin_account_change": ("D27", ALL, {}),
    "d28_user_role_modified": ("D28", ALL, {}),
    "d29_verbose_audit_logging_disabled": ("D29", ALL, {}),
    "d30_user_email_change": ("D30", ALL, {}),
    "d31_spike_in_table_admin_activity": ("D31", ALL, {}),
    "d32_secret_scanning_activity": ("D32", ALL, {}),
    "d32_secret_scanning_activity_day": ("D32", ALL, {"threshold_seconds": 86400,
                                                      "threshold_value": 2}),
}


def _rule_query(rule_id: str, window, params: dict, spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = load_test_tables(spark, sf_dir)
    df = get_rule(rule_id).run(tables, window[0], window[1], output="rows", **params)
    return flatten_for_compare(df)


def _rule_oracle(rule_id: str, window, params: dict) -> str:
    lo, hi = window
    if rule_id in O.STATELESS or rule_id == "D08":
        return O.stateless_sql(rule_id, lo, hi)
    fn = {"D11": O.d11_sql, "D12": O.d12_sql, "D13": O.d13_sql,
          "D13b": partial(O.d13_sql, corrected=True), "D14": O.d14_sql,
          "D31": O.d31_sql, "D32": O.d32_sql}[rule_id]
    return fn(lo, hi, **params)


# --- findings, enrichment, reports, threat models, pipeline, stream --------
BILLING_WINDOW = ("1995-01-01 00:00:00", "2002-01-01 00:00:00")
THREAT_NOW = _dt.datetime(2024, 1, 31)
ALL_RULE_IDS = ["D01", "D02", "D03", "D04", "D05", "D06", "D07", "D08", "D09", "D10", "D11",
                "D12", "D13", "D13b", "D14", "D15", "D16", "D17", "D18", "D19", "D20", "D21",
                "D22", "D23", "D24", "D25", "D26", "D27", "D28", "D29", "D30", "D31", "D32"]


def _all_windows():
    return {rid: ALL for rid in ALL_RULE_IDS}


def _compared(findings: DataFrame) -> DataFrame:
    """Findings with their payload's content."""
    return findings.select("rule_id", "severity", "event_ts", "event_date", "dedupe_key",
                           json_content("payload_json").alias("payload"))


def q_single_scan(spark, sf_dir):
    t = load_test_tables(spark, sf_dir)
    return _compared(single_scan(t, *ALL))


def q_all_findings(spark, sf_dir):
    t = load_test_tables(spark, sf_dir)
    rules = [get_rule(r) for r in ALL_RULE_IDS]
    return _compared(evaluate(t, rules, _all_windows()))


def q_run_summary(spark, sf_dir):
    t = load_test_tables(spark, sf_dir)
    rules = [get_rule(r) for r in ALL_RULE_IDS]
    return run_summary(evaluate(t, rules, _all_windows()), rules)


def q_threat_models(spark, sf_dir):
    """All seven models; every rule is evaluated once and shared by its models."""
    t = load_test_tables(spark, sf_dir)
    return run_threat_models(t, days=30, hours=24, now=THREAT_NOW)[1]


def _threat_windows():
    res = {}
    for m, ids in THREAT_MODELS.items():
        rws = []
        for rid in ids:
            span = (_dt.timedelta(hours=24) if get_rule(rid).group == "binary"
                    else _dt.timedelta(days=30))
            rws.append((rid, str(THREAT_NOW - span), str(THREAT_NOW)))
        res[m] = rws
    return res


def q_public_ip(spark, sf_dir):
    t = load_test_tables(spark, sf_dir)
    return (t.audit.groupBy("source_ip_address").agg(F.count(F.lit(1)).alias("events"))
            .withColumn("is_public", is_public_ip(F.col("source_ip_address"))))


def q_geo(spark, sf_dir):
    t = load_test_tables(spark, sf_dir)
    return flatten_for_compare(geo_enrich(t.audit.select("event_id", "source_ip_address"),
                                          "source_ip_address", t.ip_geo, out="geo"))


def q_asn(spark, sf_dir):
    t = load_test_tables(spark, sf_dir)
    return flatten_for_compare(asn_enrich(t.audit.select("event_id", "source_ip_address"),
                                          "source_ip_address", t.ip_asn, out="asn"))


def _report(fn, window):
    def q(spark, sf_dir):
        return fn(load_test_tables(spark, sf_dir), *window)
    return q


def q_alerts(spark, sf_dir):
    """D24 as alerts; ``alertTime`` (the run's wall clock) is left out."""
    t = load_test_tables(spark, sf_dir)
    return flatten_for_compare(get_rule("D24").run(t, *ALL).drop("alertTime"))


def q_pipeline_idempotent(spark, sf_dir):
    """Run every rule twice into a fresh findings root; the second run adds nothing."""
    t = load_test_tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-findings-{uuid.uuid4().hex}"
    for _ in range(2):
        run_rules(t, root, *ALL, rule_ids=ALL_RULE_IDS)
    return _compared(FN.read_unified(spark, root))


def q_resumed(spark, sf_dir):
    """All rules over a window that ends inside a login burst, then resumed to the end.

    Per rule: the stored findings' keys; for the burst rules each user's greatest
    burst (see :func:`auditlens.oracle.resumed_sql`)."""
    t = load_test_tables(spark, sf_dir)
    r = F.expr("event_id div 32")
    burst = read_table(spark, sf_dir, "events").filter(
        (F.col("event_id") % 32 >= 27) & (r % 7 != 6) & (r % 9 != 8) & (F.col("ts") >= "2024-01-15"))
    cut = burst.agg((F.min("ts") + F.expr("INTERVAL 200 SECOND")).cast("string")).first()[0]
    root = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-findings-{uuid.uuid4().hex}"
    run_rules(t, root, ALL[0], cut, rule_ids=ALL_RULE_IDS)
    run_rules(t, root, *ALL, rule_ids=ALL_RULE_IDS, resume=True)
    found = FN.read_unified(spark, root)
    peak = F.coalesce(*[F.when(F.col("rule_id") == rid, F.get_json_object("payload_json", f"$.{c}").cast("bigint"))
                        for rid, c in O.BURST_PEAKS.items()], F.lit(1))
    item = F.when(F.col("rule_id").isin(*O.BURST_PEAKS), F.get_json_object("payload_json", "$.email"))
    return (found.groupBy("rule_id", F.coalesce(item, F.col("dedupe_key")).alias("item"))
            .agg(F.max(peak).cast("bigint").alias("n")))


def q_rule_table(spark, sf_dir):
    """D19's own findings table (F03) after two runs over the same window."""
    t = load_test_tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-findings-{uuid.uuid4().hex}"
    for _ in range(2):
        run_rule(t, root, "D19", *ALL)
    return flatten_for_compare(FN.read_rule_findings(spark, root, "D19").drop(
        "run_id", "window_start_ts", "window_end_ts", "observed_at", FN.FINDING_DATE))


def q_alerts_written(spark, sf_dir):
    """D24's alerts (A02) written twice."""
    t = load_test_tables(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-alerts-{uuid.uuid4().hex}"
    for _ in range(2):
        write_alerts(get_rule("D24").run(t, *ALL), path)
    return flatten_for_compare(read_alerts(spark, path).drop("alertTime"))


def q_without_geo(spark, sf_dir):
    """D14 with no range table configured."""
    t = replace(load_test_tables(spark, sf_dir), ip_geo=None)
    return flatten_for_compare(get_rule("D14").run(t, *ALL, output="rows", threshold=0.5))


RUN_LOG_ID = "c05"


def q_run_log(spark, sf_dir):
    """One pipeline run over all rules; the run log it leaves (C05). Wall-clock columns as
    whether they are in order."""
    t = load_test_tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-findings-{uuid.uuid4().hex}"
    run_rules(t, root, *ALL, rule_ids=ALL_RULE_IDS, run_id=RUN_LOG_ID)
    return flatten_for_compare(read_run_log(spark, f"{root}/run_log").select(
        "run_id", "runner_version", "error_message", "rule_id", "status", "row_count", "window_start_ts", "window_end_ts",
        (F.col("started_at") <= F.col("finished_at")).alias("started_before_end"),
        F.col("duration_ms").between(0, F.unix_millis("finished_at") - F.unix_millis("started_at") + 1000).alias("lasted"),
        (F.col("created_at") == F.col("finished_at")).alias("created_at_end")))


def q_user_reports(spark, sf_dir):
    """R05 of every user that a secret scanner's request came from."""
    t = load_test_tables(spark, sf_dir)
    users = get_rule("D25").run(t, *ALL, sort=False).select(F.col("SRC_USER").alias("email")).distinct()
    got = user_reports(t, users, *ALL)
    out = got["summary"].select("email", F.col("rule_id").alias("item"), F.col("findings").alias("n"))
    for item, name in (("addresses", "ip_usage"), ("actions", "api_actions"), ("tokens", "token_usage")):
        out = out.unionByName(got[name].groupBy("email").agg(F.count(F.lit(1)).alias("n"))
                              .select("email", F.lit(item).alias("item"), "n"))
    return out


def q_stream(spark, sf_dir):
    """Stateless rules over a file stream of events, merged per micro-batch."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-stream-{uuid.uuid4().hex}"
    audit = stream_events_audit(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    start_findings_stream(audit, root, *ALL, checkpoint=f"{root}/_checkpoint").awaitTermination()
    return _compared(FN.read_unified(spark, root))


OTHER_QUERIES = {
    "f07_single_scan_stateless_rules": q_single_scan,
    "f04_findings_all_rules": q_all_findings,
    "r06_run_summary_all_rules": q_run_summary,
    "t02_threat_model_summaries": q_threat_models,
    "e01_is_public_ip": q_public_ip,
    "e04_geo_enrich": q_geo,
    "e05_asn_enrich": q_asn,
    "r01_ip_usage_per_user": _report(R.ip_usage, ALL),
    "r02_token_usage_per_user": _report(R.token_usage, ALL),
    "r03_api_actions_per_user": _report(R.api_actions, ALL),
    "r04_billing_usage_per_user": _report(R.billing_usage, BILLING_WINDOW),
    "f03_rule_table_twice": q_rule_table,
    "a02_alerts_written_twice": q_alerts_written,
    "e07_geo_not_configured": q_without_geo,
    "r05_user_reports": q_user_reports,
    "a01_alerts_sso_config_changed": q_alerts,
    "f05_merge_unified_twice": q_pipeline_idempotent,
    "f06_resumed_equals_whole": q_resumed,
    "c05_run_log_all_rules": q_run_log,
    "s01_stream_stateless_rules": q_stream,
}


def _other_oracles() -> dict[str, str]:
    all_rw = [(rid, *ALL) for rid in ALL_RULE_IDS]
    stateless_rw = [(rid, *ALL) for rid in STATELESS_AUDIT_IDS]
    return {
        "f07_single_scan_stateless_rules": O.findings_union_sql(stateless_rw),
        "f04_findings_all_rules": O.findings_union_sql(all_rw),
        "r06_run_summary_all_rules": O.run_summary_sql(all_rw),
        "t02_threat_model_summaries": O.threat_models_sql(_threat_windows()),
        "e01_is_public_ip": O.public_ip_sql(),
        "e04_geo_enrich": O.enrich_sql("ip_geo", PR.GEO_FIELDS, "geo"),
        "e05_asn_enrich": O.enrich_sql("ip_asn", PR.ASN_FIELDS, "asn"),
        "r01_ip_usage_per_user": O.ip_usage_sql(*ALL),
        "r02_token_usage_per_user": O.token_usage_sql(*ALL),
        "r03_api_actions_per_user": O.api_actions_sql(*ALL),
        "r04_billing_usage_per_user": O.billing_usage_sql(*BILLING_WINDOW),
        "f03_rule_table_twice": O.rule_table_sql("D19", *ALL),
        "a02_alerts_written_twice": O.alerts_sql("D24", *ALL, distinct=True),
        "e07_geo_not_configured": O.without_geo_sql(*ALL),
        "r05_user_reports": O.user_reports_sql(
            [r for r in ALL_RULE_IDS if get_rule(r).group in ("binary", "behavioral")], *ALL),
        "a01_alerts_sso_config_changed": O.alerts_sql("D24", *ALL),
        "f05_merge_unified_twice": O.findings_union_sql(all_rw, distinct=True),
        "f06_resumed_equals_whole": O.resumed_sql(ALL_RULE_IDS, ALL[0], O.CUT_IN_BURST, ALL[1]),
        "c05_run_log_all_rules": O.run_log_sql(all_rw, RUN_LOG_ID, RUNNER_VERSION),
        "s01_stream_stateless_rules": O.findings_union_sql(stateless_rw, distinct=True),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on the sf0.001 tables: findings per rule for all 33 rules
    (single scan for the stateless rules + the stateful rules), right-joined
    to the rule list."""
    return q_run_summary(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for key, (rid, window, params) in RULE_QUERIES.items():
        out[key] = partial(_rule_query, rid, window, params)
    out.update(OTHER_QUERIES)
    if TEXT is not None:
        out.update(TEXT.queries())
    if PIPELINE is not None:
        out["pipeline"] = PIPELINE.run
    return out


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, (rid, window, params) in RULE_QUERIES.items():
        out[key] = _rule_oracle(rid, window, params)
    out.update(_other_oracles())
    if TEXT is not None:
        out.update(TEXT.oracle_sql())
    if PIPELINE is not None and PIPELINE.ORACLE_SQL:
        out["pipeline"] = PIPELINE.ORACLE_SQL
    return out
