"""Per-user report (R05): the scoped report equals the all-users report's rows for that user."""

from pyspark.sql import functions as F

from auditlens.operators import reports as R
from auditlens.plans.threat_models import run_threat_model, user_report

ALL = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
USER = "user7@example.com"


def test_user_report_is_the_scoped_slice(spark, small_tables):
    rep = user_report(small_tables, USER, *ALL)
    everyone = R.ip_usage(small_tables, *ALL).filter(F.col("email") == USER)
    assert rep["ip_usage"].exceptAll(everyone).count() == 0
    assert everyone.exceptAll(rep["ip_usage"]).count() == 0
    summary = {r.rule_id: r for r in rep["summary"].collect()}
    assert "D30" not in summary and "D12" in summary     # custom group not scanned
    found = rep["findings"].groupBy("rule_id").count().collect()
    assert all(summary[r.rule_id].findings == r["count"] for r in found)


def test_approx_distinct_option(spark, small_tables):
    exact = {(r.email, r.service_name, r.action_name): r.num_source_ips
             for r in R.api_actions(small_tables, *ALL).collect()}
    approx = {(r.email, r.service_name, r.action_name): r.num_source_ips
              for r in R.api_actions(small_tables, *ALL, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= max(2, 0.1 * exact[k]) for k in exact)


def test_threat_model_scoped_to_user(spark, small_tables):
    import datetime as dt
    found, summary = run_threat_model(small_tables, "account_takeover", now=dt.datetime(2024, 1, 31),
                                      user=USER)
    assert summary.count() == 15
    assert found.filter(~F.col("payload_json").contains(USER)).count() == 0


def test_shared_threat_models_equal_per_model_runs(spark, small_tables):
    import datetime as dt
    from auditlens.plans.threat_models import THREAT_MODELS, run_threat_models
    now = dt.datetime(2024, 1, 31)
    _, shared = run_threat_models(small_tables, now=now)
    per_model = None
    for name in THREAT_MODELS:
        s = run_threat_model(small_tables, name, now=now)[1]
        per_model = s if per_model is None else per_model.unionByName(s)
    assert shared.exceptAll(per_model).count() == 0
    assert per_model.exceptAll(shared).count() == 0


def test_catalog_tables_loader(spark, small_tables):
    from auditlens.operators.catalog import get_rule
    from auditlens.sources import load_catalog_tables
    small_tables.audit.createOrReplaceTempView("audit_view_for_test")
    t = load_catalog_tables(spark, audit="audit_view_for_test")
    a = get_rule("D04").run(t, *ALL).count()
    assert a == get_rule("D04").run(small_tables, *ALL).count() > 0
