"""The runner: resumed windows, gaps, failing rules, the registry, several writers."""

import threading
import uuid
from dataclasses import replace

import pytest
from conftest import tables_of
from pyspark.sql import functions as F

from auditlens.operators import catalog as CAT
from auditlens.operators import control as C
from auditlens.operators import findings as FN
from auditlens.operators.catalog import get_rule
from auditlens.plans.runner import run_rules
from auditlens.session import checkpoint_dir

JAN = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def fresh_root(spark):
    return f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"


def found(spark, root, rule_id):
    return [r.payload_json for r in FN.read_unified(spark, root).filter(F.col("rule_id") == rule_id).collect()]


def login(t, ip="203.0.113.9", ua="Mozilla/5.0", **kw):
    return {"t": t, "action": "login", "session": "s", "ip": ip, "ua": ua, **kw}


def test_a_burst_cut_by_midnight_is_found(spark):
    secret = [{"t": f"2024-01-10 {h}", "service": "secrets", "action": "getSecret", "email": "b@x"}
              for h in ("23:10:00", "23:40:00")] + [
        {"t": "2024-01-11 00:05:00", "service": "secrets", "action": "getSecret", "email": "b@x"}]
    t = tables_of(spark, [login("2024-01-10 23:58:00"), login("2024-01-11 00:02:00", ip="203.0.113.10")] + secret)
    rules = ["D11", "D12", "D32"]
    whole, split = fresh_root(spark), fresh_root(spark)
    run_rules(t, whole, "2024-01-10", "2024-01-12", rule_ids=rules)
    first = run_rules(t, split, "2024-01-10", "2024-01-11", rule_ids=rules)
    assert not any(first.counts.values())
    second = run_rules(t, split, "2024-01-10", "2024-01-12", rule_ids=rules, resume=True)
    assert second.counts == {"D11": 1, "D12": 1, "D32": 1} and not second.failures
    assert found(spark, split, "D12") == found(spark, whole, "D12")
    for rid, count in (("D11", '"max_login_count":2'), ("D32", '"max_reads_in_window":3')):
        assert count in found(spark, split, rid)[0] and count in found(spark, whole, rid)[0]
    # Nothing new: nothing found again.
    assert not any(run_rules(t, split, "2024-01-10", "2024-01-12", rule_ids=rules, resume=True).counts.values())


def test_whole_groups_are_read_again(spark):
    uses = [login(f"2024-01-10 {h}", ua=ua) for h, ua in
            (("20:00:00", "A"), ("23:00:00", "A"))] + [login("2024-01-11 02:00:00", ua="B")]
    long_ago = [{**x, "email": "old@x", "t": "2024-01-09 00:00:00"} for x in uses[:1]] + [
        {**x, "email": "old@x"} for x in uses[1:]]
    t = tables_of(spark, uses + long_ago)
    root = fresh_root(spark)
    run_rules(t, root, "2024-01-08", "2024-01-11", rule_ids=["D13"])
    res = run_rules(t, root, "2024-01-08", "2024-01-12", rule_ids=["D13"], resume=True)
    whole = get_rule("D13").run(t, "2024-01-08", "2024-01-12").collect()
    # The other user's group is longer than a day, which only rows far before the cut show.
    assert [r.email for r in whole] == ["a@example.com"] and res.counts == {"D13": 1}
    assert '"first_seen":"2024-01-10T20:00:00' in found(spark, root, "D13")[0]


def test_no_gap_is_jumped_over(spark):
    day = lambda d: f"2024-01-{d:02d} 12:00:00"
    t = tables_of(spark, [{"t": day(d), "action": "createGroup"} for d in range(1, 7)])
    root = fresh_root(spark)
    run_rules(t, root, "2024-01-03", "2024-01-04", rule_ids=["D03"])
    run_rules(t, root, "2024-01-01", "2024-01-05", rule_ids=["D03"], resume=True)
    assert len(found(spark, root, "D03")) == 4          # the days before the first run too
    run_rules(t, root, "2024-01-06", "2024-01-07", rule_ids=["D03"])
    res = run_rules(t, root, "2024-01-01", "2024-01-07", rule_ids=["D03"], resume=True)
    assert len(found(spark, root, "D03")) == 6          # 5 January lay between two runs
    assert res.counts["D03"] == 2                       # read from the end of the first span
    spans = C.covered_spans(spark, f"{root}/checkpoints").collect()
    assert [(str(r.span_start)[:10], str(r.span_end)[:10]) for r in spans] == [("2024-01-01", "2024-01-07")]


def broken(monkeypatch, *ids, planning=False):
    """Make rules fail, at run time or while they are planned."""
    for rid in ids:
        rule = get_rule(rid)
        if planning:
            spec = replace(rule.stateless, columns=lambda **_: [F.col("no_such_column")])
        else:
            spec = replace(rule.stateless, predicate=lambda **_: F.raise_error(F.lit("broken rule")).cast("boolean"))
        monkeypatch.setitem(CAT._CATALOG, rid, replace(rule, stateless=spec))


@pytest.mark.parametrize("planning", [False, True])
def test_only_the_failing_rules_fail(spark, small_tables, monkeypatch, planning):
    from auditlens.operators.rules_stateless import STATELESS_AUDIT_IDS
    ids = [*STATELESS_AUDIT_IDS, "D12"]
    good = run_rules(small_tables, fresh_root(spark), *JAN, rule_ids=ids).counts
    broken(monkeypatch, "D04", "D27", planning=planning)
    root = fresh_root(spark)
    res = run_rules(small_tables, root, *JAN, rule_ids=ids)
    assert set(res.failures) == {"D04", "D27"}
    assert res.counts == {k: v for k, v in good.items() if k not in res.failures}
    stored = {r.rule_id: r["count"] for r in FN.read_unified(spark, root).groupBy("rule_id").count().collect()}
    assert not {"D04", "D27"} & set(stored) and stored["D03"] > 0 and stored["D12"] > 0
    log = {r.rule_id: r for r in C.read_run_log(spark, f"{root}/run_log").collect()}
    assert {k for k, r in log.items() if r.status == "FAILED"} == {"D04", "D27"}
    assert ("broken rule" in log["D04"].error_message) != planning and log["D04"].row_count is None


def test_absent_registry_is_an_error(spark, small_tables):
    root = fresh_root(spark)
    with pytest.raises(ValueError, match="no rule registry"):
        run_rules(small_tables, root, *JAN, rule_ids=["D04"], registry_path=f"{root}/nowhere")
    assert [(r.rule_id, r.status) for r in C.read_run_log(spark, f"{root}/run_log").collect()] == [("D04", "FAILED")]


def test_writers_at_once_leave_one_current_row_per_rule(spark):
    root = fresh_root(spark)
    errors = []

    def write(k):
        try:
            C.upsert_registry(C.catalog_rows(spark).withColumn("severity", F.lit(f"s{k}")), f"{root}/registry")
            log = C.run_log_rows(spark, [{"run_id": f"r{k}", "rule_id": "D04", "status": "SUCCESS"}])
            C.append_run_log(log, f"{root}/run_log")
            C.update_checkpoints(log, f"{root}/checkpoints")
            C.seed_checkpoints(C.read_registry(spark, f"{root}/registry"), f"{root}/checkpoints")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    reg = C.read_registry(spark, f"{root}/registry")
    assert reg.count() == reg.select("rule_id").distinct().count() == 33
    assert reg.select("severity").distinct().count() == 1            # one writer was last
    ck = C.read_checkpoints(spark, f"{root}/checkpoints")
    assert ck.count() == ck.select("rule_id").distinct().count() == 33
    assert C.read_run_log(spark, f"{root}/run_log").count() == 8     # no append was lost


def test_two_writers_of_findings_read_back_as_one(spark):
    root = fresh_root(spark)
    rows = spark.sql("SELECT timestamp'2024-01-05 10:00:00' + make_interval(0, 0, 0, CAST(id % 3 AS INT)) AS event_ts,"
                     " 'D01' AS rule_id, concat('k', id) AS dedupe_key, '{}' AS payload_json FROM range(50)")

    def of(run):
        return rows.select("event_ts", F.to_date("event_ts").alias("event_date"), "rule_id", F.lit(run).alias("run_id"),
                           *[F.lit(None).cast("timestamp").alias(c) for c in ("window_start_ts", "window_end_ts")],
                           F.lit("low").alias("severity"), F.current_timestamp().alias("observed_at"), "payload_json",
                           "dedupe_key")

    threads = [threading.Thread(target=FN.merge_unified, args=(of(f"r{k}"), root)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert FN.merge_unified(of("late"), root) == 0
    once = FN.read_unified(spark, root)
    assert once.count() == once.select("dedupe_key").distinct().count() == 50
    stored = FN.read_stored(spark, f"{root}/unified", FN.UNIFIED_SCHEMA)
    first = {r.dedupe_key: r.t for r in stored.groupBy("dedupe_key").agg(F.min("observed_at").alias("t")).collect()}
    assert all(first[r.dedupe_key] == r.observed_at for r in once.collect())
    # One file per day and append at this size.
    assert len(stored.inputFiles()) <= 3 * 4
    plan = once.filter("rule_id = 'D01' AND event_date = date'2024-01-06'")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "rule_id" in filters and "event_date" in filters


def test_rule_table_grows_columns(spark):
    root = fresh_root(spark)

    def put(sql):
        return FN.merge_rule_findings(spark.sql(
            f"SELECT {sql}, current_timestamp() AS observed_at, date'2024-01-05' AS finding_date"), root, "D99")

    assert put("'k1' AS dedupe_key, 1 AS n, 'x' AS Name") == 1
    assert put("'k2' AS dedupe_key, 2 AS n, 'y' AS NAME, array('a') AS tags") == 1      # case clash, new column
    assert put("'k3' AS dedupe_key, 5000000000 AS n") == 1                              # widened, a column missing
    with pytest.raises(FN.SchemaConflict, match="n is bigint, not string"):
        put("'k4' AS dedupe_key, 'text' AS n")
    rows = {r.dedupe_key: r for r in FN.read_rule_findings(spark, root, "D99").collect()}
    assert {k: (r.n, r.Name, r.tags) for k, r in rows.items()} == {
        "k1": (1, "x", None), "k2": (2, "y", ["a"]), "k3": (5000000000, None, None)}
    assert put("'k1' AS dedupe_key, 1 AS n") == 0
    assert FN.stored_rule_schema(spark, root, "D99")["n"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="no findings table"):
        FN.read_rule_findings(spark, root, "D98")


def test_rule_tables_come_from_the_evaluated_rows(spark, small_tables):
    root = fresh_root(spark)
    res = run_rules(small_tables, root, *JAN, rule_ids=["D12", "D13", "D19", "D28"], write_rule_tables=True)
    for rid in ("D12", "D13", "D19", "D28"):
        rows = FN.read_rule_findings(spark, root, rid)
        assert rows.count() == FN.read_unified(spark, root).filter(F.col("rule_id") == rid).count() > 0
        assert rows.select("dedupe_key").exceptAll(
            FN.read_unified(spark, root).filter(F.col("rule_id") == rid).select("dedupe_key")).count() == 0
    assert res.inserted_unified > 0
