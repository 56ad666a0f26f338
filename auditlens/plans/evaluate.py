"""Evaluate many rules over their windows into one findings frame.

Stateless audit rules go through the single scan; every other rule runs on
a subset of the log that they share and is brought to the same shape (rule_id,
severity, event_ts, event_date, payload_json, dedupe_key). Nothing is collected.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import any_of
from ..functions.time import window_bounds, window_filter
from ..operators import findings as FN
from ..operators.catalog import Rule
from .single_scan import single_scan

FINDING_COLUMNS = ["rule_id", "severity", "event_ts", "event_date", "payload_json", "dedupe_key"]


def rule_findings(tables, rule: Rule, earliest, latest, **params) -> DataFrame:
    rows = rule.run(tables, earliest, latest, sort=False, output="rows", **params)
    key = FN.dedupe_key(rows)
    payload = FN.json_text(FN.payload_struct(rows))
    ts = (F.col(f"`{rule.time_col}`").cast("timestamp") if rule.time_col in rows.columns
          else F.current_timestamp())
    return rows.select(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.severity).alias("severity"),
                       ts.alias("event_ts"), F.to_date(ts).alias("event_date"),
                       payload.alias("payload_json"), key.alias("dedupe_key"))


def shared_subset(tables, rules: list[Rule], windows: dict[str, tuple]) -> tuple:
    """(tables, rules that use it): the audit rows that any of the stateful rules can use.

    Their pre-filters are OR-ed over the union of their windows, so the log is
    scanned once for all; the reduced rows are kept (``Tables.keep``) and the
    rules run on them. A rule's own filters and window still apply there.
    """
    shared = [r for r in rules if r.source == "audit" and r.prefilter is not None]
    if len(shared) < 2:
        return tables, []
    bounds = [window_bounds(*windows[r.rule_id], r.lookback) for r in shared]
    subset = window_filter(tables.audit, "event_time", F.least(*[b[0] for b in bounds]),
                           F.greatest(*[b[1] for b in bounds])).filter(any_of([r.prefilter() for r in shared]))
    return replace(tables, audit=tables.keep(subset, "stateful-rows")), shared


def evaluate(tables, rules: list[Rule], windows: dict[str, tuple],
             params: dict | None = None) -> DataFrame:
    """``windows``: rule_id -> (earliest, latest). The audit log is scanned twice
    whatever the number of rules: for the stateless rules and for the others' subset."""
    params = params or {}
    scan = [r for r in rules if r.stateless is not None and r.source == "audit"]
    parts = []
    if scan:
        parts.append(single_scan(tables, rule_ids=[r.rule_id for r in scan],
                                 windows={r.rule_id: windows[r.rule_id] for r in scan},
                                 params=params).select(*FINDING_COLUMNS))
    reduced, shared = shared_subset(tables, [r for r in rules if r not in scan], windows)
    for r in rules:
        if r in scan:
            continue
        e, l = windows[r.rule_id]
        parts.append(rule_findings(reduced if r in shared else tables, r, e, l, **params.get(r.rule_id, {})))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_summary(findings: DataFrame, rules: list[Rule]) -> DataFrame:
    """Findings per rule, right-joined to the rules that ran (a rule with
    no finding shows 0). The rule list is a small, bounded dimension."""
    spark = findings.sparkSession
    dim = spark.createDataFrame([(r.rule_id, r.name, r.group) for r in rules],
                                "rule_id string, name string, rule_group string")
    counts = findings.groupBy("rule_id").agg(F.count(F.lit(1)).alias("findings"))
    return (F.broadcast(dim).join(counts, "rule_id", "left")
            .select("rule_id", "name", "rule_group",
                    F.coalesce("findings", F.lit(0)).cast("bigint").alias("findings"),
                    (F.coalesce("findings", F.lit(0)) > 0).alias("triggered")))
