"""Single-scan multi-rule operator (F07 core).

All stateless audit rules are evaluated in one pass over the audit table:
each row gets the list of rule ids whose window and predicate it matches,
the list is exploded to (rule_id, row) pairs, and the rule's projection,
payload, event time and de-duplication key are selected by a CASE on
rule_id. One scan, one projection, no shuffle; the scan filter is the union
of the rule windows and of the actions the rules can match, both pushed to
parquet. The result has the unified findings shape (F04) without the run
metadata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import json_text
from ..functions.time import window_bounds, window_filter
from ..operators.catalog import Rule, catalog
from ..operators.findings import key_of, leaves
from ..functions.predicates import action, any_of
from ..operators.rules_stateless import STATELESS_AUDIT_IDS


def _case(rule_col: Column, by_rule: dict[str, Column]) -> Column:
    expr = None
    for rid, c in by_rule.items():
        expr = F.when(rule_col == rid, c) if expr is None else expr.when(rule_col == rid, c)
    return expr


def stateless_rules(ids: list[str] | None = None) -> list[Rule]:
    cat = catalog()
    return [cat[i] for i in (ids or STATELESS_AUDIT_IDS)
            if cat[i].stateless is not None and cat[i].source == "audit"]


def touched(rules: list[Rule]) -> Column | None:
    """A superset of the rules' predicates in plain column tests: one IN list of all their
    actions, and what they look for besides. None if a rule states neither."""
    specs = [r.stateless for r in rules]
    if not all(s.actions or s.touches for s in specs):
        return None
    actions = sorted({a for s in specs for a in s.actions})
    return any_of(([action(*actions)] if actions else []) + [s.touches() for s in specs if s.touches])


def single_scan(tables, earliest=None, latest=None, rule_ids: list[str] | None = None,
                windows: dict[str, tuple] | None = None, params: dict | None = None) -> DataFrame:
    """Findings of many stateless rules from one scan.

    ``windows`` may give a rule its own (earliest, latest); otherwise each
    rule uses ``earliest``/``latest`` with its own default lookback.
    Output: rule_id, severity, event_ts, event_date, payload_json, dedupe_key.
    """
    rules = stateless_rules(rule_ids)
    params = params or {}
    bounds = {}
    for r in rules:
        e, l = (windows or {}).get(r.rule_id, (earliest, latest))
        bounds[r.rule_id] = window_bounds(e, l, r.lookback)
    lo = F.least(*[b[0] for b in bounds.values()]) if len(bounds) > 1 else next(iter(bounds.values()))[0]
    hi = F.greatest(*[b[1] for b in bounds.values()]) if len(bounds) > 1 else next(iter(bounds.values()))[1]
    audit = window_filter(tables.audit, "event_time", lo, hi)
    if (superset := touched(rules)) is not None:
        audit = audit.filter(superset)

    hits = []
    for r in rules:
        p = {**r.defaults, **params.get(r.rule_id, {})}
        rlo, rhi = bounds[r.rule_id]
        cond = (F.col("event_time") >= rlo) & (F.col("event_time") <= rhi) & r.stateless.predicate(**p)
        hits.append(F.when(cond, F.lit(r.rule_id)))
    # The ids as one text, cut again: every predicate is evaluated once a row. (A filter
    # on any hit before, or the one Spark infers for a plain explode, evaluates them again.)
    # concat_ws leaves NULLs out; no lambda keeps the stage in generated code.
    matched = (audit.withColumn("rule_id", F.explode_outer(F.split(F.concat_ws(",", *hits), ",")))
               .filter(F.col("rule_id") != ""))

    # Output schemas of all rules, resolved in one analysis of an empty frame
    # with the audit schema (no job; cheaper than analysing the source plan).
    spark = audit.sparkSession
    cols_by_rule = {r.rule_id: r.stateless.columns(**{**r.defaults, **params.get(r.rule_id, {})})
                    for r in rules}
    probe = [c for r in rules for c in cols_by_rule[r.rule_id]]
    fields = iter(spark.createDataFrame([], audit.schema).select(*probe).schema.fields)
    payload, key, ts, sev = {}, {}, {}, {}
    for r in rules:
        cols = cols_by_rule[r.rule_id]
        schema = T.StructType([next(fields) for _ in cols])
        names = schema.names
        by_name = dict(zip(names, cols))
        key[r.rule_id] = key_of(leaves(schema, by_name))
        payload[r.rule_id] = json_text(F.struct(*[
            _sorted_maps(by_name[f.name], f.dataType).alias(f.name) for f in schema.fields]))
        ts[r.rule_id] = by_name[r.time_col].cast("timestamp")
        sev[r.rule_id] = F.lit(r.severity)
    rid = F.col("rule_id")
    event_ts = _case(rid, ts)
    return matched.select(
        rid.alias("rule_id"), _case(rid, sev).alias("severity"),
        event_ts.alias("event_ts"), F.to_date(event_ts).alias("event_date"),
        _case(rid, payload).alias("payload_json"), _case(rid, key).alias("dedupe_key"))


def _sorted_maps(c: Column, dt) -> Column:
    if isinstance(dt, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(c)))
    return c
