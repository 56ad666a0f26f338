"""Rule runner (F06, F07): run rules over a window and keep the findings.

``run_rules`` plans all selected stateless audit rules through the
single-scan operator (one pass over the audit table) and the others one by
one over a shared subset, all into the unified findings shape. The union is
persisted once and counted per rule in one job, merged insert-only into the
unified table (and, on request, the per-rule tables); one run-log row per rule
is appended and the checkpoints are updated. A failing rule is logged as FAILED
and the run continues: if the job over all rules fails, the rules of the single
scan are halved until the failing one is alone.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import any_of
from ..functions.text import JSON_OPTIONS
from ..functions.time import window_bounds, window_filter
from ..operators import control as C
from ..operators import findings as FN
from ..operators.catalog import Rule, catalog, resumed_start
from .single_scan import single_scan

RUNNER_VERSION = "auditlens-0.1"


@dataclass
class RunResult:
    run_id: str
    counts: dict = field(default_factory=dict)        # rule_id -> findings in window
    inserted_unified: int = 0
    failures: dict = field(default_factory=dict)      # rule_id -> error text


def select_rules(group: str | None = None, pattern: str | None = None,
                 rule_ids: list[str] | None = None, enabled: set[str] | None = None) -> list[Rule]:
    rules = list(catalog().values())
    if rule_ids is not None:
        rules = [r for r in rules if r.rule_id in rule_ids or r.name in rule_ids]
    if group is not None:
        rules = [r for r in rules if r.group == group]
    if pattern is not None:
        rx = re.compile(pattern)
        rules = [r for r in rules if rx.search(r.name) or rx.search(r.rule_id)]
    if enabled is not None:
        rules = [r for r in rules if r.rule_id in enabled]
    return rules


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _instant(micros: int) -> datetime:
    """An instant, not a wall-clock time: the driver's own time zone plays no part."""
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def _resolve_bounds(spark, earliest, latest, rules: list[Rule]) -> dict:
    """Literal (lo, hi) per rule, "now" fixed once for the run (one tiny query)."""
    exprs = []
    for i, r in enumerate(rules):
        if r.lookback is None and earliest is None:
            continue
        lo, hi = window_bounds(earliest, latest, r.lookback)
        exprs += [F.unix_micros(lo.cast("timestamp")).alias(f"lo{i}"),
                  F.unix_micros(hi.cast("timestamp")).alias(f"hi{i}")]
    if not exprs:
        return {}
    row = {k: _instant(v) for k, v in spark.range(1).select(*exprs).first().asDict().items() if v is not None}
    return {r.rule_id: (row[f"lo{i}"], row[f"hi{i}"]) for i, r in enumerate(rules)
            if f"lo{i}" in row and f"hi{i}" in row}


@dataclass(frozen=True)
class Span:
    """What one rule reads, and after which instant its findings are new (None: all are)."""
    lo: datetime
    hi: datetime
    since: datetime | None = None

    @property
    def window(self) -> tuple[datetime, datetime]:
        """The window the run answers for."""
        return (self.since or self.lo), self.hi


def _resumed(spark, checkpoints: str, rules: list[Rule], bounds: dict, explicit: bool, params: dict) -> dict:
    """rule_id -> :class:`Span` of a run that continues what successful runs have covered.

    With an explicit start a rule continues at the end of the covered span that
    holds the start: what no run has covered is never jumped over. Without one
    it continues at the latest covered end, however long ago that is.
    """
    covered: dict[str, list] = {}
    for r in C.covered_spans(spark, checkpoints).select(
            "rule_id", F.unix_micros("span_start").alias("a"), F.unix_micros("span_end").alias("b")).collect():
        covered.setdefault(r.rule_id, []).append((_instant(r.a), _instant(r.b)))
    out = {}
    for rule in rules:
        if rule.rule_id not in bounds:
            continue
        lo, hi = bounds[rule.rule_id]
        ends = [b for a, b in covered.get(rule.rule_id, []) if not explicit or a <= lo <= b]
        if not ends:
            out[rule.rule_id] = Span(lo, hi)
            continue
        since = min(max(ends), hi)
        start = resumed_start(rule, since, lo, explicit, hi, params.get(rule.rule_id))
        out[rule.rule_id] = Span(start, hi, since)
    return out


@dataclass
class Part:
    """Some rules and how to plan them together into unified rows."""
    rules: list[Rule]
    plan: Callable[[list[Rule]], DataFrame]


def _choose_rules(spark, root: str, run_id: str, group, pattern, rule_ids, registry_path) -> list[Rule]:
    """The rules to run. An absent registry, and a rule asked for that is unknown or not
    enabled, is logged as FAILED and raised."""
    error, enabled = None, None
    if registry_path:
        if C.registry_exists(spark, registry_path):
            enabled = {r["rule_id"] for r in
                       C.enabled_rules(C.read_registry(spark, registry_path)).select("rule_id").collect()}
        else:
            error = f"no rule registry at {registry_path}"
    rules = select_rules(group, pattern, rule_ids, enabled)
    names = {x for r in rules for x in (r.rule_id, r.name)}
    missing = [r for r in rule_ids or [] if r not in names]
    if error is None and missing:
        error = f"unknown or not enabled: {', '.join(missing)}"
    if error is not None:
        failed = missing or rule_ids or [r.rule_id for r in rules]
        C.append_run_log(C.run_log_rows(spark, [
            _log(run_id, r, (None, None), _now(), "FAILED", None, 0, error) for r in failed]), f"{root}/run_log")
        raise ValueError(error)
    return rules


def run_rules(tables, root: str, earliest=None, latest=None, *, group: str | None = None,
              pattern: str | None = None, rule_ids: list[str] | None = None,
              registry_path: str | None = None, use_single_scan: bool = True,
              params: dict | None = None, run_id: str | None = None,
              write_rule_tables: bool = False, resume: bool = False) -> RunResult:
    """``write_rule_tables``: also write the per-rule tables (rule columns +
    metadata), from the rows that were evaluated once; every rule's columns are
    always in the unified payload (see :func:`rule_findings_from_unified`).

    ``resume``: a rule reports only findings that end after what successful
    runs have covered (see :func:`_resumed`). A stateless rule reads from there
    (inclusive: rows on the boundary are seen twice and de-duplicated by the
    merge); a rule that looks back reads as far before as its findings depend
    on, so a burst that a window cuts is still found.

    An absent registry raises, and so does a rule asked for by id or name that
    is unknown or not enabled, and a failure of the sinks; each is logged as
    FAILED first."""
    spark = tables.audit.sparkSession
    root = root.rstrip("/")
    params = params or {}
    run_id = run_id or uuid.uuid4().hex
    rules = _choose_rules(spark, root, run_id, group, pattern, rule_ids, registry_path)
    res = RunResult(run_id)
    bounds = _resolve_bounds(spark, earliest, latest, rules)
    spans = (_resumed(spark, f"{root}/checkpoints", rules, bounds, earliest is not None, params) if resume
             else {r: Span(*b) for r, b in bounds.items()})
    started = _now()
    t0 = time.time()

    # 1. Plan every rule into the unified shape (planning errors stay per rule).
    scan_rules = [r for r in rules if use_single_scan and r.stateless is not None and r.source == "audit"]
    others = [r for r in rules if r not in scan_rules]
    shared = [r for r in others if r.source == "audit" and r.prefilter is not None and r.rule_id in spans]
    rule_tables, subset = tables, None
    if len(shared) > 1:
        # The rows any of the stateful audit rules can use, scanned once and persisted.
        subset = (window_filter(tables.audit, "event_time", F.lit(min(spans[r.rule_id].lo for r in shared)),
                                F.lit(max(spans[r.rule_id].hi for r in shared)))
                  .filter(any_of([r.prefilter() for r in shared])).persist(StorageLevel.MEMORY_AND_DISK))
        rule_tables = replace(tables, audit=subset)

    def plan_scan(some: list[Rule]) -> DataFrame:
        return _scan_rows(tables, some, {r.rule_id: spans[r.rule_id].window for r in some}, params, run_id)

    def plan_rule(one: list[Rule]) -> DataFrame:
        return _rule_rows(rule_tables if one[0] in shared else tables, one[0], spans.get(one[0].rule_id),
                          params.get(one[0].rule_id, {}), run_id)

    parts = ([Part(scan_rules, plan_scan)] if scan_rules else []) + [Part([r], plan_rule) for r in others]

    # 2. One job evaluates all rules (persisted once). 3. Sinks: unified merge, per-rule tables.
    sink_error: Exception | None = None
    unified = None
    try:
        unified = _evaluate_parts(parts, res)
        dur = int((time.time() - t0) * 1000)
        if unified is not None:
            res.inserted_unified = FN.merge_unified(unified, root)
            if write_rule_tables:
                for r in rules:
                    if res.counts.get(r.rule_id):
                        _write_rule_table(unified, r, root, tables, params.get(r.rule_id, {}))
    except Exception as e:  # noqa: BLE001 - logged for every rule, then raised again
        sink_error = e
        dur = int((time.time() - t0) * 1000)
        for r in rules:
            res.failures.setdefault(r.rule_id, str(e))
    finally:
        for kept in (unified, subset):
            if kept is not None:
                kept.unpersist()

    log_rows = []
    for r in rules:
        window = spans[r.rule_id].window if r.rule_id in spans else (None, None)
        failure = res.failures.get(r.rule_id)
        log_rows.append(_log(run_id, r.rule_id, window, started, "SUCCESS" if failure is None else "FAILED",
                             int(res.counts.get(r.rule_id, 0)) if failure is None else None, dur, failure))
    if log_rows:
        log = C.run_log_rows(spark, log_rows)
        C.append_run_log(log, f"{root}/run_log")
        C.update_checkpoints(log, f"{root}/checkpoints")
    if sink_error is not None:
        raise sink_error
    return res


def _scan_rows(tables, rules: list[Rule], windows: dict, params: dict, run_id: str) -> DataFrame:
    """Unified rows of stateless rules from one scan."""
    found = single_scan(tables, rule_ids=[r.rule_id for r in rules],
                        windows={k: (F.lit(v[0]), F.lit(v[1])) for k, v in windows.items()}, params=params)
    ends = [F.create_map(*[x for k, v in windows.items() for x in (F.lit(k), F.lit(v[i]))])[F.col("rule_id")]
            for i in (0, 1)]
    return found.select(
        "event_ts", "event_date", "rule_id", F.lit(run_id).alias("run_id"), ends[0].alias("window_start_ts"),
        ends[1].alias("window_end_ts"), "severity", F.current_timestamp().alias("observed_at"), "payload_json",
        "dedupe_key")


def _rule_rows(tables, rule: Rule, span: Span | None, params: dict, run_id: str) -> DataFrame:
    """Unified rows of one rule by itself."""
    if span is None:
        raise ValueError(f"{rule.rule_id} needs an explicit earliest bound")
    rows = rule.run(tables, F.lit(span.lo), F.lit(span.hi), sort=False, output="rows",
                    since=None if span.since is None else F.lit(span.since), **params)
    lo, hi = span.window
    return FN.to_unified(FN.standardize(rows, rule.rule_id, run_id, F.lit(lo), F.lit(hi), rule.severity),
                         rule.time_col)


def _halves(part: Part) -> list[Part]:
    middle = len(part.rules) // 2
    return [Part(part.rules[:middle], part.plan), Part(part.rules[middle:], part.plan)]


def _planned(part: Part, res: RunResult) -> list[tuple[Part, DataFrame]]:
    """The part's frame; if planning fails, those of its halves down to the failing rule."""
    try:
        return [(part, part.plan(part.rules))]
    except Exception as e:  # noqa: BLE001
        if len(part.rules) == 1:
            res.failures[part.rules[0].rule_id] = str(e)
            return []
        return [x for half in _halves(part) for x in _planned(half, res)]


def _counted(part: Part, df: DataFrame, res: RunResult) -> list[DataFrame]:
    """Count a part by itself; if that fails, its halves down to the failing rule. Returns
    the frames that could be evaluated."""
    try:
        got = {r["rule_id"]: r["count"] for r in df.groupBy("rule_id").count().collect()}
    except Exception as e:  # noqa: BLE001
        if len(part.rules) == 1:
            res.failures[part.rules[0].rule_id] = str(e)
            return []
        return [ok for half in _halves(part) for p, d in _planned(half, res) for ok in _counted(p, d, res)]
    res.counts.update({r.rule_id: int(got.get(r.rule_id, 0)) for r in part.rules})
    return [df]


def _evaluate_parts(parts: list[Part], res: RunResult) -> DataFrame | None:
    """Persist the union of all parts and count findings per rule in one job. If it fails,
    parts are evaluated by themselves and halved, so only failing rules are marked FAILED
    (one more scan per halving, about 2 log2 of the rules for one bad rule)."""
    frames = [x for part in parts for x in _planned(part, res)]
    if not frames:
        return None
    unified = reduce(DataFrame.unionByName, [df for _, df in frames]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        got = {r["rule_id"]: r["count"] for r in unified.groupBy("rule_id").count().collect()}
        res.counts.update({r.rule_id: int(got.get(r.rule_id, 0)) for part, _ in frames for r in part.rules})
        return unified
    except Exception:  # noqa: BLE001 - find the failing rules
        unified.unpersist()
    good = [ok for part, df in frames for ok in _counted(part, df, res)]
    return reduce(DataFrame.unionByName, good).persist(StorageLevel.MEMORY_AND_DISK) if good else None


def run_rule(tables, root: str, rule_id: str, earliest=None, latest=None, **kw) -> RunResult:
    """one rule through the same pipeline, with its per-rule table."""
    kw.setdefault("write_rule_tables", True)
    return run_rules(tables, root, earliest, latest, rule_ids=[rule_id],
                     use_single_scan=False, **kw)


def _log(run_id, rule_id, bounds, started, status, rows, duration_ms, error) -> dict:
    now = _now()
    return {"run_id": run_id, "rule_id": rule_id, "window_start_ts": bounds[0],
            "window_end_ts": bounds[1], "started_at": started, "finished_at": now,
            "status": status, "row_count": rows, "duration_ms": duration_ms,
            "runner_version": RUNNER_VERSION, "error_message": error, "created_at": now}


def rule_output_schema(tables, rule: Rule, params: dict | None = None):
    """The rule's output schema, resolved on empty tables of the same
    schemas (analysis only, no job)."""
    spark = tables.audit.sparkSession

    def empty(df):
        return None if df is None else spark.createDataFrame([], df.schema)

    et = replace(tables, audit=empty(tables.audit), history=empty(tables.history), billing=empty(tables.billing),
                 ip_geo=empty(tables.ip_geo), ip_asn=empty(tables.ip_asn), keep=lambda df, _: df)
    ts = F.lit("2000-01-01").cast("timestamp")
    return rule.run(et, ts, ts, sort=False, output="rows", **(params or {})).schema


_META = ["rule_id", "run_id", "window_start_ts", "window_end_ts", "severity", "observed_at", "dedupe_key"]


def _from_payload(unified: DataFrame, tables, rule: Rule, params: dict | None, *extra: str) -> DataFrame:
    """Rule columns + metadata of a rule's unified rows, parsed from the payload. A rule
    column named like a metadata column (case-blind) is kept as ``payload_<name>``."""
    rows_schema = rule_output_schema(tables, rule, params)
    taken = {m.lower() for m in _META}
    cols = [F.col(f"_p.`{f.name}`").alias(f"payload_{f.name}" if f.name.lower() in taken else f.name)
            for f in rows_schema.fields]
    return (unified.filter(F.col("rule_id") == rule.rule_id)
            .select(F.from_json("payload_json", rows_schema, JSON_OPTIONS).alias("_p"), *_META, *extra)
            .select(*cols, *_META, *extra))


def rule_findings_from_unified(tables, root: str, rule: Rule,
                               params: dict | None = None) -> DataFrame:
    """The per-rule view when no per-rule table was written."""
    return _from_payload(FN.read_unified(tables.audit.sparkSession, root), tables, rule, params)


def _write_rule_table(unified: DataFrame, rule: Rule, root: str, tables, params: dict) -> None:
    """F03 from the evaluated rows; only this rule's findings are touched."""
    # event_ts by a name that no rule uses: EVENT_TS would clash case-blind.
    rows = _from_payload(unified.withColumn("_finding_ts", F.col("event_ts")), tables, rule, params, "_finding_ts")
    FN.merge_rule_findings(rows.withColumn(FN.FINDING_DATE, F.to_date("_finding_ts")).drop("_finding_ts"),
                           root, rule.rule_id)
