"""Rule catalog.

A rule is a record: id, group, severity, default lookback and a ``build``
function ``(tables, earliest, latest, **params) -> DataFrame``. Stateless
audit rules are declared as a row predicate plus an aliased projection
(:class:`StatelessSpec`) so they can run alone or all together in one scan
(:mod:`auditlens.plans.single_scan`).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import bound, window_bounds, window_filter


@dataclass(frozen=True)
class StatelessSpec:
    predicate: Callable[..., Column]          # (**params) -> row predicate, window excluded
    columns: Callable[..., list[Column]]      # (**params) -> aliased output columns
    sort_col: str | None = None               # presented newest first
    # What a scan of many rules can push down: every action the predicate can match, or
    # another superset of it in plain column tests.
    actions: tuple[str, ...] = ()
    touches: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    group: str                 # binary | behavioral | custom | documented
    severity: str              # catalog default; a run may override
    description: str
    lookback: str | None       # default window; None = earliest is required
    time_col: str              # output column that carries the event time
    source: str = "audit"      # audit | history
    build: Callable[..., DataFrame] | None = None
    stateless: StatelessSpec | None = None
    defaults: dict = field(default_factory=dict)
    output: str = "rows"       # rows | alerts
    user_col: str | None = None  # output column with the acting user (reports)
    prefilter: Callable[[], Column] | None = None  # cheap superset of the rows a
    #                                                stateful rule reads (shared scan)
    reach: Callable[[dict], int] | None = None   # seconds before its end that a finding of a
    #                                              stateful rule depends on; None: the whole window

    def run(self, tables, earliest=None, latest=None, sort: bool = True,
            output: str | None = None, since=None, **params) -> DataFrame:
        """Findings of this rule in [earliest, latest]; ``output='rows'``
        skips the alert wrapping of alert-type rules.

        ``since`` (resumed runs): only findings that end after it. The rows up
        to ``since`` are context; see :func:`resumed_start` for how far back
        they are needed."""
        p = {**self.defaults, **params}
        if self.stateless is not None:
            df = self._run_stateless(tables, earliest if since is None else since, latest, **p)
            if sort and self.stateless.sort_col:
                df = df.orderBy(F.col(self.stateless.sort_col).desc())
        else:
            df = self.build(tables, earliest, latest, **p, **({} if since is None else {"since": bound(since)}))
        if (output or self.output) == "alerts":
            from .alerts import to_alerts
            df = to_alerts(df)
        return df

    def _run_stateless(self, tables, earliest, latest, **p) -> DataFrame:
        src = tables.audit if self.source == "audit" else tables.history
        lo, hi = window_bounds(earliest, latest, self.lookback)
        time_col = "event_time" if self.source == "audit" else "start_time"
        return (window_filter(src, time_col, lo, hi)
                .filter(self.stateless.predicate(**p))
                .select(*self.stateless.columns(**p)))


def resumed_start(rule: Rule, since: datetime, start: datetime, explicit: bool, end: datetime,
                  params: dict | None = None) -> datetime:
    """Where a run that reports what ends after ``since`` must start to read.

    A stateless rule needs no context, a rule with a ``reach`` that many
    seconds, any other its whole window: from the caller's start, or as long as
    its default window before ``since`` when the caller gave none. An explicit
    start is never passed: rows before it aren't part of the window.
    """
    if rule.stateless is not None:
        return since
    if rule.reach is not None:
        first = since - timedelta(seconds=rule.reach({**rule.defaults, **(params or {})}))
    else:
        first = start if explicit else since - (end - start)
    return max(first, start) if explicit else first


_CATALOG: dict[str, Rule] = {}


def register(rule: Rule) -> Rule:
    _CATALOG[rule.rule_id] = rule
    return rule


def catalog() -> dict[str, Rule]:
    """All rules by id (D01...), loading the rule modules on first use."""
    from . import rules_stateful, rules_stateless  # noqa: F401  (registration)
    return dict(sorted(_CATALOG.items()))


def get_rule(rule_id_or_name: str) -> Rule:
    cat = catalog()
    if rule_id_or_name in cat:
        return cat[rule_id_or_name]
    for r in cat.values():
        if r.name == rule_id_or_name:
            return r
    raise KeyError(rule_id_or_name)


def rules_in_group(group: str) -> list[Rule]:
    return [r for r in catalog().values() if r.group == group]
