"""Threat models (T01-T03) and the user behaviour report.

A threat model is a named list of rules. ``run_threat_model`` evaluates its
rules (binary rules over the last ``hours``, the others over the last
``days``, both ending at ``now``) into one findings frame plus a per-rule
summary; nothing is rendered as notebook text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import catalog
from ..operators import reports as R
from .evaluate import evaluate, run_summary

# ---------------------------------------------------------------------------
# Rule membership of each threat model (rules without source in
# the mirrored rule set are D31 and D32; here they have our semantics).
# ---------------------------------------------------------------------------
THREAT_MODELS: dict[str, list[str]] = {
    "account_takeover": ["D06", "D17", "D24", "D01", "D02", "D05", "D04", "D16", "D12", "D11",
                         "D13", "D27", "D28", "D10", "D15"],
    "data_exfiltration": ["D07", "D08", "D09", "D01", "D32", "D25", "D14", "D31"],
    "insider_threat": ["D07", "D08", "D09", "D27", "D19", "D18", "D20", "D29", "D26", "D22",
                       "D23", "D31", "D32", "D01"],
    "supply_chain": ["D25", "D14", "D32"],
    "vendor_compromise": ["D21", "D18", "D24", "D27"],
    "ransomware": ["D19", "D18", "D20", "D26", "D22", "D23", "D28", "D31", "D29"],
    "resource_abuse": ["D31", "D15", "D01"],
}
THREAT_RISKS: dict[str, str] = {
    "account_takeover": "Credentials or sessions of a user are used by someone else.",
    "data_exfiltration": "Data leaves the platform through downloads, copies or credentials.",
    "insider_threat": "A trusted user abuses access or weakens controls.",
    "supply_chain": "Third-party tools or tokens are used against the platform.",
    "vendor_compromise": "Vendor access paths are used or changed.",
    "ransomware": "Controls are disabled and access removed ahead of destruction.",
    "resource_abuse": "Compute and tokens are used for unapproved work.",
}


def threat_model_dimension(spark: SparkSession) -> DataFrame:
    """(threat_model, rule_id, risk)."""
    rows = [(m, rid, THREAT_RISKS[m]) for m, ids in THREAT_MODELS.items() for rid in ids]
    return spark.createDataFrame(rows, "threat_model string, rule_id string, risk string")


def coverage(spark: SparkSession) -> DataFrame:
    """Rules per model with the binary/behavioral split."""
    cat = catalog()
    groups = spark.createDataFrame([(r.rule_id, r.group) for r in cat.values()],
                                   "rule_id string, rule_group string")
    dim = threat_model_dimension(spark)
    return (dim.join(F.broadcast(groups), "rule_id", "left")
            .groupBy("threat_model")
            .agg(F.count(F.lit(1)).alias("rules"),
                 F.sum((F.col("rule_group") == "binary").cast("int")).alias("binary"),
                 F.sum((F.col("rule_group") == "behavioral").cast("int")).alias("behavioral"),
                 F.sum((F.col("rule_group") == "documented").cast("int")).alias("documented")))


def _window(rule, now, days, hours):
    span = _dt.timedelta(hours=hours) if rule.group == "binary" else _dt.timedelta(days=days)
    return (now - span, now)


def run_threat_model(tables, name: str, days: int = 30, hours: int = 24,
                     now: _dt.datetime | None = None, user: str | None = None):
    """(findings, summary) for one threat model."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    cat = catalog()
    rules = [cat[i] for i in THREAT_MODELS[name] if i in cat]
    if user is not None:
        tables = tables.scoped_to_user(user)
    windows = {r.rule_id: _window(r, now, days, hours) for r in rules}
    found = evaluate(tables, rules, windows)
    summary = run_summary(found, rules).withColumn("threat_model", F.lit(name))
    return found.withColumn("threat_model", F.lit(name)), summary


def user_report(tables, user: str, earliest, latest) -> dict[str, DataFrame]:
    """Activity reports and all binary and behavioral rules for one user
    (sources scoped to the user before the rules run) plus a summary (R06)."""
    scoped = tables.scoped_to_user(user)
    rules = [r for r in catalog().values() if r.group in ("binary", "behavioral")
             and not (r.lookback is None and earliest is None)]
    found = evaluate(scoped, rules, {r.rule_id: (earliest, latest) for r in rules})
    return {
        "ip_usage": R.ip_usage(scoped, earliest, latest),
        "token_usage": R.token_usage(scoped, earliest, latest),
        "api_actions": R.api_actions(scoped, earliest, latest),
        "billing_usage": R.billing_usage(scoped, earliest, latest) if scoped.billing is not None else None,
        "findings": found,
        "summary": run_summary(found, rules),
    }


def finding_user(rules) -> Column:
    """The acting user of a finding, from its payload."""
    user = None
    for r in rules:
        path = f"$.{r.user_col or 'user_identity.email'}"
        value = F.get_json_object("payload_json", path)
        user = F.when(F.col("rule_id") == r.rule_id, value) if user is None else user.when(
            F.col("rule_id") == r.rule_id, value)
    return user


def user_reports(tables, users: DataFrame, earliest, latest) -> dict[str, DataFrame]:
    """R05 for many users at once (``users``: column email): the same reports with the
    user as a key. Sources are reduced to the listed users first; each rule is evaluated
    once for all of them. ``summary``: findings per user and rule."""
    scoped = tables.scoped_to_users(users)
    rules = [r for r in catalog().values() if r.group in ("binary", "behavioral")
             and not (r.lookback is None and earliest is None)]
    found = evaluate(scoped, rules, {r.rule_id: (earliest, latest) for r in rules}).withColumn(
        "email", finding_user(rules))
    return {
        "ip_usage": R.ip_usage(scoped, earliest, latest),
        "token_usage": R.token_usage(scoped, earliest, latest),
        "api_actions": R.api_actions(scoped, earliest, latest),
        "billing_usage": R.billing_usage(scoped, earliest, latest) if scoped.billing is not None else None,
        "findings": found,
        "summary": found.groupBy("email", "rule_id").agg(F.count(F.lit(1)).alias("findings")),
    }


def run_threat_models(tables, names: list[str] | None = None, days: int = 30, hours: int = 24,
                      now: _dt.datetime | None = None, user: str | None = None):
    """T02 for several models at once: each rule is evaluated once (its
    window depends only on its group), then attached to every model that
    lists it through the bounded model dimension (broadcast)."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    cat = catalog()
    names = names or list(THREAT_MODELS)
    if user is not None:
        tables = tables.scoped_to_user(user)
    ids = sorted({i for m in names for i in THREAT_MODELS[m] if i in cat})
    rules = [cat[i] for i in ids]
    found = evaluate(tables, rules, {r.rule_id: _window(r, now, days, hours) for r in rules})
    spark = found.sparkSession
    dim = spark.createDataFrame(
        [(m, i, cat[i].name, cat[i].group) for m in names for i in THREAT_MODELS[m] if i in cat],
        "threat_model string, rule_id string, name string, rule_group string")
    per_model = found.join(F.broadcast(dim.select("threat_model", "rule_id")), "rule_id")
    counts = per_model.groupBy("threat_model", "rule_id").agg(F.count(F.lit(1)).alias("n"))
    summary = (F.broadcast(dim).join(counts, ["threat_model", "rule_id"], "left")
               .select("rule_id", "name", "rule_group",
                       F.coalesce("n", F.lit(0)).cast("bigint").alias("findings"),
                       (F.coalesce("n", F.lit(0)) > 0).alias("triggered"), "threat_model"))
    return per_model, summary
