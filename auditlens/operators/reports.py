"""Activity reports.

The reference builds them for one user; here ``user=None`` reports every
user at once (email is a group key), and ``user='a@b'`` scopes the sources
first, so a single user's report is the same query with a pushed-down filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import email, param
from ..functions.time import DAY, window_bounds, window_filter


def _audit(tables, user, earliest, latest, lookback=DAY) -> DataFrame:
    lo, hi = window_bounds(earliest, latest, lookback)
    a = window_filter(tables.audit, "event_time", lo, hi)
    return a if user is None else a.filter(email() == user)


def _distinct(c, approx: bool):
    """Exact distinct count (as the reports specify) or a HyperLogLog++
    estimate: one pass with a fixed-size sketch per group, no distinct
    expansion (for very large groups)."""
    return F.approx_count_distinct(c) if approx else F.countDistinct(c)


def _times():
    return [F.min("event_time").alias("earliest"), F.max("event_time").alias("latest"),
            F.count(F.lit(1)).alias("total_events")]


def _by_use(a: DataFrame, keys: dict, approx: bool) -> DataFrame:
    """Per key: time span, events, distinct addresses and agents.

    Exact counts of two columns at once would copy every event per column. So
    the events are first reduced to one row per (key, address, agent), with
    map-side combine; each address and each agent of a key is then counted where
    it comes first. No group's values are gathered.
    """
    named = a.select(*[c.alias(k) for k, c in keys.items()], "event_time", "source_ip_address", "user_agent")
    if approx:
        return (named.groupBy(*keys).agg(*_times(), _distinct("source_ip_address", True).alias("num_source_ips"),
                                         _distinct("user_agent", True).alias("num_useragents")))
    uses = named.groupBy(*keys, "source_ip_address", "user_agent").agg(*_times())

    def first_of(value: str, other: str):
        w = Window.partitionBy(*keys, value).orderBy(other)
        return (F.col(value).isNotNull() & (F.row_number().over(w) == 1)).cast("bigint")

    return (uses.withColumn("_ip", first_of("source_ip_address", "user_agent"))
            .withColumn("_agent", first_of("user_agent", "source_ip_address"))
            .groupBy(*keys).agg(F.min("earliest").alias("earliest"), F.max("latest").alias("latest"),
                                F.sum("total_events").alias("total_events"), F.sum("_ip").alias("num_source_ips"),
                                F.sum("_agent").alias("num_useragents")))


def ip_usage(tables, earliest=None, latest=None, user: str | None = None,
             approx: bool = False) -> DataFrame:
    """Per (user, source IP): time span, events, distinct service||action."""
    a = _audit(tables, user, earliest, latest)
    return (a.groupBy(email().alias("email"), "source_ip_address")
            .agg(*_times(), _distinct(F.concat("service_name", "action_name"), approx)
                 .alias("num_unique_actions")))


def token_usage(tables, earliest=None, latest=None, user: str | None = None,
                approx: bool = False) -> DataFrame:
    """Token logins other than internal tokens, per (user, tokenId)."""
    a = (_audit(tables, user, earliest, latest)
         .filter((F.col("action_name") == "tokenLogin")
                 & (param("authenticationMethod") != "API_INT_PAT_TOKEN")))
    return _by_use(a, {"email": email(), "tokenId": param("tokenId")}, approx)


def api_actions(tables, earliest=None, latest=None, user: str | None = None,
                approx: bool = False) -> DataFrame:
    """Per (user, service, action)."""
    a = _audit(tables, user, earliest, latest)
    return _by_use(a, {"email": email(), "service_name": F.col("service_name"),
                       "action_name": F.col("action_name")}, approx)


def billing_usage(tables, earliest=None, latest=None, user: str | None = None) -> DataFrame:
    """DBU used per (user, day, SKU)."""
    lo, hi = window_bounds(earliest, latest, DAY)
    b = window_filter(tables.billing, "usage_start_time", lo, hi, date_partition="usage_date")
    b = b.filter(F.col("usage_unit") == "DBU")
    who = F.col("identity_metadata.created_by")
    if user is not None:
        b = b.filter(who == user)
    return (b.groupBy(who.alias("created_by"), "usage_date", "sku_name")
            .agg(F.sum("usage_quantity").alias("DBU_used")))


def detection_listing(spark) -> DataFrame:
    """Rule name, description cut to 100 characters, module; ordered."""
    from .catalog import catalog
    rows = [(r.rule_id, r.name, r.group, r.description, f"auditlens.operators.{r.name}")
            for r in catalog().values()]
    df = spark.createDataFrame(rows, "rule_id string, name string, rule_group string,"
                                     " description string, module string")
    desc = F.when(F.length("description") > 100,
                  F.concat(F.substring("description", 1, 100), F.lit("..."))
                  ).otherwise(F.col("description"))
    return df.select("rule_id", "name", "rule_group", desc.alias("description"),
                     "module").orderBy("rule_group", "name")
