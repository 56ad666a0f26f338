"""Source tables.

Rules never hard-code a catalog name: they receive a :class:`Tables` bundle.
Production code builds it from catalog tables or parquet paths; the test
tables are turned into the same shapes by :mod:`auditlens.sources.projection`.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_utc, written
from . import projection

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


@dataclass(frozen=True)
class Tables:
    audit: DataFrame
    history: DataFrame | None = None
    billing: DataFrame | None = None
    ip_geo: DataFrame | None = None
    ip_asn: DataFrame | None = None
    #: What a rule does with a reduced frame that it uses more than once (name given).
    keep: Callable[[DataFrame, str], DataFrame] = written

    def scoped_to_users(self, users: DataFrame) -> "Tables":
        """Every source reduced to the users listed in ``users`` (column email): a
        semi-join, so a short list is broadcast and filters the scans at run time, and
        a long one is shuffled."""
        from pyspark.sql import functions as F
        listed = users.select(F.col("email").alias("_listed")).distinct()

        def only(df: DataFrame | None, who: str) -> DataFrame | None:
            return df if df is None else df.join(listed, F.col(who) == F.col("_listed"), "left_semi")

        return replace(self, audit=only(self.audit, "user_identity.email"), history=only(self.history, "executed_as"),
                       billing=only(self.billing, "identity_metadata.created_by"))

    def scoped_to_user(self, email: str) -> "Tables":
        """Row filter on every source before the rules run (user report)."""
        from pyspark.sql import functions as F
        return replace(
            self,
            audit=self.audit.filter(F.col("user_identity.email") == email),
            history=None if self.history is None else
            self.history.filter(F.col("executed_as") == email),
            billing=None if self.billing is None else
            self.billing.filter(F.col("identity_metadata.created_by") == email),
        )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_DERIVED: dict[tuple, Tables] = {}


#: Source events a task derives from, so that neither its rows nor the number of tasks hang on how
#: the files are cut.
TASK_EVENTS = 200_000


def in_time_order(events: DataFrame) -> DataFrame:
    """The events' columns that are derived from, dealt by time in even parts and sorted while still
    narrow: what is derived comes out nearly in time order, and no task holds or sorts wide rows."""
    parts = math.ceil(events.count() / TASK_EVENTS)  # from the files' footers
    narrow = events.select("event_id", "ts", "user_id")
    if parts > 1:
        narrow = narrow.repartitionByRange(parts, "ts", "event_id", "user_id")
    return narrow.sortWithinPartitions("ts")


def derive_test_tables(spark: SparkSession, sf_dir: str, arranged: Callable[[DataFrame], DataFrame] | None = None
                       ) -> Tables:
    """The derived tables as lazy DataFrames over the test-data files (events ``arranged`` first)."""
    ensure_utc(spark)
    events = read_table(spark, sf_dir, "events")
    if arranged is not None:
        events = arranged(events)
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return Tables(
        audit=projection.audit_from_events(events),
        history=projection.history_from_events(events),
        billing=projection.billing_from_lineitem(read_table(spark, sf_dir, "lineitem")),
        ip_geo=projection.ip_geo_from_nations(nation, region),
        ip_asn=projection.ip_asn_from_nations(nation, region),
    )


def load_test_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Tables:
    """Derive the audit/history/billing/IP-range tables from a test-data folder.

    With ``materialize`` (default) they are written once per session as
    parquet into the shared checkpoint folder and read back, so rules run
    on stored tables as in production (a stored ``request_params`` column,
    filters pushed to the scan) instead of re-deriving every row per query.
    """
    import uuid

    from ..session import checkpoint_dir
    if not materialize:
        return derive_test_tables(spark, sf_dir)
    ensure_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    cached = _DERIVED.get(key)
    if cached is not None:
        return cached
    derived = derive_test_tables(spark, sf_dir, in_time_order)
    base = f"{checkpoint_dir(spark).rstrip('/')}/auditlens-derived-{uuid.uuid4().hex}"
    derived.audit.write.parquet(f"{base}/audit")
    derived.history.write.parquet(f"{base}/history")
    derived.billing.write.parquet(f"{base}/billing")
    derived.ip_geo.write.parquet(f"{base}/ip_geo")
    derived.ip_asn.write.parquet(f"{base}/ip_asn")
    rd = spark.read.parquet
    tables = Tables(audit=rd(f"{base}/audit"), history=rd(f"{base}/history"),
                    billing=rd(f"{base}/billing"), ip_geo=rd(f"{base}/ip_geo"),
                    ip_asn=rd(f"{base}/ip_asn"))
    _DERIVED[key] = tables   # the files are written once and never change
    return tables


def load_catalog_tables(spark: SparkSession, audit: str, history: str | None = None,
                        billing: str | None = None, ip_geo: str | None = None,
                        ip_asn: str | None = None) -> Tables:
    """Production entry: catalog tables by name (``spark.table``)."""
    ensure_utc(spark)
    tb = spark.table
    return Tables(audit=tb(audit),
                  history=tb(history) if history else None,
                  billing=tb(billing) if billing else None,
                  ip_geo=tb(ip_geo) if ip_geo else None,
                  ip_asn=tb(ip_asn) if ip_asn else None)


def load_parquet_tables(spark: SparkSession, audit: str, history: str | None = None,
                        billing: str | None = None, ip_geo: str | None = None,
                        ip_asn: str | None = None) -> Tables:
    """Production entry: parquet (or any format Spark reads) at the given paths."""
    ensure_utc(spark)
    rd = spark.read.parquet
    return Tables(audit=rd(audit),
                  history=rd(history) if history else None,
                  billing=rd(billing) if billing else None,
                  ip_geo=rd(ip_geo) if ip_geo else None,
                  ip_asn=rd(ip_asn) if ip_asn else None)
