"""Benchmark: headline queries on one warm local session.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query is executed completely (``noop`` sink, no collection to the
driver). ``value`` is the summed wall time of the timed queries. Besides the
per-query times it reports the comparison the baseline asks for: the 25
stateless rules run one by one versus the single-scan operator, both producing
findings with payload and de-duplication key (median of 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def _sf_of(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def many_networks(spark):
    """About 100,000 nested networks of both families, from the orders table."""
    key = spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr("o_orderkey % 65536 AS a", "o_custkey % 256 AS b")
    return key.selectExpr(
        "explode(array(concat('203.', a % 256, '.', b, '.0/24'), concat('203.', a % 256, '.0.0/16'),"
        " concat('2600:', hex(a), ':', hex(b), '::/48'))) AS network", "'c' AS city", "'c' AS country",
        "'c' AS country_code", "0D AS latitude", "0D AS longitude", "1 AS accuracy_radius").distinct().limit(100_000)


def main() -> None:
    from auditlens.session import build_session
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(CPUS, 8),
                          extra={"spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024)})
    import importlib
    entry = importlib.import_module("__spark_entry__")
    from auditlens import oracle as O
    from auditlens.operators.catalog import get_rule
    from auditlens.operators.enrich import geo_enrich
    from auditlens.operators.rules_stateless import STATELESS_AUDIT_IDS
    from auditlens.plans.evaluate import rule_findings
    from auditlens.plans.single_scan import single_scan
    from auditlens.sources import load_test_tables

    qs = entry.queries()
    # Derived audit/history/billing/IP tables are written once per session
    # (data preparation, reported separately).
    derive = timed(lambda: load_test_tables(spark, SF_DIR))
    # Warm-up (JVM, class loading, codegen caches): one rule and the single scan.
    run_noop(qs["d04_mfa_key_added"](spark, SF_DIR))
    run_noop(single_scan(load_test_tables(spark, SF_DIR), *O.WINDOW_ALL))

    times: dict[str, float] = {}
    for name, fn in qs.items():
        times[name] = round(timed(lambda: run_noop(fn(spark, SF_DIR))), 3)

    tables = load_test_tables(spark, SF_DIR)

    def one_by_one():
        # Same output as the single scan: findings with payload and key, per rule.
        for rid in STATELESS_AUDIT_IDS:
            run_noop(rule_findings(tables, get_rule(rid), *O.WINDOW_ALL))

    def scan():
        run_noop(single_scan(tables, *O.WINDOW_ALL))

    obo = statistics.median(timed(one_by_one) for _ in range(3))
    ss = statistics.median(timed(scan) for _ in range(3))
    lookup = timed(lambda: run_noop(geo_enrich(tables.audit.select("event_id", "source_ip_address"),
                                               "source_ip_address", many_networks(spark))))
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total_sec", "value": total, "unit": "sec",
        "queries": times, "sf": _sf_of(SF_DIR), "cpus": CPUS,
        "stateless_25_rules_one_by_one_sec": round(obo, 3),
        "stateless_25_rules_single_scan_sec": round(ss, 3),
        "geo_lookup_100k_networks_sec": round(lookup, 3),
        "derive_test_tables_once_sec": round(derive, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
