import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from auditlens.session import build_session
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="auditlens-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_tables(spark):
    from auditlens.sources import load_test_tables
    return load_test_tables(spark, SF_SMALL)


AUDIT_DDL = ("event_id bigint, event_time timestamp, service_name string, action_name string,"
             " audit_level string, source_ip_address string, user_agent string, session_id string,"
             " account_id string, workspace_id string, user_identity struct<email:string>,"
             " response struct<status_code:int>, request_params map<string,string>")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def audit_rows(spark, rows: list[dict]):
    """Hand-made audit rows; unspecified fields take harmless defaults."""
    out = []
    for i, r in enumerate(rows):
        out.append((
            r.get("event_id", i), ts(r.get("t", "2025-01-10 12:00:00")),
            r.get("service", "accounts"), r.get("action", "login"),
            r.get("level", "ACCOUNT_LEVEL"), r.get("ip", "203.0.113.9"),
            r.get("ua", "Mozilla/5.0"), r.get("session"), r.get("account", "acct"),
            r.get("workspace", "ws1"),
            {"email": r.get("email", "a@example.com")} if "email" not in r or r["email"] is not None
            else {"email": None},
            {"status_code": r.get("status", 200)}, r.get("params", {})))
    return spark.createDataFrame(out, AUDIT_DDL)


def tables_of(spark, rows, **kw):
    from auditlens.sources import Tables
    return Tables(audit=audit_rows(spark, rows), **kw)
