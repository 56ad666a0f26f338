"""Audit, query-history, billing and IP-range tables derived from the test tables.

The driver's tables hold no audit log, so one is derived from ``events`` by
integer arithmetic (and ``history``/``billing``/IP ranges likewise). The
column rules are written once, as SQL expressions that Spark SQL and DuckDB
evaluate identically; only the fan-out, integer division and timestamp
arithmetic differ per engine. Spark applies them with ``selectExpr`` so the
whole projection is one codegen'd stage (scan -> generate -> project).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the projection (value lists picked by a modulus).
# ---------------------------------------------------------------------------
ENDPOINTS_GROUP = ["permissionAssignment", "roleAssignment", "adminConsole"]
ENDPOINTS_USER = ["adminConsole", "scim"]
GROUP_NAMES = ["workspace-admins", "analysts"]
ADMIN_ACTIONS = ["setAccountAdmin", "changeAccountOwner", "setAdmin", "removeAdmin"]
ROLE_ACTIONS = ["addUserToAdminGroup", "modifyUserRole"]
SSO_ACTIONS = ["create", "update", "delete"]
IP_LIST_ACTIONS = ["createIpAccessList", "deleteIpAccessList", "updateIpAccessList"]
CRED_ACTIONS = ["mount", "createStorageCredential", "updateStorageCredential",
                "createConnection", "updateConnection"]
DOWNLOAD_ACTIONS = ["downloadPreviewResults", "downloadLargeResults", "filesGet",
                    "getModelVersionDownloadUri", "getModelVersionSignedDownloadUri"]
LOGIN_ACTIONS = ["login", "tokenLogin", "samlLogin", "jwtLogin"]
AUTH_METHODS = [None, "BROWSER_BYO_IDP_SAML", "GENIE_AUTH", "PASSWORD"]
DENIED_PATHS = [None, "/api/2.0/jobs", "/telemetry", "/api/health"]
CONF_KEYS = ["enableVerboseAuditLogs", "enableVerboseAuditLogs",
             "customerApprovedWSLoginExpirationTime", "enableExport"]
CONF_VALUES = ["false", "true", None, "true"]
EXPORT_FORMATS = ["SOURCE", "DBC", None]
FILE_TYPES = ["arrows", "csv", None]
STATEMENTS = [
    "COPY INTO t FROM 's3://b' WITH (CREDENTIALS (k=1))",
    "copy into t from 's3://b' with (credentials (k=1))",
    "COPY INTO t FROM x",
    "COPY INTO\\%CREDENTIALS% probe",
    None,  # GRANT statement, built from the id below
    "SELECT 1",
]
FAN_OFFSETS_S = [0, 45, 400]
# Addresses as SQL expressions: IPv6 in all its spellings, reserved and mapped
# ones, and texts that are no address.
ODD_ADDRESSES = [
    "'2600:' || CAST(user_id % 7 AS STRING) || ':' || CAST(user_id % 25 AS STRING) || '::' || CAST(src_id % 250 AS STRING)",
    "'2600:' || CAST(user_id % 5 AS STRING) || ':' || CAST(user_id % 25 AS STRING) || ':0:7::' || CAST(src_id % 250 AS STRING)",
    "'2600:0001:0006:0000:0000:0000:0000:00AB'", "'2001:db8::1'", "'::1'", "'fe80::1'", "'fd00::5'",
    "'::ffff:8.8.8.8'", "'2001:4860:4860::8888'", "'2002:c000:204::1'", "'64:ff9b::1.2.3.4'", "'2001:20::1'",
    "'203.0.3.7:443'", "'2600::1::2'", "'2600:1:2:3:4:5:6:7:8'", "'2600:1:1::256.1.1.1'",
]


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _pick(expr: str, values: list) -> str:
    """``values[expr]`` as a portable CASE."""
    arms = " ".join(f"WHEN {k} THEN {_lit(v)}" for k, v in enumerate(values))
    return f"(CASE {expr} {arms} END)"


def _choose(expr: str, exprs: list[str]) -> str:
    """The ``expr``-th of some SQL expressions."""
    return f"(CASE {expr} " + " ".join(f"WHEN {k} THEN {e}" for k, e in enumerate(exprs)) + " END)"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _keyed(key: str, mod: int) -> str:
    return f"'{key}_' || {_s('r % ' + str(mod))}"


# Columns available to every rule below: src_id (events.event_id), user_id,
# s = src_id % 32, r = src_id div 32, r4 = r div 4, i (fan-out index),
# epoch_s (floor epoch seconds of event_time).
AUDIT_COLUMNS: dict[str, str] = {
    "service_name": "(CASE WHEN s = 16 THEN 'ssoConfigBackend' "
                    "WHEN s IN (18, 19, 20, 22) THEN 'workspace' "
                    "WHEN s IN (21, 23) THEN 'notebook' "
                    "WHEN s = 26 THEN 'secrets' ELSE 'accounts' END)",
    "action_name": "(CASE s WHEN 0 THEN 'generateDbToken' WHEN 1 THEN 'revokeDbToken' "
                   "WHEN 2 THEN 'createGroup' WHEN 3 THEN 'removeGroup' WHEN 4 THEN 'mfaAddKey' "
                   "WHEN 5 THEN 'mfaDeleteKey' WHEN 6 THEN 'login' WHEN 7 THEN 'changePassword' "
                   "WHEN 8 THEN 'add' WHEN 9 THEN 'delete' WHEN 10 THEN 'addPrincipalToGroup' "
                   "WHEN 11 THEN 'removePrincipalFromGroup' "
                   f"WHEN 12 THEN {_pick('r % 4', ADMIN_ACTIONS)} "
                   f"WHEN 13 THEN {_pick('r % 2', ROLE_ACTIONS)} "
                   "WHEN 14 THEN 'updateUser' WHEN 15 THEN 'IpAccessDenied' "
                   f"WHEN 16 THEN {_pick('r % 3', SSO_ACTIONS)} "
                   "WHEN 17 THEN 'setSetting' WHEN 18 THEN 'workspaceConfEdit' "
                   f"WHEN 19 THEN {_pick('r % 3', IP_LIST_ACTIONS)} "
                   f"WHEN 20 THEN {_pick('r % 5', CRED_ACTIONS)} "
                   f"WHEN 21 THEN {_pick('r % 5', DOWNLOAD_ACTIONS)} "
                   "WHEN 22 THEN 'workspaceExport' WHEN 23 THEN 'downloadQueryResult' "
                   "WHEN 24 THEN 'tokenLogin' WHEN 25 THEN 'tokenLogin' WHEN 26 THEN 'getSecret' "
                   f"ELSE {_pick('r % 4', LOGIN_ACTIONS)} END)",
    "audit_level": "(CASE WHEN r4 % 2 = 0 THEN 'ACCOUNT_LEVEL' ELSE 'WORKSPACE_LEVEL' END)",
    "status_code": "(CASE WHEN r % 5 = 4 THEN 403 ELSE 200 END)",
    "session_id": f"(CASE WHEN s >= 27 THEN 'sess' || {_s('user_id')} END)",
    "user_agent": "(CASE WHEN s = 26 THEN 'TruffleHog/3' "
                  "WHEN r % 7 = 6 THEN 'Databricks-Runtime/15' "
                  f"WHEN s >= 27 THEN 'Mozilla/' || {_s('(r + i) % 3')} "
                  "ELSE 'Mozilla/5.0' END)",
    "source_ip_address": "(CASE WHEN s IN (24, 25) THEN '198.51.100.' || "
                         "(CASE WHEN r % 6 < 5 THEN '1' ELSE '2' END) "
                         f"WHEN s < 24 AND r % 9 = 7 THEN {_choose('r4 % 16', ODD_ADDRESSES)} "
                         f"WHEN r % 9 = 8 THEN '10.0.0.' || {_s('src_id % 250')} "
                         f"ELSE '203.0.' || {_s('user_id % 25')} || '.' || "
                         f"{_s('(src_id + (CASE WHEN s >= 27 THEN i ELSE 0 END)) % 250')} END)",
    "account_id": "'acct0'",
    "workspace_id": f"'ws' || {_s('user_id % 5')}",
    "email": f"'user' || {_s('user_id')} || '@example.com'",
}

# request_params: key -> value (NULL means the key is absent from the map).
PARAM_COLUMNS: dict[str, str] = {
    "userId": f"(CASE WHEN s = 0 THEN 'u' || {_s('user_id')} END)",
    "tokenExpirationTime": f"(CASE WHEN s = 0 THEN {_s('(epoch_s + (r % 4) * 86400) * 1000')} END)",
    "tokenHash": f"(CASE WHEN s = 1 THEN 'h' || {_s('src_id')} END)",
    "endpoint": f"(CASE WHEN s IN (2, 3) THEN {_pick('r % 3', ENDPOINTS_GROUP)} "
                f"WHEN s IN (8, 9) THEN {_pick('r % 2', ENDPOINTS_USER)} "
                "WHEN s = 14 AND r % 4 = 2 THEN 'scim' END)",
    "targetGroupName": f"(CASE WHEN s = 2 THEN 'g' || {_s('r % 10')} "
                       f"WHEN s IN (10, 11) THEN {_pick('r % 2', GROUP_NAMES)} END)",
    "targetUserName": f"(CASE WHEN s IN (2, 3) THEN 't' || {_s('r % 10')} "
                      f"WHEN s IN (8, 9, 11) THEN {_keyed('targetUserName', 10)} END)",
    "targetGroupId": f"(CASE WHEN s = 3 THEN 'g' || {_s('r % 10')} END)",
    "id": f"(CASE WHEN s = 5 THEN 'k' || {_s('src_id')} END)",
    "authentication_method": f"(CASE WHEN s = 6 THEN {_pick('r % 4', AUTH_METHODS)} END)",
    "targetUserId": f"(CASE WHEN s = 7 THEN {_keyed('targetUserId', 10)} END)",
    "newPasswordSource": f"(CASE WHEN s = 7 THEN {_keyed('newPasswordSource', 10)} END)",
    "target_group_name": f"(CASE WHEN s = 10 THEN {_keyed('target_group_name', 10)} END)",
    "target_user_name": f"(CASE WHEN s = 10 THEN {_keyed('target_user_name', 10)} END)",
    "email": "(CASE WHEN s = 14 AND r % 4 = 0 THEN 'n@x.org' END)",
    "newUserName": "(CASE WHEN s = 14 AND r % 4 = 1 THEN 'n' END)",
    "note": "(CASE WHEN s = 14 AND r % 4 = 3 THEN 'a@b' END)",
    "path": f"(CASE WHEN s = 15 THEN {_pick('r % 4', DENIED_PATHS)} END)",
    "status": f"(CASE WHEN s = 16 THEN {_keyed('status', 10)} END)",
    "config": f"(CASE WHEN s = 16 THEN {_keyed('config', 10)} END)",
    "workspaceConfKeys": f"(CASE WHEN s = 18 THEN {_pick('r % 4', CONF_KEYS)} END)",
    "workspaceConfValues": f"(CASE WHEN s = 18 THEN {_pick('r % 4', CONF_VALUES)} END)",
    "workspaceExportFormat": f"(CASE WHEN s = 22 THEN {_pick('r % 3', EXPORT_FORMATS)} END)",
    "fileType": f"(CASE WHEN s = 23 THEN {_pick('r % 3', FILE_TYPES)} END)",
    "tokenId": f"(CASE WHEN s IN (24, 25, 26) THEN 'tok' || {_s('user_id')} END)",
    "authenticationMethod": "(CASE WHEN s = 25 AND r % 4 = 3 THEN 'API_INT_PAT_TOKEN' "
                            "WHEN s IN (24, 25) THEN 'API_EXT_PAT_TOKEN' END)",
}
PARAM_KEYS_SORTED = sorted(PARAM_COLUMNS)

FANOUT_PRED = "(s >= 27 OR (s = 26 AND r % 4 = 1) OR (s IN (24, 25) AND r % 6 < 5))"

HISTORY_COLUMNS: dict[str, str] = {
    "executed_as": f"'user' || {_s('user_id')} || '@example.com'",
    "statement_text": f"(CASE src_id % 6 WHEN 4 THEN 'GRANT SELECT ON t TO u' || {_s('src_id')} "
                      + " ".join(f"WHEN {k} THEN {_lit(v)}" for k, v in enumerate(STATEMENTS)
                                 if v is not None) + " END)",
    "statement_id": f"'st' || {_s('src_id')}",
    "warehouse_id": f"'wh' || {_s('user_id % 3')}",
    "total_duration_ms": "src_id % 5000",
    "produced_rows": "src_id % 1000",
}

BILLING_COLUMNS: dict[str, str] = {
    "sku_name": "'SKU_' || l_returnflag",
    "usage_unit": "(CASE WHEN l_linestatus = 'O' THEN 'DBU' ELSE 'GB' END)",
    "usage_quantity": "l_quantity",
    "created_by": f"'user' || {_s('l_suppkey')} || '@example.com'",
}

# IP ranges: one /24 per nation (203.0.<n>.0/24) nested in one /16 per region
# (203.<r>.0.0/16), and in IPv6 a /80 nested in a /48 per nation and a /32 per
# region, so longest-prefix matching is exercised in both families.
NATION_NETWORKS = [f"'203.0.' || {_s('n_nationkey')} || '.0/24'",
                   f"'2600:' || {_s('n_nationkey % 5')} || ':' || {_s('n_nationkey')} || '::/48'",
                   f"'2600:' || {_s('n_nationkey % 5')} || ':' || {_s('n_nationkey')} || ':0:7::/80'"]
REGION_NETWORKS = [f"'203.' || {_s('r_regionkey')} || '.0.0/16'", f"'2600:' || {_s('r_regionkey')} || '::/32'"]
NATION_GEO: dict[str, str] = {
    "city": f"'CITY_' || {_s('n_nationkey')}",
    "country": "n_name",
    "country_code": f"'N' || {_s('n_nationkey')}",
    "latitude": "CAST(n_nationkey AS DOUBLE) + 0.5",
    "longitude": "0.25 - CAST(n_nationkey AS DOUBLE)",
    "accuracy_radius": "50 + n_nationkey",
    "as_number": "64500 + n_nationkey",
    "as_org": "'ORG_' || n_name",
    "as_network": "network",
}
REGION_GEO: dict[str, str] = {
    "city": "CAST(NULL AS STRING)",
    "country": "r_name",
    "country_code": f"'R' || {_s('r_regionkey')}",
    "latitude": "CAST(r_regionkey AS DOUBLE) * 10.0",
    "longitude": "CAST(r_regionkey AS DOUBLE) * 10.0",
    "accuracy_radius": "1000 + r_regionkey",
    "as_number": "64400 + r_regionkey",
    "as_org": "'ORG_' || r_name",
    "as_network": "network",
}
GEO_FIELDS = ["city", "country", "country_code", "latitude", "longitude", "accuracy_radius"]
ASN_FIELDS = ["as_number", "as_org", "as_network"]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _params_map() -> Column:
    entries = ", ".join(
        f"named_struct('key', '{k}', 'value', {PARAM_COLUMNS[k]})" for k in PARAM_KEYS_SORTED)
    return F.expr(f"map_from_entries(filter(array({entries}), e -> e.value IS NOT NULL))")


def audit_from_events(events: DataFrame) -> DataFrame:
    """Audit log (``system.access.audit`` shape) derived from ``events``."""
    base = (events.select(F.col("event_id").alias("src_id"), "ts", "user_id")
            .withColumn("s", F.expr("pmod(src_id, 32)"))
            .withColumn("r", F.expr("src_id div 32"))
            .withColumn("r4", F.expr("(src_id div 32) div 4"))
            .withColumn("i", F.explode(F.expr(
                f"CASE WHEN {FANOUT_PRED} THEN array(0, 1, 2) ELSE array(0) END")))
            .withColumn("event_time", F.expr(
                f"CAST(timestampadd(SECOND, {_pick('i', FAN_OFFSETS_S)}, ts) AS TIMESTAMP)"))
            .withColumn("epoch_s", F.expr("unix_seconds(event_time)")))
    cols = {k: F.expr(v) for k, v in AUDIT_COLUMNS.items()}
    return base.select(
        (F.col("src_id") * 3 + F.col("i")).alias("event_id"),
        "event_time",
        cols["service_name"].alias("service_name"),
        cols["action_name"].alias("action_name"),
        cols["audit_level"].alias("audit_level"),
        cols["source_ip_address"].alias("source_ip_address"),
        cols["user_agent"].alias("user_agent"),
        cols["session_id"].alias("session_id"),
        cols["account_id"].alias("account_id"),
        cols["workspace_id"].alias("workspace_id"),
        F.struct(cols["email"].alias("email")).alias("user_identity"),
        F.struct(cols["status_code"].cast("int").alias("status_code")).alias("response"),
        _params_map().alias("request_params"),
    )


def history_from_events(events: DataFrame) -> DataFrame:
    """Query history (``system.query.history`` shape) derived from ``events``."""
    base = events.select(F.col("event_id").alias("src_id"), "ts", "user_id")
    h = {k: F.expr(v) for k, v in HISTORY_COLUMNS.items()}
    return base.select(
        F.col("ts").cast("timestamp").alias("start_time"),
        h["executed_as"].alias("executed_as"),
        h["statement_text"].alias("statement_text"),
        h["statement_id"].alias("statement_id"),
        F.struct(h["warehouse_id"].alias("warehouse_id")).alias("compute"),
        h["total_duration_ms"].cast("bigint").alias("total_duration_ms"),
        h["produced_rows"].cast("bigint").alias("produced_rows"),
    )


def billing_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Billable usage (``system.billing.usage`` shape) derived from ``lineitem``."""
    b = {k: F.expr(v) for k, v in BILLING_COLUMNS.items()}
    return lineitem.select(
        F.col("l_shipdate").cast("date").alias("usage_date"),
        F.col("l_shipdate").cast("timestamp").alias("usage_start_time"),
        b["sku_name"].alias("sku_name"),
        b["usage_unit"].alias("usage_unit"),
        b["usage_quantity"].cast("double").alias("usage_quantity"),
        F.struct(b["created_by"].alias("created_by")).alias("identity_metadata"),
    )


def _ranges(nation: DataFrame, region: DataFrame, fields: list[str]) -> DataFrame:
    n = nation.withColumn("network", F.explode(F.array(*map(F.expr, NATION_NETWORKS))))
    r = region.withColumn("network", F.explode(F.array(*map(F.expr, REGION_NETWORKS))))
    return n.selectExpr("network", *[f"{NATION_GEO[k]} AS {k}" for k in fields]).unionByName(
        r.selectExpr("network", *[f"{REGION_GEO[k]} AS {k}" for k in fields]))


def ip_geo_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    return _ranges(nation, region, GEO_FIELDS).withColumn(
        "accuracy_radius", F.col("accuracy_radius").cast("int"))


def ip_asn_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    return _ranges(nation, region, ASN_FIELDS).withColumn("as_number", F.col("as_number").cast("int"))


# ---------------------------------------------------------------------------
# DuckDB side (oracle prefix): flat columns, request_params as p_<key> columns
# plus their canonical text ``request_params_text`` ('k=v;k=v', keys sorted).
# ---------------------------------------------------------------------------

def duckdb_audit_cte() -> str:
    params = ",\n    ".join(f"{v} AS p_{k}" for k, v in PARAM_COLUMNS.items())
    cols = ",\n    ".join(f"{v} AS {k}" for k, v in AUDIT_COLUMNS.items())
    text = "concat_ws(';', " + ", ".join(f"'{k}=' || p_{k}" for k in PARAM_KEYS_SORTED) + ")"
    return f"""audit_src0 AS (
  SELECT event_id AS src_id, ts, user_id, event_id % 32 AS s, event_id // 32 AS r,
         (event_id // 32) // 4 AS r4
  FROM events
), audit_src AS (
  SELECT *, unnest(CASE WHEN {FANOUT_PRED} THEN [0, 1, 2] ELSE [0] END) AS i
  FROM audit_src0
), audit_t AS (
  SELECT *, ts + to_seconds({_pick('i', FAN_OFFSETS_S)}) AS event_time
  FROM audit_src
), audit_e AS (
  SELECT *, CAST(floor(epoch(event_time)) AS BIGINT) AS epoch_s FROM audit_t
), audit_p AS (
  SELECT src_id * 3 + i AS event_id, event_time,
    {cols},
    {params}
  FROM audit_e
), audit AS (
  SELECT *, {text} AS request_params_text FROM audit_p
)"""


def duckdb_history_cte() -> str:
    cols = ",\n    ".join(f"{v} AS {k}" for k, v in HISTORY_COLUMNS.items())
    return f"""history AS (
  SELECT ts AS start_time,
    {cols}
  FROM (SELECT event_id AS src_id, ts, user_id FROM events)
)"""


def duckdb_billing_cte() -> str:
    cols = ",\n    ".join(f"{v} AS {k}" for k, v in BILLING_COLUMNS.items())
    return f"""billing AS (
  SELECT CAST(l_shipdate AS DATE) AS usage_date, l_shipdate AS usage_start_time,
    {cols}
  FROM lineitem
)"""


def duckdb_ip_ranges_cte(name: str, fields: list[str]) -> str:
    n = ", ".join(f"{NATION_GEO[k]} AS {k}" for k in fields)
    r = ", ".join(f"{REGION_GEO[k]} AS {k}" for k in fields)
    return f"""{name} AS (
  SELECT network, {n} FROM (SELECT *, unnest([{", ".join(NATION_NETWORKS)}]) AS network FROM nation)
  UNION ALL
  SELECT network, {r} FROM (SELECT *, unnest([{", ".join(REGION_NETWORKS)}]) AS network FROM region)
)"""
