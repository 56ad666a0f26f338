"""Independent DuckDB SQL for every checked query.

Each string runs on the driver's registered views (events, lineitem, nation,
region, ...). A shared prefix derives the audit/history/billing/IP-range
tables (see :mod:`auditlens.sources.projection`); the rule logic itself is
written here again in plain SQL, separately from the DataFrame code.
Map values appear as sorted ``k=v;k=v`` text, arrays as sorted ``a,b``,
structs as ``<col>_<field>`` columns, timestamps as naive UTC.
"""

from __future__ import annotations

from .functions import predicates as P
from .functions.ip import (GLOBAL_EXCEPTIONS_V4, GLOBAL_EXCEPTIONS_V6, NOT_GLOBAL_V4, NOT_GLOBAL_V6,
                           _block)
from .sources import projection as PR

WINDOW_ALL = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
WINDOW_CUT = ("2024-01-05 00:00:00", "2024-01-25 00:00:00")
WINDOW_DAY = ("2024-01-10 00:00:00", "2024-01-11 00:00:00")

OK = "CASE WHEN status_code = 200 THEN 'Success' ELSE 'Failure' END"
EPOCH = "CAST(floor(epoch(event_time)) AS BIGINT)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _nrx(col: str, pattern: str) -> str:
    return f"NOT regexp_matches({col}, {_q(pattern)})"


def _instant(x: str) -> str:
    """A timestamp literal; text in parentheses is an expression already."""
    return x if x.startswith("(") else f"TIMESTAMP '{x}'"


def win(lo: str, hi: str, col: str = "event_time") -> str:
    return f"{col} BETWEEN {_instant(lo)} AND {_instant(hi)}"


def _param(key: str) -> str:
    return f"p_{key}" if key in PR.PARAM_COLUMNS else "CAST(NULL AS VARCHAR)"


PARAMS_JSON = ("'{' || concat_ws(',', " + ", ".join(
    f"'\"{k}\":\"' || p_{k} || '\"'" for k in PR.PARAM_KEYS_SORTED) + ") || '}'")


def prefix(*extra: str) -> str:
    parts = [PR.duckdb_audit_cte(), PR.duckdb_history_cte(), PR.duckdb_billing_cte(),
             PR.duckdb_ip_ranges_cte("ip_geo", PR.GEO_FIELDS),
             PR.duckdb_ip_ranges_cte("ip_asn", PR.ASN_FIELDS)]
    return "WITH " + ",\n".join(parts + list(extra)) + "\n"


# ---------------------------------------------------------------------------
# Stateless rules: (columns, predicate, sort column, source)
# ---------------------------------------------------------------------------
ACC = "service_name = 'accounts'"
TAIL = [("audit_level", "AUDIT_LEVEL"), ("source_ip_address", "SRC_IP"),
        ("user_agent", "USER_AGENT")]
LIFETIME = (f"round((CAST(trunc(TRY_CAST(p_tokenExpirationTime AS DOUBLE) / 1000) AS BIGINT)"
            f" - {EPOCH}) / 86400.0, 0)")


def _movement(desc=None):
    cols = [("event_time", "EVENT_TIME"), ("service_name", "SERVICE_NAME"),
            ("action_name", "ACTION_NAME")]
    if desc:
        cols.append(desc)
    return cols + [("email", "USER_EMAIL"), ("user_agent", "USER_AGENT"),
                   ("source_ip_address", "SOURCE_IP_ADDRESS"),
                   ("request_params_text", "REQUEST_PARAMS")]


def _group_cols(else_key):
    return [("event_time", "EVENT_DATE"), ("action_name", "ACTION"),
            (f"CASE WHEN p_endpoint IN ('permissionAssignment', 'roleAssignment') "
             f"THEN p_targetUserName ELSE p_{else_key} END", "GROUP"),
            ("email", "SRC_USER"), ("audit_level", "AUDIT_LEVEL"), (OK, "STATUS"),
            ("source_ip_address", "SRC_IP"), ("user_agent", "USER_AGENT")]


LOGIN_COLS = [("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
              ("email", "SRC_USER"), ("p_authentication_method", "AUTH_METHOD"),
              ("workspace_id", "WORKSPACE_ID")] + TAIL
CONF_EDIT = "action_name = 'workspaceConfEdit'"

STATELESS: dict[str, tuple[list, str]] = {
    "D01": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             (LIFETIME, "TOKEN_LIFETIME_DAYS"), ("audit_level", "AUDIT_LEVEL"),
             ("source_ip_address", "SRC_IP"), ("email", "SRC_USER"), ("p_userId", "USER"),
             ("user_agent", "USER_AGENT")],
            f"{ACC} AND action_name = 'generateDbToken' AND {_nrx('user_agent', P.TOKEN_AGENT_REGEX)}"
            f" AND {_nrx('source_ip_address', P.TOKEN_KNOWN_IP_REGEX)} AND {LIFETIME} > 0"),
    "D02": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), ("source_ip_address", "SRC_IP"),
             ("email", "SRC_USER"), ("p_tokenHash", "TOKEN_HASH"), ("user_agent", "USER_AGENT"),
             ("status_code", "STATUS"), ("audit_level", "AUDIT_LEVEL")],
            f"{ACC} AND action_name = 'revokeDbToken'"),
    "D03": (_group_cols("targetGroupName"), f"{ACC} AND action_name = 'createGroup'"),
    "D04": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("email", "SRC_USER")] + TAIL, f"{ACC} AND action_name = 'mfaAddKey'"),
    "D05": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("p_id", "KeyId"), ("email", "SRC_USER")] + TAIL,
            f"{ACC} AND action_name = 'mfaDeleteKey'"),
    "D06": (LOGIN_COLS, f"{ACC} AND action_name IN {_in(P.NON_SSO_ACTIONS)}"
                        " AND NOT (p_authentication_method IN ('BROWSER_BYO_IDP_SAML'))"
                        " AND status_code = 200"),
    "D07": (_movement(), f"action_name IN {_in(P.CREDENTIAL_ACTIONS)}"),
    "D09": (_movement(), f"(action_name IN {_in(P.DOWNLOAD_ACTIONS)}"
                         " OR (action_name = 'workspaceExport' AND coalesce(p_workspaceExportFormat, '') <> 'SOURCE')"
                         " OR (action_name = 'downloadQueryResult' AND coalesce(p_fileType, '') <> 'arrows'))"),
    "D10": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("p_target_user_name", "TARGET_USER"),
             ("p_target_group_name", "USER_GROUP"),
             ("email", "SRC_USER")] + TAIL, f"{ACC} AND action_name = 'addPrincipalToGroup'"),
    "D15": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("email", "SRC_USER"), ("p_targetUserName", "TARGET_USER"), ("p_endpoint", "ENDPOINT"),
             ("source_ip_address", "SRC_IP"), ("user_agent", "USER_AGENT"),
             ("audit_level", "AUDIT_LEVEL")],
            f"{ACC} AND action_name = 'add' AND CAST(status_code AS INTEGER) = 200"
            " AND p_endpoint = 'adminConsole'"),
    "D16": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("email", "SRC_USER"), ("p_targetUserId", "TARGET_USER"),
             ("p_newPasswordSource", "PASSWORD_SOURCE")] + TAIL,
            f"{ACC} AND action_name = 'changePassword'"),
    "D17": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("email", "SRC_USER"), ("p_path", "PATH"), ("workspace_id", "WORKSPACE_ID"),
             ("source_ip_address", "SRC_IP"), ("status_code", "RESPONSE_CODE"),
             ("user_agent", "USER_AGENT"), ("audit_level", "AUDIT_LEVEL")],
            f"{_nrx('email', P.UUID_REGEX)} AND {ACC} AND action_name = 'IpAccessDenied'"
            f" AND {_nrx('user_agent', '|'.join(P.DENIED_IP_AGENTS))}"
            f" AND {_nrx('p_path', '|'.join(P.DENIED_IP_EXCLUDED_PATHS))}"),
    "D18": (_movement(("action_name || ' for ' || audit_level", "ACTION_DESCRIPTION")),
            "audit_level = 'ACCOUNT_LEVEL' AND action_name = 'setSetting'"),
    "D19": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("email", "SRC_USER"),
             (f"CASE WHEN {CONF_EDIT} THEN p_workspaceConfKeys || ': ' || coalesce(p_workspaceConfValues, 'N/A')"
              f" WHEN action_name IN {_in(P.IP_ACCESS_LIST_ACTIONS)} THEN 'IP Access List - ' || action_name"
              " ELSE 'Unknown Configuration' END", "CONFIG_CHANGE"),
             (f"CASE WHEN {CONF_EDIT} AND p_workspaceConfKeys = 'enableVerboseAuditLogs'"
              " AND p_workspaceConfValues = 'false' THEN 'CRITICAL - Audit Logging Disabled'"
              " WHEN action_name = 'deleteIpAccessList' THEN 'HIGH - IP Access List Deleted'"
              " WHEN action_name IN ('createIpAccessList', 'updateIpAccessList') THEN 'MEDIUM - IP Access List Modified'"
              f" WHEN {CONF_EDIT} AND p_workspaceConfKeys = 'customerApprovedWSLoginExpirationTime'"
              " THEN 'MEDIUM - Change to Databricks Employee Access Config'"
              " ELSE 'MEDIUM - Configuration Change' END", "SEVERITY"),
             ("audit_level", "AUDIT_LEVEL"), ("source_ip_address", "SRC_IP"),
             ("user_agent", "USER_AGENT"), ("request_params_text", "REQUEST_PARAMS")],
            f"((service_name = 'workspace' AND {CONF_EDIT} AND p_workspaceConfKeys = 'enableVerboseAuditLogs')"
            f" OR action_name IN {_in(P.IP_ACCESS_LIST_ACTIONS)}"
            f" OR ({CONF_EDIT} AND p_workspaceConfKeys = 'customerApprovedWSLoginExpirationTime'))"),
    "D20": (_movement(("action_name || ' for ' || coalesce(p_workspaceConfKeys, 'unknown_key') || ': '"
                       " || coalesce(p_workspaceConfValues, 'unknown_value')", "CONFIG_CHANGE_DESCRIPTION")),
            CONF_EDIT),
    "D21": (LOGIN_COLS, f"{ACC} AND action_name IN {_in(P.NON_SSO_ACTIONS)}"
                        " AND p_authentication_method = 'GENIE_AUTH' AND status_code = 200"
                        " AND audit_level = 'WORKSPACE_LEVEL'"),
    "D22": (_group_cols("targetGroupId"), f"{ACC} AND action_name = 'removeGroup'"),
    "D23": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), ("source_ip_address", "SRC_IP"),
             ("email", "SRC_USER"), ("p_targetUserName", "TARGET_USER"),
             ("p_targetGroupName", "USER_GROUP"), ("user_agent", "USER_AGENT"), (OK, "STATUS"),
             ("audit_level", "AUDIT_LEVEL")], f"{ACC} AND action_name = 'removePrincipalFromGroup'"),
    "D24": ([("event_time", "EVENT_DATE"), ("service_name", "SERVICE"), ("action_name", "ACTION"),
             (OK, "STATUS"), ("email", "SRC_USER"), ("p_status", "SSO_STATUS"),
             ("p_config", "SSO_CONFIG"), ("source_ip_address", "SRC_IP"),
             ("status_code", "RESPONSE_CODE"), ("user_agent", "USER_AGENT"),
             ("audit_level", "AUDIT_LEVEL")],
            "service_name = 'ssoConfigBackend' AND action_name IN ('create', 'update')"),
    "D25": ([("event_time", "EVENT_TIME"), ("source_ip_address", "SOURCE_IP_ADDRESS"),
             ("user_agent", "USER_AGENT"), ("p_tokenId", "TOKEN_ID"), ("email", "SRC_USER")],
            "user_agent LIKE '%TruffleHog%'"),
    "D26": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("p_targetUserName", "TARGET_USER"), ("email", "SRC_USER"),
             ("audit_level", "AUDIT_LEVEL"), ("p_endpoint", "ENDPOINT"),
             ("source_ip_address", "SRC_IP"), ("user_agent", "USER_AGENT")],
            f"{ACC} AND action_name = 'delete'"),
    "D27": (_movement(("action_name || ': ' || coalesce(p_targetGroupName, 'direct configuration')",
                       "ACTION_DESCRIPTION")),
            f"(action_name IN {_in(P.ADMIN_CHANGE_ACTIONS)} OR (action_name IN "
            f"{_in(P.GROUP_MEMBER_ACTIONS)} AND contains(p_targetGroupName, 'admin')))"),
    "D28": ([("event_time", "event_time"), ("email", "user_identity_email"),
             ("request_params_text", "request_params"), ("action_name", "action_name")],
            f"{ACC} AND action_name IN {_in(P.ROLE_ACTIONS)}"),
    "D29": ([("event_time", "EVENT_DATE"), ("action_name", "ACTION"), (OK, "STATUS"),
             ("email", "SRC_USER"), ("p_workspaceConfKeys", "CONF_KEY"),
             ("'Disabled'", "CONF_VALUE")] + TAIL,
            f"service_name = 'workspace' AND {CONF_EDIT} AND p_workspaceConfKeys = 'enableVerboseAuditLogs'"
            " AND p_workspaceConfValues = 'false'"),
    "D30": ([("event_time", "EVENT_TIME"), ("action_name", "ACTION"),
             ("p_targetUserName", "TARGET_USER"), ("email", "ACTOR_USER"),
             ("source_ip_address", "SRC_IP"), ("user_agent", "USER_AGENT"),
             ("audit_level", "AUDIT_LEVEL"), ("p_endpoint", "ENDPOINT"),
             (_param("email"), "NEW_EMAIL_JSON"), (_param("newEmail"), "NEW_EMAIL_ALT_JSON"),
             (_param("userName"), "NEW_USERNAME_JSON"),
             (_param("newUserName"), "NEW_USERNAME_ALT_JSON"),
             (PARAMS_JSON, "REQUEST_PARAMS_JSON")],
            f"{ACC} AND action_name = 'updateUser' AND (lower(request_params_text) LIKE '%email%'"
            " OR lower(request_params_text) LIKE '%username%' OR request_params_text LIKE '%@%')"),
}

HISTORY_D08 = ([("start_time", "START_TIME"), ("executed_as", "EXECUTED_AS"),
                ("statement_text", "STATEMENT_TEXT"), ("statement_id", "STATEMENT_ID"),
                ("warehouse_id", "WAREHOUSE_ID"), ("total_duration_ms", "TOTAL_DURATION_MS"),
                ("produced_rows", "PRODUCED_ROWS")],
               "contains(upper(statement_text), 'COPY INTO') AND contains(upper(statement_text), 'CREDENTIALS')"
               " AND NOT contains(upper(statement_text), 'COPY INTO\\%CREDENTIALS%')")


def _select(cols) -> str:
    return ", ".join(f'{e} AS "{a}"' for e, a in cols)


def stateless_body(rid: str, lo: str, hi: str) -> str:
    """SELECT ... FROM audit|history WHERE window AND predicate (no WITH)."""
    if rid == "D08":
        cols, pred = HISTORY_D08
        return f"SELECT {_select(cols)} FROM history WHERE {win(lo, hi, 'start_time')} AND {pred}"
    cols, pred = STATELESS[rid]
    return f"SELECT {_select(cols)} FROM audit WHERE {win(lo, hi)} AND {pred}"


def stateless_sql(rid: str, lo: str, hi: str) -> str:
    return prefix() + stateless_body(rid, lo, hi)


def stateless_columns(rid: str) -> list[str]:
    cols = HISTORY_D08[0] if rid == "D08" else STATELESS[rid][0]
    return [a for _, a in cols]


# ---------------------------------------------------------------------------
# Stateful rules
# ---------------------------------------------------------------------------
def _Parts(*ctes: str) -> list[str]:
    return list(ctes)


def _with_parts(fn):
    """``fn`` returns (ctes, select). The wrapped function returns the full
    query; ``.body`` returns it without the shared prefix, for nesting as a
    subquery under one prefix."""
    def full(*a, **k):
        ctes, sel = fn(*a, **k)
        return prefix(*ctes) + sel

    def body(*a, **k):
        ctes, sel = fn(*a, **k)
        return "WITH " + ",\n".join(ctes) + "\n" + sel

    full.body = body
    return full


def _login_filter(agents: list[str]) -> str:
    return (f"{ACC} AND action_name IN {_in(P.LOGIN_ACTIONS)}"
            f" AND {_nrx('source_ip_address', P.PRIVATE_IP_REGEX)}"
            f" AND {_nrx('user_agent', '|'.join(agents))}")


@_with_parts
def d11_sql(lo, hi, threshold_seconds=600, threshold_value=2) -> str:
    return _Parts(
        f"logins AS (SELECT email, event_time, source_ip_address, {EPOCH} AS ts FROM audit"
        f" WHERE {win(lo, hi)} AND {_login_filter(P.LOGIN_BURST_AGENTS)} AND email IS NOT NULL)",
        "counted AS (SELECT *, count(*) OVER (PARTITION BY email ORDER BY ts RANGE BETWEEN "
        f"{threshold_seconds} PRECEDING AND CURRENT ROW) AS login_count FROM logins)"
    ), ("SELECT email, CAST(count(*) AS INTEGER) AS total_logins,"
         " count(DISTINCT source_ip_address) AS unique_ips, min(event_time) AS first_seen,"
         " max(event_time) AS last_seen, CAST(max(login_count) AS INTEGER) AS max_login_count"
         f" FROM counted GROUP BY email HAVING max(login_count) >= {threshold_value}")


@_with_parts
def d12_sql(lo, hi, threshold_secs=600) -> str:
    return _Parts(
        f"l AS (SELECT event_time, email, session_id, source_ip_address, user_agent, audit_level,"
        f" event_id, {EPOCH} AS ts FROM audit WHERE {win(lo, hi)}"
        f" AND {_login_filter(P.DEVICE_SWITCH_AGENTS)} AND session_id IS NOT NULL)",
        "g AS (SELECT *, lag(source_ip_address) OVER w AS previous_ip,"
        " lag(user_agent) OVER w AS previous_agent, lag(event_time) OVER w AS previous_time,"
        " lag(ts) OVER w AS prev_ts FROM l"
        " WINDOW w AS (PARTITION BY email ORDER BY event_time, event_id))",
        "r AS (SELECT *, ts - prev_ts AS time_diff_seconds,"
        " CASE WHEN previous_ip <> source_ip_address AND previous_agent <> user_agent"
        " THEN 'Different IP & User-Agent' WHEN previous_ip <> source_ip_address THEN 'Different IP'"
        " WHEN previous_agent <> user_agent THEN 'Different User-Agent' END AS trigger_reason FROM g)"
    ), ("SELECT event_time, email, session_id, source_ip_address, user_agent, audit_level,"
         " previous_ip, previous_agent, previous_time, time_diff_seconds, trigger_reason FROM r"
         " WHERE previous_ip IS NOT NULL AND trigger_reason IS NOT NULL"
         f" AND time_diff_seconds < {threshold_secs}")


def _sorted_set(col: str) -> str:
    return (f"array_to_string(list_sort(list(DISTINCT {col}) FILTER (WHERE {col} IS NOT NULL)), ',')")


@_with_parts
def d13_sql(lo, hi, corrected: bool = False) -> str:
    keys = "session_id, email" if corrected else "source_ip_address, email, audit_level"
    return _Parts(
        f"s AS (SELECT event_time, session_id, email, source_ip_address, user_agent, audit_level"
        f" FROM audit WHERE {win(lo, hi)} AND session_id IS NOT NULL"
        f" AND {_nrx('source_ip_address', P.PRIVATE_IP_REGEX)}"
        f" AND {_nrx('user_agent', '|'.join(P.SERVICE_AGENTS))})",
        f"g AS (SELECT {keys}, count(DISTINCT source_ip_address) AS ip_count,"
        " count(DISTINCT user_agent) AS agent_count,"
        f" {_sorted_set('source_ip_address')} AS source_ip_address_list,"
        f" {_sorted_set('user_agent')} AS user_agent_list,"
        " min(event_time) AS first_seen, max(event_time) AS last_seen,"
        " CAST((CAST(floor(epoch(max(event_time))) AS BIGINT)"
        " - CAST(floor(epoch(min(event_time))) AS BIGINT)) / 3600.0 AS FLOAT) AS session_duration_hours"
        f" FROM s GROUP BY {keys})"
    ), (f"SELECT {keys}, ip_count, agent_count, source_ip_address_list, user_agent_list,"
         " first_seen, last_seen, session_duration_hours FROM g"
         " WHERE (ip_count > 1 OR agent_count > 1) AND session_duration_hours <= 24")


IPV4_RX = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


def ip_long(col: str) -> str:
    parts = [f"CAST(regexp_extract({col}, {_q(IPV4_RX)}, {k}) AS BIGINT)" for k in (1, 2, 3, 4)]
    valid = " AND ".join(f"{p} <= 255" for p in parts)
    return (f"CASE WHEN regexp_matches({col}, {_q(IPV4_RX)}) AND {valid} THEN "
            f"{parts[0]} * 16777216 + {parts[1]} * 65536 + {parts[2]} * 256 + {parts[3]} END")


_H = "[0-9a-f]{1,4}"


def address_ctes(name: str, addr_sql: str) -> str:
    """``name``(the columns of addr_sql, n, h, pub): column ip as its IPv4 number and, for
    IPv6, as 32 hexadecimal digits (NULL when it isn't an address); global reachability."""
    tail = r"([0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})$"
    last = ip_long(f"regexp_extract(ip, {_q(tail)}, 1)")
    pad = "array_to_string(list_transform({0}, lambda x: lpad(x, 4, '0')), '')"
    groups = "list_filter(string_split({0}, ':'), lambda x: x <> '')"

    def within(blocks, col, text):
        return " OR ".join(f"{col} BETWEEN {text(lo)} AND {text(hi)}" for lo, hi in (_block(*x) for x in blocks))

    v6 = lambda x: f"'{x:032x}'"
    return (
        f"{name}_1 AS (SELECT *, {ip_long('ip')} AS n, CASE WHEN NOT contains(ip, ':') THEN NULL"
        f" WHEN regexp_matches(ip, {_q(':' + tail)}) THEN lower(regexp_replace(ip, {_q(tail)}, ''))"
        f" || printf('%04x:%04x', ({last}) // 65536, ({last}) % 65536) ELSE lower(ip) END AS t FROM ({addr_sql})),\n"
        f"{name}_2 AS (SELECT *, {groups.format('string_split(t, ' + _q('::') + ')[1]')} AS l,"
        f" {groups.format('string_split(t, ' + _q('::') + ')[2]')} AS r FROM {name}_1),\n"
        f"{name}_3 AS (SELECT * EXCLUDE (t, l, r), CASE WHEN regexp_full_match(t, '{_H}(:{_H}){{7}}')"
        f" THEN {pad.format('l')} WHEN regexp_full_match(t, '({_H}(:{_H})*)?::({_H}(:{_H})*)?')"
        f" AND len(l) + len(r) < 8 THEN {pad.format('l')} || repeat('0000', 8 - len(l) - len(r)) || {pad.format('r')}"
        f" END AS h FROM {name}_2),\n"
        f"{name} AS (SELECT *, CASE WHEN n IS NOT NULL THEN NOT ({within(NOT_GLOBAL_V4, 'n', str)})"
        f" OR {within(GLOBAL_EXCEPTIONS_V4, 'n', str)} WHEN h IS NOT NULL THEN NOT ({within(NOT_GLOBAL_V6, 'h', v6)})"
        f" OR {within(GLOBAL_EXCEPTIONS_V6, 'h', v6)} END AS pub FROM {name}_3)")


def skip_lookup(col: str) -> str:
    private172 = " OR ".join(f"starts_with({col}, '172.{i}.')" for i in range(16, 32))
    return (f"({col} IS NULL OR {col} = '' OR (NOT contains({col}, '.') AND NOT contains({col}, ':'))"
            f" OR starts_with({col}, '127.') OR starts_with({col}, '192.168.')"
            f" OR starts_with({col}, '10.') OR starts_with({col}, '169.254.') OR {private172})")


def lookup_cte(name: str, addr_sql: str, ranges: str, fields: list[str]) -> str:
    """``name``(ip, <fields>): longest-prefix match for public addresses of addr_sql(ip)."""
    pack = ", ".join(f"{f} := r.{f}" for f in fields)
    return (address_ctes(f"{name}_a", f"SELECT DISTINCT ip FROM ({addr_sql}) WHERE NOT {skip_lookup('ip')}") + ",\n"
            + address_ctes(f"{name}_r", "SELECT *, string_split(network, '/')[1] AS ip,"
                           f" CAST(string_split(network, '/')[2] AS INTEGER) AS plen FROM {ranges}") + ",\n"
            f"{name}_m AS (SELECT a.ip, arg_max(struct_pack({pack}), r.plen) AS rec"
            f" FROM {name}_a a LEFT JOIN {name}_r r ON a.pub AND (a.n >> (32 - r.plen) = r.n >> (32 - r.plen)"
            " OR a.n IS NULL AND r.n IS NULL AND left(a.h, r.plen // 4) = left(r.h, r.plen // 4))"
            " GROUP BY a.ip),\n"
            f"{name} AS (SELECT ip, " + ", ".join(f"rec.{f} AS {f}" for f in fields)
            + f" FROM {name}_m)")


@_with_parts
def d14_sql(lo, hi, threshold=0.5) -> str:
    strip = r"regexp_replace(source_ip_address, '^(\d+\.\d+\.\d+\.\d+):\d+$', '\1')"
    first = ("struct_pack(user_agent := user_agent, token_owner := email, service_name := service_name,"
             " action_name := action_name, account_id := account_id, workspace_id := workspace_id,"
             " request_params := request_params_text, authenticated := authenticated)")
    return _Parts(
        f"t AS (SELECT p_tokenId AS tokenId, {strip} AS ip, event_time, event_id, action_name,"
        " user_agent, email, service_name, account_id, workspace_id, request_params_text,"
        " (source_ip_address IS NOT NULL AND source_ip_address <> '') AS authenticated"
        f" FROM audit WHERE {win(lo, hi)} AND p_authenticationMethod = 'API_EXT_PAT_TOKEN')",
        "g AS (SELECT tokenId, ip AS source_ip_address, min(event_time) AS min_event_time,"
        " max(event_time) AS latest_event_time, count(action_name) AS ACTIONS,"
        f" arg_min({first}, (event_time, event_id)) AS f FROM t GROUP BY tokenId, ip)",
        lookup_cte("geo", "SELECT source_ip_address AS ip FROM g", "ip_geo", PR.GEO_FIELDS),
        "j AS (SELECT g.*, " + ", ".join(
            f"CASE WHEN {skip_lookup('g.source_ip_address')} THEN NULL ELSE geo.{f} END AS geo_{f}"
            for f in PR.GEO_FIELDS)
        + " FROM g LEFT JOIN geo ON g.source_ip_address = geo.ip)",
        "o AS (SELECT f.token_owner AS token_owner, tokenId, source_ip_address, min_event_time,"
        " latest_event_time, f.user_agent AS user_agent, ACTIONS, f.service_name AS service_name,"
        " f.action_name AS action_name, f.account_id AS account_id, f.workspace_id AS workspace_id,"
        " f.request_params AS request_params, "
        + ", ".join(f"geo_{f}" for f in PR.GEO_FIELDS)
        + ", f.authenticated AS authenticated, geo_latitude AS lat, geo_longitude AS lon FROM j"
        " WHERE f.token_owner IS NOT NULL)",
        "a AS (SELECT *, avg(ACTIONS) OVER (PARTITION BY token_owner) AS AVG_ACTIONS FROM o)"
    ), f"SELECT *, round(ACTIONS / AVG_ACTIONS, 2) AS RATE FROM a WHERE round(ACTIONS / AVG_ACTIONS, 2) <= {threshold}"


@_with_parts
def d31_sql(lo, hi, threshold=1.5) -> str:
    return _Parts(
        "d AS (SELECT executed_as, CAST(start_time AS DATE) AS activity_date,"
        " count(DISTINCT statement_text) AS unique_admin_queries FROM history"
        f" WHERE {win(lo, hi, 'start_time')} AND regexp_matches(upper(statement_text),"
        r" '^\s*(GRANT|REVOKE|ALTER|DROP|CREATE)\b') GROUP BY executed_as, CAST(start_time AS DATE))",
        "a AS (SELECT *, avg(unique_admin_queries) OVER (PARTITION BY executed_as)"
        " AS avg_daily_admin_queries FROM d)"
    ), ("SELECT executed_as, activity_date, unique_admin_queries, avg_daily_admin_queries,"
         " round(unique_admin_queries / avg_daily_admin_queries, 2) AS spike_ratio FROM a"
         f" WHERE round(unique_admin_queries / avg_daily_admin_queries, 2) >= {threshold}")


@_with_parts
def d32_sql(lo, hi, threshold_seconds=3600, threshold_value=3) -> str:
    return _Parts(
        f"r AS (SELECT email, event_time, source_ip_address, {EPOCH} AS ts FROM audit"
        f" WHERE {win(lo, hi)} AND service_name = 'secrets'"
        " AND action_name IN ('getSecret', 'listSecrets', 'listScopes') AND email IS NOT NULL)",
        "c AS (SELECT *, count(*) OVER (PARTITION BY email ORDER BY ts RANGE BETWEEN "
        f"{threshold_seconds} PRECEDING AND CURRENT ROW) AS reads_in_window FROM r)"
    ), ("SELECT email, count(*) AS total_reads, count(DISTINCT source_ip_address) AS unique_ips,"
         " min(event_time) AS first_seen, max(event_time) AS last_seen,"
         " max(reads_in_window) AS max_reads_in_window FROM c GROUP BY email"
         f" HAVING max(reads_in_window) >= {threshold_value}")


# ---------------------------------------------------------------------------
# Findings: de-duplication key over the sorted payload leaves
# ---------------------------------------------------------------------------
STATEFUL_LEAVES: dict[str, list[str]] = {
    "D11": ["email", "total_logins", "unique_ips", "first_seen", "last_seen", "max_login_count"],
    "D12": ["event_time", "email", "session_id", "source_ip_address", "user_agent", "audit_level",
            "previous_ip", "previous_agent", "previous_time", "time_diff_seconds",
            "trigger_reason"],
    "D13": ["source_ip_address", "email", "audit_level", "ip_count", "agent_count",
            "source_ip_address_list", "user_agent_list", "first_seen", "last_seen",
            "session_duration_hours"],
    "D13b": ["session_id", "email", "ip_count", "agent_count", "source_ip_address_list",
             "user_agent_list", "first_seen", "last_seen", "session_duration_hours"],
    "D14": ["token_owner", "tokenId", "source_ip_address", "min_event_time", "latest_event_time",
            "user_agent", "ACTIONS", "service_name", "action_name", "account_id", "workspace_id",
            "request_params"] + [f"geo_{f}" for f in PR.GEO_FIELDS]
           + ["authenticated", "lat", "lon", "AVG_ACTIONS", "RATE"],
    "D31": ["executed_as", "activity_date", "unique_admin_queries", "avg_daily_admin_queries",
            "spike_ratio"],
    "D32": ["email", "total_reads", "unique_ips", "first_seen", "last_seen",
            "max_reads_in_window"],
}
_STATEFUL_SQL = {"D11": d11_sql, "D12": d12_sql, "D13": d13_sql,
                 "D13b": None, "D14": d14_sql, "D31": d31_sql, "D32": d32_sql}


FLOAT_LEAVES = {"TOKEN_LIFETIME_DAYS", "session_duration_hours", "geo_latitude", "geo_longitude",
                "lat", "lon", "AVG_ACTIONS", "RATE", "avg_daily_admin_queries", "spike_ratio"}


def _leaf_text(n: str) -> str:
    if n in FLOAT_LEAVES:
        return f"CAST(CAST(\"{n}\" AS DECIMAL(38, 9)) AS VARCHAR)"
    return f"CAST(\"{n}\" AS VARCHAR)"


def dedupe_sql(names: list[str]) -> str:
    parts = ", ".join(f"coalesce({_leaf_text(n)}, '')" for n in sorted(names))
    return f"sha256(concat_ws('||', {parts}))"


TIMES = {"EVENT_DATE", "EVENT_TIME", "START_TIME", "event_time", "previous_time", "first_seen", "last_seen",
         "min_event_time", "latest_event_time"}


def _payload_value(n: str) -> str:
    """A payload column's value as the JSON text has it (strings without quotes)."""
    c = f'"{n}"'
    if n in TIMES:
        return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')"
    if n.lower() == "request_params":
        return f"CASE WHEN {c} = '' THEN '{{}}' ELSE '{{\"' || replace(replace({c}, '=', '\":\"'), ';', '\",\"') || '\"}}' END"
    if n in ("source_ip_address_list", "user_agent_list"):
        return f"CASE WHEN {c} = '' THEN '[]' ELSE '[\"' || replace({c}, ',', '\",\"') || '\"]' END"
    if n == "user_identity_email":
        return f"'{{' || coalesce('\"email\":\"' || {c} || '\"', '') || '}}'"
    return f"CAST({c} AS VARCHAR)"


def _geo_object() -> str:
    texts = ("city", "country", "country_code")
    fields = ", ".join(f"'\"{f}\":' || " + (f"'\"' || geo_{f} || '\"'" if f in texts else f"CAST(geo_{f} AS VARCHAR)")
                       for f in PR.GEO_FIELDS)
    return f"CASE WHEN {skip_lookup('source_ip_address')} THEN NULL ELSE '{{' || concat_ws(',', {fields}) || '}}' END"


def payload_sql(names: list[str]) -> str:
    """The payload's columns as sorted ``name=value`` texts, NULLs left out."""
    values = {n: _payload_value(n) for n in names if not n.startswith("geo_")}
    if len(values) < len(names):
        values["geo"] = _geo_object()
    if "user_identity_email" in values:
        values["user_identity"] = values.pop("user_identity_email")
    return "concat_ws('||', " + ", ".join(f"'{n}=' || ({v})" for n, v in sorted(
        values.items(), key=lambda x: x[0] + "=")) + ")"


def rule_body(rid: str, lo: str, hi: str, **params) -> tuple[str, list[str]]:
    """(query without the shared prefix, output column names)."""
    if rid in STATELESS or rid == "D08":
        return stateless_body(rid, lo, hi), stateless_columns(rid)
    if rid == "D13b":
        return d13_sql.body(lo, hi, corrected=True), STATEFUL_LEAVES[rid]
    return _STATEFUL_SQL[rid].body(lo, hi, **params), STATEFUL_LEAVES[rid]


def finding_sql(rid: str, lo: str, hi: str, extra: str = "", **params) -> str:
    """rule_id, severity, event_ts, event_date, dedupe_key (+ extra) of one rule."""
    from .operators.catalog import catalog
    rule = catalog()[rid]
    body, names = rule_body(rid, lo, hi, **params)
    tc = rule.time_col
    return (f"SELECT '{rid}' AS rule_id, '{rule.severity}' AS severity,"
            f" CAST(\"{tc}\" AS TIMESTAMP) AS event_ts, CAST(\"{tc}\" AS DATE) AS event_date,"
            f" {dedupe_sql(names)} AS dedupe_key{extra} FROM ({body}) t")


def findings_union_sql(rule_windows: list[tuple[str, str, str]], distinct: bool = False) -> str:
    """The findings with their payload's content (column ``payload``)."""
    body = "\nUNION ALL\n".join(
        finding_sql(rid, lo, hi, extra=f", {payload_sql(rule_body(rid, lo, hi)[1])} AS payload")
        for rid, lo, hi in rule_windows)
    if distinct:
        body = f"SELECT DISTINCT * FROM ({body}) u"
    return prefix() + body


#: The first public login of a burst in the second half of January, and 200 s: between its
#: second and third login.
CUT_IN_BURST = ("(SELECT min(ts) + INTERVAL 200 SECOND FROM events WHERE event_id % 32 >= 27"
                " AND (event_id // 32) % 7 <> 6 AND (event_id // 32) % 9 <> 8 AND ts >= TIMESTAMP '2024-01-15')")
#: Rules whose findings are groups over the whole window, and the end of such a finding.
WHOLE_WINDOW_ENDS = {"D13": "last_seen", "D13b": "last_seen", "D14": "latest_event_time",
                     "D31": "activity_date + INTERVAL 1 DAY"}
#: Rules that count bursts: a run's finding covers the logins of its own window.
BURST_PEAKS = {"D11": "max_login_count", "D32": "max_reads_in_window"}


def resumed_sql(rule_ids: list[str], lo: str, cut: str, hi: str) -> str:
    """What a run over [lo, cut] and a resumed one up to hi leave: (rule_id, item, n).

    Row rules: the findings of the whole window. Burst rules: each user's greatest
    burst over the whole window. Group rules: the first window's findings, and of
    the whole window's those that end after the cut."""
    parts = []
    for rid in rule_ids:
        body, _ = rule_body(rid, lo, hi)
        if rid in BURST_PEAKS:
            parts.append(f"SELECT '{rid}' AS rule_id, email AS item, CAST({BURST_PEAKS[rid]} AS BIGINT) AS n FROM ({body}) t")
        elif rid in WHOLE_WINDOW_ENDS:
            after = f"SELECT * FROM ({body}) b WHERE {WHOLE_WINDOW_ENDS[rid]} > {cut}"
            key = dedupe_sql(rule_body(rid, lo, hi)[1])
            first, _ = rule_body(rid, lo, cut)
            parts.append(f"SELECT DISTINCT '{rid}', {key}, 1::BIGINT FROM (({first}) UNION ALL ({after})) t")
        else:
            parts.append(f"SELECT DISTINCT rule_id, dedupe_key AS item, 1::BIGINT AS n FROM ({finding_sql(rid, lo, hi)}) t")
    return prefix() + "\nUNION ALL\n".join(parts)


def run_summary_sql(rule_windows: list[tuple[str, str, str]]) -> str:
    from .operators.catalog import catalog
    cat = catalog()
    union = "\nUNION ALL\n".join(finding_sql(rid, lo, hi) for rid, lo, hi in rule_windows)
    dim = ", ".join(f"('{rid}', '{cat[rid].name}', '{cat[rid].group}')"
                    for rid, _, _ in rule_windows)
    return prefix(f"f AS ({union})", f"dim(rule_id, name, rule_group) AS (VALUES {dim})") + (
        "SELECT d.rule_id, d.name, d.rule_group, CAST(coalesce(c.n, 0) AS BIGINT) AS findings,"
        " coalesce(c.n, 0) > 0 AS triggered FROM dim d"
        " LEFT JOIN (SELECT rule_id, count(*) AS n FROM f GROUP BY rule_id) c USING (rule_id)")


def threat_models_sql(models: dict[str, list[tuple[str, str, str]]]) -> str:
    from .operators.catalog import catalog
    cat = catalog()
    union = "\nUNION ALL\n".join(finding_sql(rid, lo, hi, extra=f", '{m}' AS threat_model")
                                 for m, rws in models.items() for rid, lo, hi in rws)
    dim = ", ".join(f"('{m}', '{rid}', '{cat[rid].name}', '{cat[rid].group}')"
                    for m, rws in models.items() for rid, _, _ in rws)
    return prefix(f"f AS ({union})",
                  f"dim(threat_model, rule_id, name, rule_group) AS (VALUES {dim})") + (
        "SELECT d.rule_id, d.name, d.rule_group, CAST(coalesce(c.n, 0) AS BIGINT) AS findings,"
        " coalesce(c.n, 0) > 0 AS triggered, d.threat_model FROM dim d LEFT JOIN"
        " (SELECT threat_model, rule_id, count(*) AS n FROM f GROUP BY threat_model, rule_id) c"
        " USING (threat_model, rule_id)")


# ---------------------------------------------------------------------------
# Enrichment and reports
# ---------------------------------------------------------------------------
def public_ip_sql() -> str:
    seen = "SELECT source_ip_address AS ip, count(*) AS events FROM audit GROUP BY source_ip_address"
    return prefix(address_ctes("a", seen)) + "SELECT ip AS source_ip_address, events, pub AS is_public FROM a"


def enrich_sql(ranges: str, fields: list[str], out: str) -> str:
    look = lookup_cte("lk", "SELECT source_ip_address AS ip FROM audit", ranges, fields)
    cols = ", ".join(f"CASE WHEN {skip_lookup('a.source_ip_address')} THEN NULL ELSE lk.{f} END"
                     f" AS {out}_{f}" for f in fields)
    return prefix(look) + (f"SELECT a.event_id, a.source_ip_address, {cols} FROM audit a"
                           " LEFT JOIN lk ON a.source_ip_address = lk.ip")


def ip_usage_sql(lo, hi) -> str:
    return prefix() + ("SELECT email, source_ip_address, min(event_time) AS earliest,"
                       " max(event_time) AS latest, count(*) AS total_events,"
                       " count(DISTINCT service_name || action_name) AS num_unique_actions"
                       f" FROM audit WHERE {win(lo, hi)} GROUP BY email, source_ip_address")


def token_usage_sql(lo, hi) -> str:
    return prefix() + ("SELECT email, p_tokenId AS tokenId, min(event_time) AS earliest,"
                       " max(event_time) AS latest, count(*) AS total_events,"
                       " count(DISTINCT source_ip_address) AS num_source_ips,"
                       " count(DISTINCT user_agent) AS num_useragents FROM audit"
                       f" WHERE {win(lo, hi)} AND action_name = 'tokenLogin'"
                       " AND p_authenticationMethod <> 'API_INT_PAT_TOKEN'"
                       " GROUP BY email, p_tokenId")


def api_actions_sql(lo, hi) -> str:
    return prefix() + ("SELECT email, service_name, action_name, min(event_time) AS earliest,"
                       " max(event_time) AS latest, count(*) AS total_events,"
                       " count(DISTINCT source_ip_address) AS num_source_ips,"
                       " count(DISTINCT user_agent) AS num_useragents FROM audit"
                       f" WHERE {win(lo, hi)} GROUP BY email, service_name, action_name")


def billing_usage_sql(lo, hi) -> str:
    return prefix() + ("SELECT created_by, usage_date, sku_name, sum(usage_quantity) AS DBU_used"
                       f" FROM billing WHERE {win(lo, hi, 'usage_start_time')}"
                       " AND usage_unit = 'DBU' GROUP BY created_by, usage_date, sku_name")


def alerts_sql(rid: str, lo: str, hi: str, ts_cols=("EVENT_DATE",),
               int_cols=("RESPONSE_CODE",), distinct: bool = False) -> str:
    """A01 for a stateless rule: alert fields without the run time; event_data
    as compact JSON (null fields left out, timestamps ISO with microseconds)."""
    body = stateless_body(rid, lo, hi)
    names = stateless_columns(rid)

    def piece(n):
        if n in ts_cols:
            return f"'\"{n}\":\"' || strftime(\"{n}\", '%Y-%m-%dT%H:%M:%S.%fZ') || '\"'"
        if n in int_cols:
            return f"'\"{n}\":' || CAST(\"{n}\" AS VARCHAR)"
        return f"'\"{n}\":\"' || \"{n}\" || '\"'"

    js = "'{' || concat_ws(',', " + ", ".join(piece(n) for n in names) + ") || '}'"
    return prefix(f"d AS ({body})") + (
        f"SELECT {'DISTINCT' if distinct else ''} {dedupe_sql(names)} AS alert_id, EVENT_DATE AS eventTime,"
        " coalesce(SRC_USER, 'unknown') AS user_email, ACTION AS event_type,"
        f" coalesce(SRC_IP, 'unknown') AS source_ip, {js} AS event_data FROM d")


def rule_table_sql(rid: str, lo: str, hi: str) -> str:
    """a stateless rule's table with its metadata; a rule column named SEVERITY is renamed."""
    from .operators.catalog import catalog
    cols = ", ".join(f'"{c}" AS "{"payload_" + c if c.lower() == "severity" else c}"' for c in stateless_columns(rid))
    return prefix() + (f"SELECT DISTINCT {cols}, '{rid}' AS rule_id, '{catalog()[rid].severity}' AS severity,"
                       f" {dedupe_sql(stateless_columns(rid))} AS dedupe_key FROM ({stateless_body(rid, lo, hi)}) t")


def without_geo_sql(lo: str, hi: str) -> str:
    """D14 where no range table is configured: typed NULLs."""
    kinds = dict(zip(PR.GEO_FIELDS, ("VARCHAR", "VARCHAR", "VARCHAR", "DOUBLE", "DOUBLE", "INTEGER")))
    nulls = ", ".join(f"CAST(NULL AS {k}) AS geo_{f}" for f, k in kinds.items())
    return prefix() + (f"SELECT * REPLACE ({nulls}, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon)"
                       f" FROM ({d14_sql.body(lo, hi, threshold=0.5)}) t")


def user_reports_sql(rule_ids: list[str], lo: str, hi: str) -> str:
    """Findings per user and rule, and the addresses, tokens and actions used, of the
    users that the secret scanner's requests came from."""
    from .operators.catalog import catalog
    cat = catalog()
    listed = f"SELECT DISTINCT SRC_USER FROM ({rule_body('D25', lo, hi)[0]}) d"
    parts = [f"SELECT \"{cat[rid].user_col or 'user_identity_email'}\" AS email, '{rid}' AS item, count(*) AS n"
             f" FROM ({rule_body(rid, lo, hi)[0]}) t GROUP BY 1" for rid in rule_ids]
    who = f"FROM audit WHERE {win(lo, hi)}"
    parts += [f"SELECT email, 'addresses', count(DISTINCT coalesce(source_ip_address, '')) {who} GROUP BY email",
              f"SELECT email, 'actions', count(DISTINCT (service_name, action_name)) {who} GROUP BY email",
              f"SELECT email, 'tokens', count(DISTINCT coalesce(p_tokenId, '')) {who} AND action_name = 'tokenLogin'"
              " AND p_authenticationMethod <> 'API_INT_PAT_TOKEN' GROUP BY email"]
    return prefix() + f"SELECT * FROM ({' UNION ALL '.join(parts)}) u WHERE email IN ({listed})"


def run_log_sql(rule_windows: list[tuple[str, str, str]], run_id: str, version: str) -> str:
    """C05 after one run: one SUCCESS row per rule with its window and count."""
    union = "\nUNION ALL\n".join(finding_sql(rid, lo, hi) for rid, lo, hi in rule_windows)
    dim = ", ".join(f"('{rid}', TIMESTAMP '{lo}', TIMESTAMP '{hi}')" for rid, lo, hi in rule_windows)
    return prefix(f"f AS ({union})", f"dim(rule_id, lo, hi) AS (VALUES {dim})") + (
        f"SELECT '{run_id}' AS run_id, '{version}' AS runner_version, CAST(NULL AS VARCHAR) AS error_message,"
        " TRUE AS started_before_end, TRUE AS lasted, TRUE AS created_at_end,"
        " d.rule_id, 'SUCCESS' AS status, CAST(coalesce(c.n, 0) AS BIGINT) AS row_count,"
        " d.lo AS window_start_ts, d.hi AS window_end_ts FROM dim d"
        " LEFT JOIN (SELECT rule_id, count(*) AS n FROM f GROUP BY rule_id) c USING (rule_id)")
