"""Column expressions shared by the detection rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Regular expressions and known-agent lists of the rule set.
# They are unanchored and case-sensitive unless the pattern says otherwise.
# ---------------------------------------------------------------------------
PRIVATE_IP_REGEX = r"^(10\..*|192\.168\..*|172\.(1[6-9]|2[0-9]|3[0-1])\..*)$"
UUID_REGEX = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
TOKEN_AGENT_REGEX = r"(?i)linux auth.*$"
TOKEN_KNOWN_IP_REGEX = "52.9.53.2"  # default of a rule parameter
LOGIN_ACTIONS = ["login", "tokenLogin", "samlLogin", "jwtLogin"]
NON_SSO_ACTIONS = ["login", "certLogin", "jwtLogin", "mfaLogin",
                   "passwordVerifyAuthentication", "samlLogin"]
SERVICE_AGENTS = ["databricks", "Databricks-Service/driver", "Databricks-Runtime",
                  "Delta-Sharing-SparkStructuredStreaming", "RawDBHttpClient",
                  "mlflow-python", "feature-store"]
LOGIN_BURST_AGENTS = SERVICE_AGENTS + ["dbr:"]
DEVICE_SWITCH_AGENTS = ["Databricks-Service/driver", "Databricks-Runtime",
                        "Delta-Sharing-SparkStructuredStreaming"]
DENIED_IP_AGENTS = ["databricks", "Databricks-Service/driver", "Databricks-Runtime",
                    "Delta-Sharing-SparkStructuredStreaming", "RawDBHttpClient",
                    "mlflow-python", "obsSDK-scala/1.0.0", "wsfs/1.0", "feature-store"]
DENIED_IP_EXCLUDED_PATHS = ["telemetry", "delta-commit", "health"]
IP_ACCESS_LIST_ACTIONS = ["createIpAccessList", "deleteIpAccessList", "updateIpAccessList"]
CREDENTIAL_ACTIONS = ["mount", "createStorageCredential", "updateStorageCredential",
                      "createConnection", "updateConnection"]
DOWNLOAD_ACTIONS = ["downloadPreviewResults", "downloadLargeResults", "filesGet",
                    "getModelVersionDownloadUri", "getModelVersionSignedDownloadUri"]
ADMIN_CHANGE_ACTIONS = ["setAccountAdmin", "changeAccountOwner", "setAdmin", "removeAdmin"]
GROUP_MEMBER_ACTIONS = ["addPrincipalToGroup", "removePrincipalFromGroup"]
ROLE_ACTIONS = ["addUserToAdminGroup", "modifyUserRole"]


def alternation(words: list[str]) -> str:
    """Words joined into one regex alternation, as given (not escaped)."""
    return "|".join(words)


def col(name: str) -> Column:
    return F.col(name)


def email() -> Column:
    return F.col("user_identity.email")


def status_code() -> Column:
    return F.col("response.status_code")


def param(key: str) -> Column:
    """A request parameter; a missing key is NULL."""
    return F.col("request_params").getItem(key)


def service(name: str) -> Column:
    return F.col("service_name") == name


def action(*names: str) -> Column:
    return F.col("action_name").isin(*names)


def accounts_action(*names: str) -> Column:
    return service("accounts") & action(*names)


def status_text() -> Column:
    """'Success' for 200, 'Failure' otherwise (NULL included)."""
    return F.when(status_code() == 200, "Success").otherwise("Failure")


def not_rlike(c: Column, pattern: str) -> Column:
    """Negated regex; NULL input yields NULL, so a filter drops the row."""
    return ~c.rlike(pattern)


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
