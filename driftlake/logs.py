"""Run, query, grant, tag and access logs made from the test tables, so that they grow with them; one text for both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from driftlake.sources.tables import scan

#: The time at which reports are made, a little after the last event.
NOW = "2024-01-31 00:00:00"
_U = "concat('U', CAST(user_id AS STRING))"
_O = "CAST(floor(p_partkey / 3) AS BIGINT)"
_WHERE = f"concat('DB', CAST({_O} % 4 AS STRING)) AS {{0}}, CASE WHEN {_O} % 9 = 8 THEN 'INFORMATION_SCHEMA' ELSE 'S1' END AS {{1}}, concat('T', CAST({_O} AS STRING)) AS {{2}}"
_DAY = "CAST('2024-01-01' AS TIMESTAMP_NTZ) + INTERVAL '1' DAY * CAST({0} % 30 AS INT)"
_COLUMN = "CASE CAST(p_partkey % 3 + 3 * (p_size % 2) AS INT) WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'HOME_PHONE' WHEN 2 THEN 'FILE_NAME' WHEN 3 THEN 'LAST_NAME' WHEN 4 THEN 'AMOUNT' ELSE 'CREDIT_CARD_NO' END"

LOGS = {
    "user_grants": f"SELECT {_U} AS user_name, CASE CAST(event_id % 8 AS INT) WHEN 0 THEN 'ACCOUNTADMIN' WHEN 1 THEN 'ANALYST' WHEN 2 THEN 'ENGINEER' ELSE concat('ROLE_', CAST(event_id AS STRING)) END AS role_name, CASE WHEN event_id % 7 = 0 THEN 'ROLE' ELSE 'USER' END AS granted_to, concat('U', CAST(user_id % 5 AS STRING)) AS granted_by, ts AS created_on, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL '2' DAY END AS deleted_on FROM {{events}} WHERE event_id % 3 = 0",
    "role_grants": "SELECT concat('ROLE_', CAST(event_id + 1 AS STRING)) AS name, CASE CAST(event_id % 11 AS INT) WHEN 0 THEN 'SYSADMIN' WHEN 1 THEN 'SYS_LOADER' ELSE concat('ROLE_', CAST(floor(event_id / 2) AS BIGINT)) END AS grantee_name, CASE CAST(event_id % 7 AS INT) WHEN 0 THEN 'OWNERSHIP' WHEN 1 THEN 'MANAGE GRANTS' WHEN 2 THEN 'CREATE ROLE' WHEN 3 THEN 'USAGE' ELSE 'SELECT' END AS privilege, CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 'ROLE' WHEN 1 THEN 'TABLE' WHEN 2 THEN 'SCHEMA' ELSE 'FUTURE TABLE' END AS granted_on, event_id % 6 = 0 AS grant_option, concat('U', CAST(user_id % 5 AS STRING)) AS granted_by, ts AS created_on, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL '2' DAY END AS deleted_on FROM {events} WHERE event_id % 3 = 1",
    "roles": "SELECT concat(CASE WHEN event_id % 13 = 0 THEN 'SYS_' ELSE 'ROLE_' END, CAST(event_id AS STRING)) AS name, ts AS created_on, concat('U', CAST(user_id AS STRING)) AS owner, event_type AS comment, CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL '1' DAY END AS deleted_on FROM {events} WHERE event_type IN ('signup', 'purchase')",
    "query_log": f"SELECT event_id AS query_id, CASE WHEN user_id % 20 = 0 THEN concat('SYS_', CAST(user_id AS STRING)) ELSE {_U} END AS user_name, CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'ACCOUNTADMIN' WHEN 1 THEN 'SECURITYADMIN' WHEN 2 THEN 'ANALYST' WHEN 3 THEN 'ENGINEER' ELSE 'SYS_TASK' END AS role_name, CASE CAST(user_id % 4 AS INT) WHEN 0 THEN 'FINANCE_DB' WHEN 1 THEN 'HR_DB' WHEN 2 THEN 'SALES_DB' END AS database_name, CASE WHEN event_type = 'error' THEN CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '1063' WHEN 1 THEN '3001' ELSE '9999' END END AS error_code, CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'grant role accountadmin to user x' WHEN 1 THEN 'create role y' WHEN 2 THEN 'select 1' WHEN 3 THEN 'grant manage grants to z' ELSE 'insert into t' END AS query_text, CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'GRANT' WHEN 1 THEN 'CREATE_ROLE' WHEN 3 THEN 'GRANT' WHEN 4 THEN 'DROP_TABLE' ELSE 'SELECT' END AS query_type, CAST(floor(value * 100) AS BIGINT) AS elapsed_ms, event_id * 1000000 AS bytes_scanned, ts AS start_time FROM {{events}}",
    "tags": f"SELECT {_WHERE.format('object_database', 'object_schema', 'object_name')}, CASE WHEN p_size % 4 = 0 THEN 'COLUMN' ELSE 'TABLE' END AS object_type, {_COLUMN} AS column_name, CASE WHEN p_size % 10 = 9 THEN 'OTHER' ELSE 'GOVERNANCE' END AS tag_database, CASE CAST(p_partkey % 7 AS INT) WHEN 0 THEN 'PII_TYPE' WHEN 1 THEN 'DATA_SENSITIVITY' WHEN 2 THEN 'DATA_RESIDENCY' WHEN 3 THEN 'COMPLIANCE_SCOPE' WHEN 4 THEN 'RETENTION_PERIOD' WHEN 5 THEN 'PII_FLAG' ELSE 'COST_CENTER' END AS tag_name, CASE CAST(p_partkey % 7 AS INT) WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN 'RESTRICTED' ELSE 'PUBLIC' END WHEN 2 THEN CASE WHEN p_size % 2 = 0 THEN 'EU' ELSE 'US' END WHEN 3 THEN CASE WHEN p_size % 2 = 0 THEN 'SOX' ELSE 'HIPAA' END WHEN 4 THEN CASE WHEN p_size % 2 = 0 THEN '30_DAYS' ELSE 'PERMANENT' END ELSE concat('V', CAST(p_size % 3 AS STRING)) END AS tag_value, {_DAY.format('p_partkey')} AS tag_created, CASE WHEN p_partkey % 17 = 0 THEN {_DAY.format('p_size')} END AS deleted FROM {{part}} WHERE p_partkey % 5 < 3",
    "tables": f"SELECT {_WHERE.format('table_catalog', 'table_schema', 'table_name')}, p_partkey * 10 AS row_count, p_partkey * 1000 AS bytes, p_size * 500 AS history_bytes, {_DAY.format('p_size')} AS created, CASE WHEN p_partkey % 19 = 0 THEN {_DAY.format('p_size')} END AS deleted FROM {{part}} WHERE p_partkey % 3 = 0",
    "columns": f"SELECT {_WHERE.format('table_catalog', 'table_schema', 'table_name')}, {_COLUMN} AS column_name, CASE WHEN p_size % 2 = 0 THEN 'TEXT' ELSE 'NUMBER' END AS data_type, CASE WHEN p_partkey % 23 = 0 THEN {_DAY.format('p_size')} END AS deleted FROM {{part}}",
    "policy_refs": f"SELECT {_WHERE.format('ref_database', 'ref_schema', 'ref_table')}, {_COLUMN} AS ref_column, concat('mask_', CAST(p_size % 10 AS STRING)) AS policy_name, CASE WHEN p_size % 8 = 0 THEN 'ROW_ACCESS_POLICY' ELSE 'MASKING_POLICY' END AS policy_kind, concat('U', CAST(p_size % 3 AS STRING)) AS policy_owner, CASE WHEN p_partkey % 29 = 0 THEN {_DAY.format('p_size')} END AS deleted FROM {{part}} WHERE p_partkey % 4 < 2",
    "policies": f"SELECT DISTINCT concat('mask_', CAST(p_size AS STRING)) AS name, {_DAY.format('p_size')} AS created, CASE WHEN p_size % 6 = 5 THEN {_DAY.format('p_size')} END AS deleted FROM {{part}}",
    "users": f"SELECT concat('U', CAST(c_custkey AS STRING)) AS name, {_DAY.format('c_custkey')} AS created_on, CASE WHEN c_custkey % 10 = 0 THEN {_DAY.format('c_nationkey')} END AS deleted_on, c_acctbal < 0 AS disabled, concat('ROLE_', CAST(c_nationkey AS STRING)) AS default_role FROM {{customer}}",
    "logins": f"SELECT event_id, {_U} AS user_name, concat('10.0.0.', CAST(user_id % 6 AS STRING)) AS client_ip, CASE WHEN event_type = 'error' THEN 'NO' ELSE 'YES' END AS is_success, ts FROM {{events}}",
    "exceptions": f"SELECT o_orderkey AS exception_id, concat('ROLE_', CAST(o_custkey AS STRING)) AS role_name, concat('U', CAST(o_custkey % 100 AS STRING)) AS grantee, o_orderstatus <> 'P' AS is_active, {_DAY.format('o_orderkey')} AS granted_on, CAST('2024-01-25' AS TIMESTAMP_NTZ) + INTERVAL '1' DAY * CAST(o_orderkey % 90 AS INT) AS expires_on FROM {{orders}}",
    "runs": f"SELECT event_id AS run_id, concat('T', CAST(user_id AS STRING)) AS table_name, concat('G', CAST(user_id % 6 AS STRING)) AS schedule_group, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'ERROR' ELSE 'FAILED' END WHEN event_type = 'signup' THEN 'NO_DATA' ELSE 'SUCCESS' END AS status, ts AS start_time, ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) AS end_time, event_id % 100 AS n_inserted, event_id % 30 AS n_updated, event_id % 7 AS n_deleted, CASE WHEN event_type = 'error' THEN concat('error ', CAST(event_id % 4 AS STRING)) END AS error_message, CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' ELSE 'MIXED' END AS operation, CAST(event_id % 6 AS INT) AS size_class FROM {{events}}",
    "pipelines": "SELECT DISTINCT concat('T', CAST(user_id AS STRING)) AS table_name, concat('stream_', CAST(user_id AS STRING)) AS stream_name, user_id % 9 <> 0 AS is_active, CAST(30 + user_id % 400 * 20 AS INT) AS alert_minutes, CAST(user_id % 10 AS INT) AS priority FROM {events}",
    "streams": "SELECT concat('T', CAST(user_id AS STRING)) AS table_name, max(ts) + INTERVAL '1' HOUR * CAST(min(user_id) % 40 - 10 AS INT) AS stale_after, count(*) % 3 > 0 AS has_data FROM {events} WHERE user_id % 7 <> 3 GROUP BY user_id",
    "alerts": "SELECT event_id AS alert_id, CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'STREAM_STALE' WHEN 1 THEN 'TASK_FAILURE' ELSE 'STREAM_STALENESS_WARNING' END AS alert_type, CASE WHEN event_id % 3 = 2 THEN 'WARNING' ELSE 'CRITICAL' END AS severity, concat('T', CAST(user_id AS STRING)) AS table_name, event_type <> 'purchase' AS is_acknowledged, ts AS created_at FROM {events} WHERE event_id % 2 = 0",
    "cleanups": f"SELECT o_orderkey AS run_id, concat('T', CAST(o_custkey AS STRING)) AS table_name, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'SKIPPED' END AS status, o_orderkey % 1000 AS rows_before, o_orderkey % 300 AS rows_deleted, {_DAY.format('o_orderkey')} AS run_at FROM {{orders}}",
}


def log(spark: SparkSession, sf: str, name: str) -> DataFrame:
    sql = LOGS[name]
    return spark.sql(sql, **{t: scan(spark, sf, t) for t in set(re.findall(r"\{(\w+)\}", sql))})


def with_logs(*names: str) -> str:
    """The logs as the common table expressions of a DuckDB query."""
    plain = lambda n: re.sub(r"\{(\w+)\}", r"\1", LOGS[n]).replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return "WITH " + ", ".join(f"{n} AS ({plain(n)})" for n in names) + " "
