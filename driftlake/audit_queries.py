"""Audit, masking and access reports over logs made from the test tables, with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlake.logs import NOW, log, with_logs
from driftlake.operators import audit, governance
from driftlake.registry import Registry
from driftlake.sources.tables import scan

R = Registry()
_NOW = f"TIMESTAMP '{NOW}'"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def _since(days: float):
    return _now() - F.make_dt_interval(F.lit(0), F.lit(int(days * 24)))


def over(name: str, logs: str, use, sql: str) -> None:
    """use(the logs, in order) and the same over the same logs in SQL."""
    names = logs.split()
    R.add(name, lambda spark, sf: use(*[log(spark, sf, n) for n in names]), with_logs(*names) + sql)


_LIVE = "deleted_on IS NULL"
over("audit_user_roles", "user_grants", lambda g: audit.user_roles(g, _now()), f"SELECT user_name, role_name, created_on, granted_by, date_diff('day', created_on, {_NOW})::INT AS days_assigned FROM user_grants WHERE granted_to = 'USER' AND {_LIVE}")
over("audit_multi_role", "user_grants", audit.multi_role, f"SELECT user_name, count(DISTINCT role_name) AS role_count, string_agg(DISTINCT role_name, ', ' ORDER BY role_name) AS roles FROM user_grants WHERE granted_to = 'USER' AND {_LIVE} GROUP BY 1 HAVING count(DISTINCT role_name) > 1")
over("audit_admins", "user_grants", lambda g: audit.admins(g, _now()), f"SELECT user_name, created_on, granted_by, date_diff('day', created_on, {_NOW})::INT AS days_with_admin FROM user_grants WHERE role_name = 'ACCOUNTADMIN' AND {_LIVE}")
over("audit_recent_roles", "user_grants", lambda g: audit.recent_roles(g, _now(), _since(7)), f"SELECT user_name, role_name, created_on, granted_by, date_diff('hour', created_on, {_NOW}) AS hours_ago FROM user_grants WHERE granted_to = 'USER' AND {_LIVE} AND created_on >= {_NOW} - INTERVAL 7 DAY")
over("audit_orphan_roles", "roles role_grants user_grants", audit.orphan_roles, f"SELECT name, created_on, owner, comment FROM roles r WHERE {_LIVE} AND name NOT LIKE 'SYS\\_%' ESCAPE '\\' AND NOT EXISTS (SELECT 1 FROM role_grants g WHERE g.name = r.name AND g.{_LIVE}) AND NOT EXISTS (SELECT 1 FROM user_grants u WHERE u.role_name = r.name AND u.{_LIVE})")
_OWN = "NOT starts_with(grantee_name, 'SYS_')"
over("audit_privileges", "role_grants", audit.privileges, f"SELECT grantee_name, privilege, granted_on, name, grant_option, granted_by, created_on FROM role_grants WHERE {_LIVE} AND {_OWN}")
over("audit_owners", "role_grants", audit.owners, f"SELECT grantee_name, granted_on, name, created_on FROM role_grants WHERE {_LIVE} AND privilege = 'OWNERSHIP'")
over("audit_dangerous", "role_grants", audit.dangerous, f"SELECT grantee_name, privilege, granted_on, name, granted_by, created_on FROM role_grants WHERE {_LIVE} AND privilege IN ('MANAGE GRANTS', 'CREATE ROLE', 'CREATE USER', 'OWNERSHIP') AND grantee_name NOT IN ('ACCOUNTADMIN', 'SECURITYADMIN', 'USERADMIN', 'SYSADMIN')")
over("audit_future_grants", "role_grants", audit.future_grants, f"SELECT grantee_name, granted_on, count(*) AS future_grants, string_agg(DISTINCT privilege, ', ' ORDER BY privilege) AS privileges FROM role_grants WHERE {_LIVE} AND granted_on LIKE '%FUTURE%' GROUP BY 1, 2")
over("audit_privilege_changes", "role_grants", lambda g: audit.privilege_changes(g, _since(10)), f"SELECT grantee_name, privilege, granted_on, name, coalesce(deleted_on, created_on) AS change_date, granted_by, CASE WHEN {_LIVE} THEN 'GRANTED' ELSE 'REVOKED' END AS action FROM role_grants WHERE (created_on >= {_NOW} - INTERVAL 10 DAY OR deleted_on >= {_NOW} - INTERVAL 10 DAY) AND {_OWN}")
over("grant_audit", "role_grants", lambda g: audit.grant_audit(g, _since(10)), f"SELECT created_on, privilege, granted_on, name, grantee_name, grant_option, granted_by FROM role_grants WHERE created_on > {_NOW} - INTERVAL 10 DAY")
_TAGS = "FROM tags WHERE tag_database = 'GOVERNANCE' AND deleted IS NULL"
over("audit_tag_coverage", "tags", audit.tag_coverage, f"SELECT object_database, count(DISTINCT object_name) AS tagged_objects, count(DISTINCT object_name) FILTER (object_type = 'TABLE') AS tagged_tables, count(DISTINCT object_name) FILTER (object_type = 'COLUMN') AS tagged_columns, count(DISTINCT tag_name) AS unique_tags {_TAGS} GROUP BY 1")
over("audit_top_tags", "tags", audit.top_tags, f"SELECT tag_name, count(DISTINCT object_name) AS usage_count, count(DISTINCT object_database) AS databases_used, string_agg(DISTINCT tag_value, ', ' ORDER BY tag_value) AS common_values {_TAGS} GROUP BY 1")
_BARE = "deleted IS NULL AND table_schema NOT IN ('INFORMATION_SCHEMA', 'ACCOUNT_USAGE') AND NOT EXISTS (SELECT 1 FROM tags g WHERE g.object_database = t.table_catalog AND g.object_schema = t.table_schema AND g.object_name = t.table_name AND g.tag_database = 'GOVERNANCE' AND g.deleted IS NULL)"
over("audit_untagged", "tables tags", lambda t, g: audit.untagged(t, g, _now()), f"SELECT table_catalog, table_schema, table_name, row_count, bytes, created, date_diff('day', created, {_NOW})::INT AS days_old FROM tables t WHERE {_BARE}")
over("untagged_tables", "tables tags", lambda t, g: audit.untagged(t, g, _now()).orderBy(F.desc_nulls_last("row_count"), "table_name").limit(100), f"SELECT table_catalog, table_schema, table_name, row_count, bytes, created, date_diff('day', created, {_NOW})::INT AS days_old FROM tables t WHERE {_BARE} ORDER BY row_count DESC NULLS LAST, table_name LIMIT 100")
over("audit_pii_inventory", "tags columns", audit.pii_inventory, "SELECT g.object_database, g.object_schema, g.object_name, g.column_name, g.tag_value AS pii_type, g.tag_created, c.data_type FROM tags g JOIN columns c ON g.object_database = c.table_catalog AND g.object_schema = c.table_schema AND g.object_name = c.table_name AND g.column_name = c.column_name WHERE g.tag_name LIKE 'PII\\_%' ESCAPE '\\' AND g.deleted IS NULL AND c.deleted IS NULL")
over("pii_columns", "tags columns", lambda t, c: audit.pii_inventory(t, c).select("object_name", "column_name").distinct(), "SELECT DISTINCT g.object_name, g.column_name FROM tags g JOIN columns c ON g.object_database = c.table_catalog AND g.object_schema = c.table_schema AND g.object_name = c.table_name AND g.column_name = c.column_name WHERE g.tag_name IN ('PII_TYPE', 'PII_FLAG') AND g.deleted IS NULL AND c.deleted IS NULL")
over("audit_sensitivity", "tags", audit.sensitivity, "SELECT object_database, object_schema, object_name, tag_value AS sensitivity_level, tag_created, CASE tag_value WHEN 'RESTRICTED' THEN 1 WHEN 'CONFIDENTIAL' THEN 2 WHEN 'INTERNAL' THEN 3 WHEN 'PUBLIC' THEN 4 END::INT AS rank FROM tags WHERE tag_name = 'DATA_SENSITIVITY' AND deleted IS NULL")
over("audit_policy_use", "policy_refs policies", audit.policy_use, "SELECT r.policy_name, r.policy_kind, r.policy_owner, p.created, count(DISTINCT r.ref_database || '.' || r.ref_schema || '.' || r.ref_table) AS protected_objects FROM policy_refs r JOIN policies p ON r.policy_name = p.name WHERE r.deleted IS NULL AND p.deleted IS NULL AND r.policy_kind = 'MASKING_POLICY' GROUP BY ALL")
over("audit_unmasked_pii", "columns policy_refs", audit.unmasked_pii, "SELECT table_catalog, table_schema, table_name, column_name, data_type, CASE column_name WHEN 'EMAIL' THEN 'Likely PII - Email' WHEN 'HOME_PHONE' THEN 'Likely PII - Phone' WHEN 'CREDIT_CARD_NO' THEN 'Likely PII - Credit Card' ELSE 'Likely PII - Name' END AS pii_likelihood FROM columns c WHERE deleted IS NULL AND table_schema <> 'INFORMATION_SCHEMA' AND column_name IN ('EMAIL', 'HOME_PHONE', 'CREDIT_CARD_NO', 'LAST_NAME') AND NOT EXISTS (SELECT 1 FROM policy_refs r WHERE r.ref_database = c.table_catalog AND r.ref_schema = c.table_schema AND r.ref_table = c.table_name AND r.ref_column = c.column_name AND r.policy_kind = 'MASKING_POLICY' AND r.deleted IS NULL)")
_WEEK = f"start_time >= {_NOW} - INTERVAL 7 DAY"
_MONTH = f"start_time >= {_NOW} - INTERVAL 30 DAY"
over("audit_active_users", "query_log", lambda q: audit.active_users(q, _since(7)).orderBy(F.desc("query_count"), "user_name").limit(50), f"SELECT user_name, count(*) AS query_count, count(DISTINCT database_name) AS databases_accessed, count(DISTINCT query_id) FILTER (error_code IS NOT NULL) AS failed_queries, min(start_time) AS first_query, max(start_time) AS last_query FROM query_log WHERE {_WEEK} AND NOT starts_with(user_name, 'SYS_') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
over("audit_failed_access", "query_log", lambda q: audit.failed_access(q, _since(7)), f"SELECT query_id, user_name, role_name, database_name, query_text, error_code, start_time FROM query_log WHERE {_WEEK} AND error_code IN ('1063', '3001', '3003', '3011')")
over("audit_sensitive_access", "query_log", lambda q: audit.sensitive_access(q, _since(30), ["FINANCE_DB", "HR_DB"]), f"SELECT user_name, role_name, database_name, count(*) AS query_count, min(start_time) AS first_access, max(start_time) AS last_access FROM query_log WHERE {_MONTH} AND database_name IN ('FINANCE_DB', 'HR_DB') AND NOT starts_with(user_name, 'SYS_') GROUP BY 1, 2, 3")
over("audit_gdpr", "tags", audit.gdpr, "SELECT a.object_database, a.object_schema, a.object_name, a.column_name, a.tag_value AS pii_type, b.tag_value AS data_residency FROM tags a LEFT JOIN tags b ON a.object_database = b.object_database AND a.object_schema = b.object_schema AND a.object_name = b.object_name AND b.tag_name = 'DATA_RESIDENCY' AND b.deleted IS NULL WHERE a.tag_name IN ('PII_TYPE', 'PII_FLAG') AND a.deleted IS NULL AND (b.tag_value = 'EU' OR b.tag_value IS NULL)")
over("audit_sox", "tags tables columns", audit.sox, "SELECT g.object_database, g.object_schema, g.object_name, g.tag_value AS compliance_scope, t.row_count, count(DISTINCT c.column_name) AS column_count FROM tags g JOIN tables t ON g.object_database = t.table_catalog AND g.object_schema = t.table_schema AND g.object_name = t.table_name LEFT JOIN columns c ON t.table_catalog = c.table_catalog AND t.table_schema = c.table_schema AND t.table_name = c.table_name WHERE g.tag_name = 'COMPLIANCE_SCOPE' AND g.tag_value = 'SOX' AND g.deleted IS NULL AND t.deleted IS NULL GROUP BY 1, 2, 3, 4, 5")
over("audit_retention", "tags", lambda t: audit.retention(t, _now()), f"SELECT object_database, object_schema, object_name, tag_value AS retention_period, tag_created, date_diff('day', tag_created, {_NOW})::INT AS days_since_tagged, CASE tag_value WHEN '30_DAYS' THEN 1 ELSE 7 END::INT AS rank FROM tags WHERE tag_name = 'RETENTION_PERIOD' AND deleted IS NULL")
over("audit_new_roles", "roles", lambda r: audit.new_roles(r, _now(), _since(7)), f"SELECT name, created_on, owner, comment, date_diff('hour', created_on, {_NOW}) AS hours_since_creation FROM roles WHERE created_on >= {_NOW} - INTERVAL 7 DAY AND NOT starts_with(name, 'SYS_')")
over("audit_admin_use", "query_log", lambda q: audit.admin_use(q, _since(30)), f"SELECT user_name, role_name, count(*) AS query_count, min(start_time) AS first_usage, max(start_time) AS last_usage, count(DISTINCT start_time::DATE) AS days_active FROM query_log WHERE role_name = 'ACCOUNTADMIN' AND {_MONTH} GROUP BY 1, 2")
over("audit_escalation", "query_log", lambda q: audit.escalation(q, _since(7)), f"SELECT query_id, user_name, role_name, query_text, error_code, start_time FROM query_log WHERE {_WEEK} AND (query_text ILIKE '%GRANT%ACCOUNTADMIN%' OR query_text ILIKE '%GRANT%SECURITYADMIN%' OR query_text ILIKE '%CREATE ROLE%' OR query_text ILIKE '%MANAGE GRANTS%') AND role_name NOT IN ('ACCOUNTADMIN', 'SECURITYADMIN', 'USERADMIN')")
over("audit_role_usage", "query_log", lambda q: audit.role_usage(q, _since(30)), f"SELECT role_name, count(DISTINCT user_name) AS unique_users, count(*) AS total_queries, sum(elapsed_ms)::DOUBLE / 1000 AS total_seconds, sum(elapsed_ms)::DOUBLE / count(elapsed_ms) / 1000 AS average_seconds FROM query_log WHERE {_MONTH} AND NOT starts_with(role_name, 'SYS_') GROUP BY 1")
over("audit_db_access", "query_log", lambda q: audit.db_access(q, _since(7)), f"SELECT database_name, count(DISTINCT user_name) AS unique_users, count(*) AS query_count, sum(bytes_scanned)::DOUBLE / 1073741824.0::DOUBLE AS gb_scanned FROM query_log WHERE {_WEEK} AND database_name IS NOT NULL AND database_name <> 'SYSTEM' GROUP BY 1")
over("audit_health", "users roles tags policies tables user_grants", audit.health, f"SELECT 'Total Users' AS metric, count(DISTINCT name) AS value FROM users WHERE {_LIVE} UNION ALL SELECT 'Total Custom Roles', count(DISTINCT name) FROM roles WHERE {_LIVE} AND NOT starts_with(name, 'SYS_') UNION ALL SELECT 'Total Tagged Objects', count(DISTINCT object_database || '.' || object_schema || '.' || object_name) {_TAGS} UNION ALL SELECT 'Active Masking Policies', count(DISTINCT name) FROM policies WHERE deleted IS NULL UNION ALL SELECT 'Tables Without Tags', count(DISTINCT table_catalog || '.' || table_schema || '.' || table_name) FROM tables t WHERE {_BARE} UNION ALL SELECT 'Users with ACCOUNTADMIN', count(DISTINCT user_name) FROM user_grants WHERE role_name = 'ACCOUNTADMIN' AND {_LIVE}")
over("role_privilege_count", "role_grants", audit.privilege_count, f"SELECT grantee_name, count(DISTINCT name) AS inherited_roles, count(DISTINCT name) FILTER (granted_on <> 'ROLE') AS direct_privileges FROM role_grants WHERE {_LIVE} AND {_OWN} GROUP BY 1")
over("role_edges", "role_grants", audit.role_edges, f"SELECT name AS child, grantee_name AS parent, created_on FROM role_grants WHERE granted_on = 'ROLE' AND {_LIVE} AND {_OWN}")
_LEFT = f"date_diff('day', {_NOW}, expires_on)::INT"
_STATE = f"CASE WHEN expires_on < {_NOW} THEN 'EXPIRED' WHEN {_LEFT} <= 7 THEN 'EXPIRING_SOON' WHEN {_LEFT} <= 30 THEN 'EXPIRING_MONTH' ELSE 'ACTIVE' END"
over("active_assignments", "exceptions", lambda e: audit.remaining(e, _now()), f"SELECT *, {_LEFT} AS days_remaining, {_STATE} AS status FROM exceptions WHERE is_active")
over("expiring_access", "exceptions", lambda e: audit.remaining(e, _now()).where("status in ('EXPIRED', 'EXPIRING_SOON', 'EXPIRING_MONTH')"), f"SELECT *, {_LEFT} AS days_remaining, {_STATE} AS status FROM exceptions WHERE is_active AND {_LEFT} <= 30")
over("policy_exceptions", "exceptions", lambda e: audit.remaining(e, _now()).groupBy("role_name", "status").agg(F.count("*").alias("n"), F.min("expires_on").alias("next_expiry")), f"SELECT role_name, {_STATE} AS status, count(*) AS n, min(expires_on) AS next_expiry FROM exceptions WHERE is_active GROUP BY 1, 2")
over("role_catalog", "roles", lambda r: audit.role_catalog(r, "ROLE_1"), f"SELECT name, owner, comment, created_on FROM roles WHERE {_LIVE} AND name LIKE 'ROLE\\_1%' ESCAPE '\\'")
over("user_role_list", "user_grants", lambda g: audit.in_force(g).groupBy("user_name").agg(F.array_join(F.array_sort(F.collect_set("role_name")), ",").alias("roles")), f"SELECT user_name, string_agg(DISTINCT role_name, ',' ORDER BY role_name) AS roles FROM user_grants WHERE {_LIVE} GROUP BY 1")
over("tag_catalog", "tags", audit.tag_catalog, f"SELECT tag_name, string_agg(DISTINCT tag_value, ', ' ORDER BY tag_value) AS allowed_values, min(tag_created) AS first_used {_TAGS} GROUP BY 1")
over("tag_coverage_by_db", "tables tags", audit.tag_coverage_by_db, f"SELECT table_catalog, count(*) AS n_tables, count(*) FILTER (hit) AS n_tagged, round(100.0 * count(*) FILTER (hit) / count(*), 2)::DOUBLE AS coverage_pct FROM (SELECT table_catalog, EXISTS (SELECT 1 FROM tags g WHERE g.object_database = t.table_catalog AND g.object_schema = t.table_schema AND g.object_name = t.table_name AND g.tag_database = 'GOVERNANCE' AND g.deleted IS NULL) AS hit FROM tables t WHERE deleted IS NULL) GROUP BY 1")
over("policy_associations", "tags policy_refs", audit.policy_associations, "SELECT DISTINCT g.tag_name, r.policy_name, r.policy_kind FROM tags g JOIN policy_refs r ON r.ref_database = g.object_database AND r.ref_schema = g.object_schema AND r.ref_table = g.object_name AND r.ref_column = g.column_name WHERE g.tag_database = 'GOVERNANCE' AND g.deleted IS NULL AND r.deleted IS NULL")
over("failed_logins", "logins", lambda x: audit.failed_logins(x, _since(7)), f"SELECT * FROM logins WHERE is_success = 'NO' AND ts > {_NOW} - INTERVAL 7 DAY")
over("brute_force", "logins", lambda x: audit.brute_force(x, _since(1)), f"SELECT client_ip, count(*) AS failed_attempts, count(DISTINCT user_name) AS users_attempted, min(ts) AS first_attempt, max(ts) AS last_attempt FROM logins WHERE is_success = 'NO' AND ts > {_NOW} - INTERVAL 1 DAY GROUP BY 1 HAVING count(*) > 5")
over("admin_activity", "query_log", lambda q: audit.admin_activity(q, _since(7)), f"SELECT query_id, user_name, role_name, query_type, query_text, start_time FROM query_log WHERE role_name = 'ACCOUNTADMIN' AND start_time > {_NOW} - INTERVAL 7 DAY")
over("ddl_changes", "query_log", lambda q: audit.ddl_changes(q, _since(30)), f"SELECT query_id, user_name, role_name, query_type, query_text, start_time, database_name FROM query_log WHERE query_type IN ('CREATE_TABLE', 'DROP_TABLE', 'ALTER_TABLE', 'CREATE_VIEW', 'DROP_VIEW', 'ALTER_VIEW', 'CREATE_ROLE', 'DROP_ROLE', 'GRANT', 'REVOKE') AND start_time > {_NOW} - INTERVAL 30 DAY")
over("user_changes", "users", audit.user_changes, "SELECT name, created_on, deleted_on, disabled, default_role FROM users")
over("storage_cost", "tables", audit.storage_cost, "SELECT table_catalog, table_schema, table_name, bytes / 1073741824.0::DOUBLE AS active_gb, history_bytes / 1073741824.0::DOUBLE AS history_gb FROM tables WHERE deleted IS NULL")


# --- accesses: each query reads one or two objects, some columns of each ---


def _accesses(spark, sf):
    one = lambda k: F.struct(F.concat(F.lit("T"), ((F.col("query_id") + k) % 40).cast("string")).alias("name"), F.when(F.col("query_id") % 3 == 0, "View").otherwise("Table").alias("domain"), F.when((F.col("query_id") + k) % 2 == 0, F.array(F.lit("EMAIL"), F.lit("AMOUNT"))).otherwise(F.array(F.lit("AMOUNT"))).alias("columns"))
    q = log(spark, sf, "query_log")
    return q.select("query_id", "user_name", "role_name", F.col("start_time").alias("ts"), F.when(F.col("query_id") % 4 == 0, F.array(one(0), one(7))).otherwise(F.array(one(0))).alias("objects"))


_FLAT = with_logs("query_log") + ", o AS (SELECT *, start_time AS ts, 'T' || (query_id % 40) AS name, query_id % 2 = 0 AS has_email FROM query_log UNION ALL SELECT *, start_time, 'T' || ((query_id + 7) % 40), (query_id + 7) % 2 = 0 FROM query_log WHERE query_id % 4 = 0), o2 AS (SELECT *, CASE WHEN query_id % 3 = 0 THEN 'View' ELSE 'Table' END AS domain FROM o), c AS (SELECT *, 'AMOUNT' AS column_name FROM o2 UNION ALL SELECT *, 'EMAIL' FROM o2 WHERE has_email) "


def access(name: str, use, sql: str) -> None:
    R.add(name, lambda spark, sf: use(_accesses(spark, sf)), _FLAT + sql)


access("access_recent", lambda a: audit.access_recent(a, _since(7)), f"SELECT query_id, ts, any_value(user_name) AS user_name, any_value(role_name) AS role_name, count(*)::INT AS n_objects FROM o2 WHERE ts > {_NOW} - INTERVAL 7 DAY GROUP BY query_id, ts")
access("access_by_object", lambda a: audit.access_by_object(a, "T8", _since(30)), f"SELECT query_id, user_name, role_name, ts FROM o2 WHERE name = 'T8' AND ts > {_NOW} - INTERVAL 30 DAY")
access("access_by_column", lambda a: audit.access_by_column(a, "T8", ["EMAIL", "SALARY"], _since(30)), f"SELECT query_id, user_name, role_name, ts, column_name FROM c WHERE name = 'T8' AND column_name IN ('EMAIL', 'SALARY') AND ts > {_NOW} - INTERVAL 30 DAY")
access("access_shared", lambda a: audit.access_shared(a, "Table", _since(7)), f"SELECT query_id, user_name, role_name, ts, name AS object_accessed FROM o2 WHERE domain = 'Table' AND ts > {_NOW} - INTERVAL 7 DAY")


def _access_pii(spark, sf):
    pii = log(spark, sf, "tags").where("tag_name = 'PII_TYPE' and deleted is null").select(F.col("object_name").alias("name"), "column_name")
    return audit.access_pii_count(_accesses(spark, sf), pii, _since(30))


R.add("access_pii_count", _access_pii, _FLAT.replace("WITH ", with_logs("tags").rstrip() + ", ", 1) + f"SELECT user_name, role_name, count(*) AS access_count, min(ts) AS first_access, max(ts) AS last_access FROM c JOIN (SELECT DISTINCT object_name, column_name FROM tags WHERE tag_name = 'PII_TYPE' AND deleted IS NULL) p ON p.object_name = c.name AND p.column_name = c.column_name WHERE ts > {_NOW} - INTERVAL 30 DAY GROUP BY 1, 2")


# --- masks: a value for each customer, seen by a role of every tier in turn ---

#: The value that each policy masks, in both engines' SQL, and the roles that look at it.
_DIGITS = "lpad(CAST(c_custkey * 7919 % 1000000000 AS STRING), 9, '0')"
_VALUES = {
    "email": "concat(lower(substr(c_mktsegment, 1, 5)), '.', CAST(c_custkey AS STRING), '@mail.example')",
    "email_strict": "concat(lower(substr(c_mktsegment, 1, 5)), '.', CAST(c_custkey AS STRING), '@mail.example')",
    "phone": f"concat('555-', substr({_DIGITS}, 1, 3), '-', substr({_DIGITS}, 4, 4))",
    "phone_international": f"concat('+44 ', {_DIGITS})",
    "ssn": f"concat(substr({_DIGITS}, 1, 3), '-', substr({_DIGITS}, 4, 2), '-', substr({_DIGITS}, 6, 4))",
    "tax_id": f"concat(substr({_DIGITS}, 1, 2), '-', substr({_DIGITS}, 3, 7))",
    "address": "concat(CAST(c_custkey AS STRING), ' Main Street, Town ', CAST(c_nationkey AS STRING))",
    "credit_card": f"concat('4000-000', {_DIGITS})",
    "cvv": "CAST(c_custkey % 1000 AS STRING)",
    "salary": "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE)",
    "bank_account": _DIGITS,
    "financial_amount": "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE)",
    "date_of_birth": "CAST('1970-03-05' AS DATE) + CAST(c_custkey % 9000 AS INT)",
    "name": "concat(c_mktsegment, ' van ', c_name)",
    "ip_address": "concat('10.', CAST(c_nationkey AS STRING), '.', CAST(c_custkey % 250 AS STRING), '.7')",
    "mrn": f"concat('M', {_DIGITS})",
    "diagnosis": "concat('E', CAST(10 + c_nationkey AS STRING), '.', CAST(c_custkey % 10 AS STRING))",
    "pii_generic": "c_name",
    "partial": "substr(c_name, 1, CAST(c_custkey % 12 AS INT))",
    "email_null_safe": "CASE WHEN c_custkey % 9 > 0 THEN concat(lower(c_mktsegment), '@mail.example') END",
}
_ROLES = ("SYSADMIN", "COMPLIANCE_OFFICER", "GOVERNANCE_ADMIN", "CUSTOMER_SUPPORT", "DATA_ANALYST", "FINANCE_ANALYST", "FINANCE_ADMIN", "HR_MANAGER", "HR_ANALYST", "HEALTHCARE_ANALYST", "DATA_STEWARD", "IT_SUPPORT", "MARKETING_TEAM", "GUEST")
_ROLE = "CASE CAST(c_custkey % 14 AS INT) " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(_ROLES)) + " END"
_KEEP = "role IN ('SYSADMIN', 'GOVERNANCE_ADMIN', 'COMPLIANCE_OFFICER') THEN v"
_FORMS = {
    "email": f"WHEN {_KEEP} WHEN role IN ('CUSTOMER_SUPPORT', 'MARKETING_TEAM', 'SALES_TEAM') THEN regexp_replace(v, '^(.{{2}})(.*)(@.*)$', '\\1***\\3') WHEN role IN ('DATA_ANALYST', 'BUSINESS_ANALYST') THEN regexp_replace(v, '^(.*)(@.*)$', '***\\2') ELSE '***@***.***'",
    "email_strict": f"WHEN {_KEEP} WHEN role IN ('DATA_STEWARD', 'DATA_OWNER') THEN regexp_replace(v, '^(.{{2}})(.*)(@.*)$', '\\1***\\3') ELSE '***@***'",
    "phone": f"WHEN {_KEEP} WHEN role IN ('CUSTOMER_SUPPORT', 'SALES_TEAM') THEN '***-***-' || right(v, 4) WHEN role IN ('DATA_ANALYST', 'MARKETING_TEAM') THEN 'XXX-XXX-' || right(v, 4) ELSE '***-***-****'",
    "phone_international": f"WHEN {_KEEP} WHEN role = 'CUSTOMER_SUPPORT' THEN '+XX XXX XXX ' || right(v, 4) ELSE '+XX XXX XXX XXXX'",
    "ssn": "WHEN role IN ('SYSADMIN', 'COMPLIANCE_OFFICER', 'HR_ADMIN', 'PAYROLL_ADMIN') THEN v WHEN role IN ('HR_ANALYST', 'HR_MANAGER') THEN '***-**-' || right(v, 4) ELSE '***-**-****'",
    "tax_id": "WHEN role IN ('SYSADMIN', 'COMPLIANCE_OFFICER', 'FINANCE_ADMIN', 'TAX_ADMIN') THEN v WHEN role IN ('FINANCE_ANALYST', 'ACCOUNTANT') THEN '**-*****' || right(v, 2) ELSE '**-*******'",
    "address": f"WHEN {_KEEP} WHEN role IN ('CUSTOMER_SUPPORT', 'LOGISTICS_TEAM', 'OPERATIONS_TEAM') THEN regexp_replace(v, '^([0-9]+)\\s+(.*)$', 'XXX \\2') WHEN role IN ('MARKETING_TEAM', 'SALES_TEAM') THEN split_part(v, ',', -1) ELSE '[REDACTED]'",
    "credit_card": "WHEN role IN ('SYSADMIN', 'COMPLIANCE_OFFICER', 'PCI_ADMIN') THEN v WHEN role IN ('FINANCE_ADMIN', 'PAYMENT_PROCESSOR') THEN 'XXXX-XXXX-XXXX-' || right(v, 4) ELSE 'XXXX-XXXX-XXXX-XXXX'",
    "cvv": "WHEN role IN ('SYSADMIN', 'PCI_ADMIN', 'PAYMENT_PROCESSOR') THEN v ELSE '***'",
    "salary": "WHEN role IN ('SYSADMIN', 'HR_ADMIN', 'PAYROLL_ADMIN', 'COMPLIANCE_OFFICER') THEN v WHEN role IN ('HR_MANAGER', 'FINANCE_MANAGER') THEN round(v, -3) + 0.0::DOUBLE WHEN role = 'HR_ANALYST' THEN round(v, -4) + 0.0::DOUBLE",
    "bank_account": "WHEN role IN ('SYSADMIN', 'FINANCE_ADMIN', 'TREASURY_ADMIN', 'COMPLIANCE_OFFICER') THEN v WHEN role IN ('FINANCE_ANALYST', 'ACCOUNTANT') THEN '****' || right(v, 4) ELSE '********'",
    "financial_amount": "WHEN role IN ('SYSADMIN', 'FINANCE_ADMIN', 'CFO', 'COMPLIANCE_OFFICER') THEN v WHEN role IN ('FINANCE_ANALYST', 'CONTROLLER') THEN round(v, -3) + 0.0::DOUBLE WHEN role IN ('BUSINESS_ANALYST', 'DATA_ANALYST') THEN round(v, -4) + 0.0::DOUBLE",
    "date_of_birth": "WHEN role IN ('SYSADMIN', 'HR_ADMIN', 'COMPLIANCE_OFFICER', 'HEALTHCARE_ADMIN') THEN v WHEN role IN ('HR_ANALYST', 'DATA_ANALYST') THEN make_date(year(v), 1, 1)",
    "name": "WHEN role IN ('SYSADMIN', 'HR_ADMIN', 'COMPLIANCE_OFFICER') THEN v WHEN role IN ('CUSTOMER_SUPPORT', 'SALES_TEAM') THEN left(split_part(v, ' ', 1), 1) || '. ' || left(split_part(v, ' ', -1), 1) || '.' WHEN role IN ('DATA_ANALYST', 'MARKETING_TEAM') THEN '*** ***' ELSE '[REDACTED]'",
    "ip_address": "WHEN role IN ('SYSADMIN', 'SECURITY_ADMIN', 'NETWORK_ADMIN', 'COMPLIANCE_OFFICER') THEN v WHEN role IN ('IT_SUPPORT', 'DATA_ENGINEER') THEN split_part(v, '.', 1) || '.' || split_part(v, '.', 2) || '.XXX.XXX' ELSE 'XXX.XXX.XXX.XXX'",
    "mrn": "WHEN role IN ('SYSADMIN', 'HEALTHCARE_ADMIN', 'PROVIDER', 'COMPLIANCE_OFFICER') THEN v WHEN role = 'HEALTHCARE_ANALYST' THEN '****' || right(v, 4) ELSE '********'",
    "diagnosis": "WHEN role IN ('SYSADMIN', 'HEALTHCARE_ADMIN', 'PROVIDER', 'COMPLIANCE_OFFICER') THEN v WHEN role IN ('HEALTHCARE_ANALYST', 'RESEARCHER') THEN left(v, 3) || 'XXX' ELSE '[REDACTED]'",
    "pii_generic": f"WHEN role = 'DATA_OWNER' OR {_KEEP} WHEN role = 'DATA_STEWARD' THEN left(v, 4) || repeat('*', greatest(length(v) - 4, 0)) ELSE repeat('*', length(v))",
    "partial": f"WHEN {_KEEP} WHEN role IN ('DATA_ANALYST', 'BUSINESS_ANALYST') THEN left(v, 2) || repeat('*', greatest(length(v) - 4, 0)) || right(v, 2) ELSE repeat('*', length(v))",
    "email_null_safe": f"WHEN v IS NULL THEN NULL WHEN {_KEEP} WHEN role IN ('CUSTOMER_SUPPORT', 'MARKETING_TEAM') THEN regexp_replace(v, '^(.{{2}})(.*)(@.*)$', '\\1***\\3') ELSE '***@***.***'",
}


def _seen(spark, sf, policy):
    rows = spark.sql(f"SELECT c_custkey, {_ROLE} AS role, {_VALUES[policy]} AS v FROM {{customer}}", customer=scan(spark, sf, "customer"))
    return rows.select("c_custkey", "role", governance.masked(F.col("v"), policy, F.col("role")).alias("seen"))


for _policy in _VALUES:
    R.add(f"mask_{_policy}", lambda spark, sf, p=_policy: _seen(spark, sf, p), f"SELECT c_custkey, role, CASE {_FORMS[_policy]} END AS seen FROM (SELECT c_custkey, {_ROLE} AS role, {_VALUES[_policy]} AS v FROM customer)")


def _by_flag(spark, sf):
    rows = spark.sql(f"SELECT c_custkey, {_ROLE} AS role, c_name AS v, CASE CAST(c_nationkey % 5 AS INT) WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'INTERNAL' WHEN 2 THEN 'CONFIDENTIAL' WHEN 3 THEN 'RESTRICTED' END AS flag FROM {{customer}}", customer=scan(spark, sf, "customer"))
    return rows.select("c_custkey", "role", "flag", governance.masked_by_flag(F.col("v"), F.col("flag"), F.col("role")).alias("seen"))


R.add("mask_conditional_sensitivity", _by_flag, f"SELECT c_custkey, role, flag, CASE WHEN flag = 'PUBLIC' THEN v WHEN flag = 'INTERNAL' AND role IN ('SYSADMIN', 'DATA_ANALYST', 'EMPLOYEE') THEN v WHEN flag = 'CONFIDENTIAL' AND role IN ('SYSADMIN', 'GOVERNANCE_ADMIN', 'MANAGER') THEN v WHEN flag = 'RESTRICTED' AND role IN ('SYSADMIN', 'COMPLIANCE_OFFICER', 'EXECUTIVE') THEN v ELSE '[MASKED]' END AS seen FROM (SELECT c_custkey, {_ROLE} AS role, c_name AS v, CASE CAST(c_nationkey % 5 AS INT) WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'INTERNAL' WHEN 2 THEN 'CONFIDENTIAL' WHEN 3 THEN 'RESTRICTED' END AS flag FROM customer)")


def _mask_by_tag(spark, sf):
    rows = scan(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").cast("double").alias("c_acctbal"))
    tags = {"c_name": "pii_name", "c_acctbal": "finance", "c_mktsegment": "untouched"}
    return governance.mask_by_tag(rows, "DATA_ANALYST", tags, {"pii_name": "name", "finance": "financial_amount", "pii_email": "email"})


R.add("mask_by_tag", _mask_by_tag, "SELECT c_custkey, '*** ***' AS c_name, c_mktsegment, round(c_acctbal, -4) + 0.0::DOUBLE AS c_acctbal FROM customer")
_NAMES = "CASE CAST(p_partkey % 14 AS INT) WHEN 0 THEN 'home_email' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'social_security_no' WHEN 3 THEN 'tax_id' WHEN 4 THEN 'STREET' WHEN 5 THEN 'cc_number' WHEN 6 THEN 'account_number' WHEN 7 THEN 'account' WHEN 8 THEN 'dob' WHEN 9 THEN 'last_name' WHEN 10 THEN 'file_name' WHEN 11 THEN 'ip' WHEN 12 THEN 'src_ip' ELSE 'amount' END"
R.add("suggest_pii_tag", lambda spark, sf: spark.sql(f"SELECT p_partkey, {_NAMES} AS n FROM {{part}}", part=scan(spark, sf, "part")).select("p_partkey", governance.suggest_pii_tag(F.col("n")).alias("tag")), "SELECT p_partkey, ['pii_email', 'pii_phone', 'pii_ssn', 'pii_tax_id', 'pii_address', 'pii_credit_card', 'pii_bank_account', 'pii_generic', 'pii_date_of_birth', 'pii_name', 'pii_generic', 'pii_ip_address', 'pii_generic', 'pii_generic'][CAST(p_partkey % 14 AS INT) + 1] AS tag FROM part")


def _row_access(spark, sf, role):
    grants = scan(spark, sf, "region").selectExpr("CASE WHEN r_regionkey < 2 THEN 'SALES' ELSE 'OTHER' END AS role", "r_name AS allowed_region").union(spark.sql("SELECT 'CHIEF', 'ALL'"))
    rows = scan(spark, sf, "customer").join(scan(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(scan(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return governance.row_access_filter(rows.select("c_custkey", "r_name"), role, grants, "r_name")


_REGIONS = "SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
R.add("row_access_filter", lambda spark, sf: _row_access(spark, sf, "SALES"), f"{_REGIONS} WHERE r_regionkey < 2")
R.add("row_access_all", lambda spark, sf: _row_access(spark, sf, "CHIEF"), _REGIONS)
R.add("row_access_by_department", lambda spark, sf: governance.row_access_by_department(scan(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "EU_MACHINERY_CLERK", "c_mktsegment"), "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'")
R.add("row_access_by_case", lambda spark, sf: governance.row_access_by_case(scan(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, "BUILDING_LEAD").otherwise("GUEST"), "c_mktsegment", ["SYSADMIN", "EXECUTIVE"], {"BUILDING_LEAD": "BUILDING"}), "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment = 'BUILDING'")


def _tree(spark, sf):
    return scan(spark, sf, "part").where("p_partkey > 0").selectExpr("p_partkey AS child", "p_partkey div 2 AS parent")


_CLOSURE = "WITH RECURSIVE r AS (SELECT p_partkey AS role, p_partkey // 2 AS ancestor, 1 AS steps, p_partkey || ' -> ' || p_partkey // 2 AS path FROM part WHERE p_partkey > 0 UNION ALL SELECT role, ancestor // 2, steps + 1, path || ' -> ' || ancestor // 2 FROM r WHERE ancestor > 0 AND steps < 10)"
R.add("role_hierarchy", lambda spark, sf: governance.role_hierarchy(_tree(spark, sf)).drop("is_cycle"), _CLOSURE.replace("p_partkey || ' -> ' || p_partkey // 2 AS path", "CAST(p_partkey AS VARCHAR) AS path") + " SELECT role, ancestor, steps, path FROM r")
def _knots(spark, sf):
    """Diamonds (each role has two parents), and one edge back."""
    part = scan(spark, sf, "part").where("p_partkey > 3")
    up = part.selectExpr("p_partkey AS child", "explode(array(p_partkey div 2, p_partkey div 3)) AS parent")
    return up.unionByName(part.where("p_partkey = 40").selectExpr("p_partkey div 2 AS child", "p_partkey AS parent"))


_EDGES = "e AS (SELECT DISTINCT child, parent FROM (SELECT p_partkey AS child, unnest([p_partkey // 2, p_partkey // 3]) AS parent FROM part WHERE p_partkey > 3 UNION ALL SELECT p_partkey // 2, p_partkey FROM part WHERE p_partkey = 40))"
R.add("role_cycles", lambda spark, sf: governance.role_hierarchy(_knots(spark, sf), 5), f"WITH RECURSIVE {_EDGES}, r AS (SELECT child AS role, parent AS ancestor, 1 AS steps, [child] AS way, child::VARCHAR AS path, child = parent AS is_cycle FROM e UNION ALL SELECT r.role, e.parent, r.steps + 1, list_append(r.way, e.child), r.path || ' -> ' || e.parent, list_contains(list_append(r.way, e.child), e.parent) FROM r JOIN e ON r.ancestor = e.child WHERE NOT r.is_cycle AND r.steps < 5) SELECT role, ancestor, steps, path, is_cycle FROM r")
R.add("role_closure", lambda spark, sf: governance.role_closure(_knots(spark, sf)), f"WITH RECURSIVE {_EDGES}, r AS (SELECT child AS role, parent AS ancestor, 1 AS steps FROM e UNION SELECT r.role, e.parent, r.steps + 1 FROM r JOIN e ON r.ancestor = e.child WHERE r.steps < 40) SELECT role, ancestor, min(steps)::INT AS steps, role = ancestor AS is_cycle FROM r GROUP BY 1, 2")
R.add("role_path_from", lambda spark, sf: governance.role_path_from(_tree(spark, sf).selectExpr("concat('r_db_', child) AS child", "concat('r_db_', parent) AS parent"), "r_db_150"), "WITH RECURSIVE w AS (SELECT 0 AS level, 150 AS k UNION ALL SELECT level + 1, k // 2 FROM w WHERE k > 0 AND level < 10) SELECT level, 'r_db_' || k AS role_name, CASE WHEN level = 0 THEN 'TARGET' ELSE 'ACCESS' END AS role_type FROM w WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = 150) OR level = 0")
