"""Audit of roles, privileges, tags, policies and accesses: reports over grant, tag and query logs.

Logs are ordinary tables. A deletion time means that a row is no longer in force; `since` bounds a report to recent rows;
`system` is the prefix of built-in names, which reports leave out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "SYS_"
_OBJECT = ("object_database", "object_schema", "object_name")
_TABLE = ("table_catalog", "table_schema", "table_name")
#: Schemas and databases that aren't users' own, and privileges and roles that matter to auditors.
OWN_SCHEMAS, OWN_DATABASES = ("INFORMATION_SCHEMA", "ACCOUNT_USAGE"), ("SYSTEM", "GOVERNANCE")
DANGEROUS, ADMINS = ("MANAGE GRANTS", "CREATE ROLE", "CREATE USER", "OWNERSHIP"), ("ACCOUNTADMIN", "SECURITYADMIN", "USERADMIN", "SYSADMIN")
DENIED = ("1063", "3001", "3003", "3011")
DDL = ("CREATE_TABLE", "DROP_TABLE", "ALTER_TABLE", "CREATE_VIEW", "DROP_VIEW", "ALTER_VIEW", "CREATE_ROLE", "DROP_ROLE", "GRANT", "REVOKE")


def _days(start: str, now: Column) -> Column:
    return F.datediff(now, start)


def _hours(start: str, now: Column) -> Column:
    return F.timestamp_diff("HOUR", F.date_trunc("hour", start), F.date_trunc("hour", now))


def in_force(df: DataFrame, deleted: str = "deleted_on") -> DataFrame:
    return df.where(F.col(deleted).isNull())


def users_own(df: DataFrame, name: str, system: str = SYSTEM) -> DataFrame:
    return df.where(~F.col(name).startswith(system))


def _listed(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ", ")


def user_roles(grants: DataFrame, now: Column) -> DataFrame:
    return in_force(grants).where("granted_to = 'USER'").select("user_name", "role_name", "created_on", "granted_by", _days("created_on", now).alias("days_assigned"))


def multi_role(grants: DataFrame) -> DataFrame:
    per = in_force(grants).where("granted_to = 'USER'").groupBy("user_name").agg(F.countDistinct("role_name").alias("role_count"), _listed("role_name").alias("roles"))
    return per.where("role_count > 1")


def admins(grants: DataFrame, now: Column, role: str = "ACCOUNTADMIN") -> DataFrame:
    return in_force(grants).where(F.col("role_name") == role).select("user_name", "created_on", "granted_by", _days("created_on", now).alias("days_with_admin"))


def recent_roles(grants: DataFrame, now: Column, since: Column) -> DataFrame:
    rows = in_force(grants).where("granted_to = 'USER'").where(F.col("created_on") >= since)
    return rows.select("user_name", "role_name", "created_on", "granted_by", _hours("created_on", now).alias("hours_ago"))


def orphan_roles(roles: DataFrame, role_grants: DataFrame, user_grants: DataFrame) -> DataFrame:
    """Roles that no role and no user has."""
    held = in_force(role_grants).select("name").union(in_force(user_grants).select(F.col("role_name").alias("name"))).distinct()
    return users_own(in_force(roles), "name").join(held, "name", "left_anti").select("name", "created_on", "owner", "comment")


def privileges(role_grants: DataFrame) -> DataFrame:
    return users_own(in_force(role_grants), "grantee_name").select("grantee_name", "privilege", "granted_on", "name", "grant_option", "granted_by", "created_on")


def owners(role_grants: DataFrame) -> DataFrame:
    return in_force(role_grants).where("privilege = 'OWNERSHIP'").select("grantee_name", "granted_on", "name", "created_on")


def dangerous(role_grants: DataFrame) -> DataFrame:
    rows = in_force(role_grants).where(F.col("privilege").isin(*DANGEROUS) & ~F.col("grantee_name").isin(*ADMINS))
    return rows.select("grantee_name", "privilege", "granted_on", "name", "granted_by", "created_on")


def future_grants(role_grants: DataFrame) -> DataFrame:
    rows = in_force(role_grants).where(F.col("granted_on").contains("FUTURE"))
    return rows.groupBy("grantee_name", "granted_on").agg(F.count("*").alias("future_grants"), _listed("privilege").alias("privileges"))


def privilege_changes(role_grants: DataFrame, since: Column) -> DataFrame:
    rows = users_own(role_grants, "grantee_name").where((F.col("created_on") >= since) | (F.col("deleted_on") >= since))
    return rows.select("grantee_name", "privilege", "granted_on", "name", F.coalesce("deleted_on", "created_on").alias("change_date"), "granted_by", F.when(F.col("deleted_on").isNull(), "GRANTED").otherwise("REVOKED").alias("action"))


def grant_audit(role_grants: DataFrame, since: Column) -> DataFrame:
    return role_grants.where(F.col("created_on") > since).select("created_on", "privilege", "granted_on", "name", "grantee_name", "grant_option", "granted_by")


def _governed(tags: DataFrame) -> DataFrame:
    return in_force(tags, "deleted").where("tag_database = 'GOVERNANCE'")


def tag_coverage(tags: DataFrame) -> DataFrame:
    of = lambda kind: F.countDistinct(F.when(F.col("object_type") == kind, F.col("object_name")))
    return _governed(tags).groupBy("object_database").agg(F.countDistinct("object_name").alias("tagged_objects"), of("TABLE").alias("tagged_tables"), of("COLUMN").alias("tagged_columns"), F.countDistinct("tag_name").alias("unique_tags"))


def top_tags(tags: DataFrame) -> DataFrame:
    return _governed(tags).groupBy("tag_name").agg(F.countDistinct("object_name").alias("usage_count"), F.countDistinct("object_database").alias("databases_used"), _listed("tag_value").alias("common_values"))


def _tagged(tags: DataFrame) -> DataFrame:
    return _governed(tags).select(*[F.col(a).alias(b) for a, b in zip(_OBJECT, _TABLE, strict=True)]).distinct()


def untagged(tables: DataFrame, tags: DataFrame, now: Column) -> DataFrame:
    """Users' tables without a tag, the largest first by row_count where a top is taken."""
    own = in_force(tables, "deleted").where(~F.col("table_schema").isin(*OWN_SCHEMAS) & ~F.col("table_catalog").isin(*OWN_DATABASES))
    return own.join(_tagged(tags), list(_TABLE), "left_anti").select(*_TABLE, "row_count", "bytes", "created", _days("created", now).alias("days_old"))


def pii_inventory(tags: DataFrame, columns: DataFrame) -> DataFrame:
    at = in_force(columns, "deleted").select(*[F.col(b).alias(a) for a, b in zip(_OBJECT, _TABLE, strict=True)], "column_name", "data_type")
    rows = in_force(tags, "deleted").where(F.col("tag_name").startswith("PII_"))
    return rows.join(at, [*_OBJECT, "column_name"]).select(*_OBJECT, "column_name", F.col("tag_value").alias("pii_type"), "tag_created", "data_type")


def sensitivity(tags: DataFrame) -> DataFrame:
    """Objects by sensitivity, the most sensitive first (rank 1)."""
    # fixed values: levels in order
    rank = F.array_position(F.lit(["RESTRICTED", "CONFIDENTIAL", "INTERNAL", "PUBLIC"]), F.col("tag_value"))
    rows = in_force(tags, "deleted").where("tag_name = 'DATA_SENSITIVITY'")
    return rows.select(*_OBJECT, F.col("tag_value").alias("sensitivity_level"), "tag_created", rank.cast("int").alias("rank")).orderBy("rank", *_OBJECT)


def policy_use(refs: DataFrame, policies: DataFrame) -> DataFrame:
    live = in_force(refs, "deleted").where("policy_kind = 'MASKING_POLICY'").join(in_force(policies, "deleted").withColumnRenamed("name", "policy_name").select("policy_name", "created"), "policy_name")
    return live.groupBy("policy_name", "policy_kind", "policy_owner", "created").agg(F.countDistinct("ref_database", "ref_schema", "ref_table").alias("protected_objects"))


def unmasked_pii(columns: DataFrame, refs: DataFrame) -> DataFrame:
    """Columns whose names look like personal data and that no masking policy covers."""
    name = F.col("column_name")
    # fixed values: patterns and what they tell
    kinds = {"%email%": "Email", "%phone%": "Phone", "%ssn%": "SSN", "%credit%card%": "Credit Card", "%address%": "Address"}
    told = F.when(F.lit(False), "")
    for pattern, kind in kinds.items():
        told = told.when(name.ilike(pattern), f"Likely PII - {kind}")
    told = told.when(name.ilike("%name%") & ~name.ilike("%file%"), "Likely PII - Name")
    own = in_force(columns, "deleted").where(~F.col("table_schema").isin(*OWN_SCHEMAS) & ~F.col("table_catalog").isin(*OWN_DATABASES)).withColumn("pii_likelihood", told).where("pii_likelihood is not null")
    covered = in_force(refs, "deleted").where("policy_kind = 'MASKING_POLICY'")
    covered = covered.select(F.col("ref_database").alias("table_catalog"), F.col("ref_schema").alias("table_schema"), F.col("ref_table").alias("table_name"), F.col("ref_column").alias("column_name")).distinct()
    return own.join(covered, [*_TABLE, "column_name"], "left_anti").select(*_TABLE, "column_name", "data_type", "pii_likelihood")


def active_users(queries: DataFrame, since: Column) -> DataFrame:
    rows = users_own(queries, "user_name").where(F.col("start_time") >= since)
    failed = F.countDistinct(F.when(F.col("error_code").isNotNull(), F.col("query_id")))
    return rows.groupBy("user_name").agg(F.count("*").alias("query_count"), F.countDistinct("database_name").alias("databases_accessed"), failed.alias("failed_queries"), F.min("start_time").alias("first_query"), F.max("start_time").alias("last_query"))


def failed_access(queries: DataFrame, since: Column) -> DataFrame:
    return queries.where((F.col("start_time") >= since) & F.col("error_code").isin(*DENIED)).select("query_id", "user_name", "role_name", "database_name", "query_text", "error_code", "start_time")


def sensitive_access(queries: DataFrame, since: Column, databases: Sequence[str]) -> DataFrame:
    rows = users_own(queries, "user_name").where((F.col("start_time") >= since) & F.col("database_name").isin(*databases))
    return rows.groupBy("user_name", "role_name", "database_name").agg(F.count("*").alias("query_count"), F.min("start_time").alias("first_access"), F.max("start_time").alias("last_access"))


def gdpr(tags: DataFrame) -> DataFrame:
    """Personal data that resides in the EU, or of unknown residence."""
    live = in_force(tags, "deleted")
    home = live.where("tag_name = 'DATA_RESIDENCY'").select(*_OBJECT, F.col("tag_value").alias("data_residency"))
    rows = live.where(F.col("tag_name").startswith("PII_")).select(*_OBJECT, "column_name", F.col("tag_value").alias("pii_type"))
    return rows.join(home, list(_OBJECT), "left").where("data_residency = 'EU' or data_residency is null")


def sox(tags: DataFrame, tables: DataFrame, columns: DataFrame) -> DataFrame:
    at = [F.col(b).alias(a) for a, b in zip(_OBJECT, _TABLE, strict=True)]
    rows = in_force(tags, "deleted").where("tag_name = 'COMPLIANCE_SCOPE' and tag_value = 'SOX'").select(*_OBJECT, F.col("tag_value").alias("compliance_scope"))
    wide = columns.groupBy(*_TABLE).agg(F.countDistinct("column_name").alias("n")).select(*at, "n")
    joined = rows.join(in_force(tables, "deleted").select(*at, "row_count"), list(_OBJECT)).join(wide, list(_OBJECT), "left")
    return joined.groupBy(*_OBJECT, "compliance_scope", "row_count").agg(F.coalesce(F.max("n"), F.lit(0)).alias("column_count"))


def retention(tags: DataFrame, now: Column) -> DataFrame:
    """Objects with a retention period, the shortest first (rank 1)."""
    # fixed values: periods in order
    rank = F.array_position(F.lit(["30_DAYS", "90_DAYS", "1_YEAR", "3_YEARS", "7_YEARS", "10_YEARS", "PERMANENT"]), F.col("tag_value"))
    rows = in_force(tags, "deleted").where("tag_name = 'RETENTION_PERIOD'")
    return rows.select(*_OBJECT, F.col("tag_value").alias("retention_period"), "tag_created", _days("tag_created", now).alias("days_since_tagged"), rank.cast("int").alias("rank")).orderBy("rank")


def new_roles(roles: DataFrame, now: Column, since: Column) -> DataFrame:
    return users_own(roles, "name").where(F.col("created_on") >= since).select("name", "created_on", "owner", "comment", _hours("created_on", now).alias("hours_since_creation"))


def admin_use(queries: DataFrame, since: Column, role: str = "ACCOUNTADMIN") -> DataFrame:
    rows = queries.where((F.col("role_name") == role) & (F.col("start_time") >= since))
    return rows.groupBy("user_name", "role_name").agg(F.count("*").alias("query_count"), F.min("start_time").alias("first_usage"), F.max("start_time").alias("last_usage"), F.countDistinct(F.to_date("start_time")).alias("days_active"))


def escalation(queries: DataFrame, since: Column) -> DataFrame:
    """Statements by other roles that hand out power."""
    # fixed values: what such statements look like
    signs = ("%GRANT%ACCOUNTADMIN%", "%GRANT%SECURITYADMIN%", "%CREATE ROLE%", "%MANAGE GRANTS%")
    hit = F.lit(False)
    for s in signs:
        hit = hit | F.col("query_text").ilike(s)
    return queries.where((F.col("start_time") >= since) & hit & ~F.col("role_name").isin(*ADMINS[:3])).select("query_id", "user_name", "role_name", "query_text", "error_code", "start_time")


def role_usage(queries: DataFrame, since: Column) -> DataFrame:
    rows = users_own(queries, "role_name").where(F.col("start_time") >= since)
    return rows.groupBy("role_name").agg(F.countDistinct("user_name").alias("unique_users"), F.count("*").alias("total_queries"), (F.sum("elapsed_ms") / 1000).alias("total_seconds"), (F.sum("elapsed_ms") / F.count("elapsed_ms") / 1000).alias("average_seconds"))


def db_access(queries: DataFrame, since: Column) -> DataFrame:
    rows = queries.where((F.col("start_time") >= since) & F.col("database_name").isNotNull() & ~F.col("database_name").isin(OWN_DATABASES[0]))
    return rows.groupBy("database_name").agg(F.countDistinct("user_name").alias("unique_users"), F.count("*").alias("query_count"), (F.sum("bytes_scanned") / float(1 << 30)).alias("gb_scanned"))


def health(users: DataFrame, roles: DataFrame, tags: DataFrame, policies: DataFrame, tables: DataFrame, user_grants: DataFrame) -> DataFrame:
    """Six figures, a row for each."""

    def figure(name: str, df: DataFrame, *columns: str) -> DataFrame:
        return df.agg(F.countDistinct(*columns).alias("value")).select(F.lit(name).alias("metric"), "value")

    bare = in_force(tables, "deleted").where(~F.col("table_schema").isin(*OWN_SCHEMAS)).join(_tagged(tags), list(_TABLE), "left_anti")
    out = figure("Total Users", in_force(users), "name")
    out = out.union(figure("Total Custom Roles", users_own(in_force(roles), "name"), "name"))
    out = out.union(figure("Total Tagged Objects", _governed(tags), *_OBJECT))
    out = out.union(figure("Active Masking Policies", in_force(policies, "deleted"), "name"))
    out = out.union(figure("Tables Without Tags", bare, *_TABLE))
    return out.union(figure("Users with ACCOUNTADMIN", in_force(user_grants).where("role_name = 'ACCOUNTADMIN'"), "user_name"))


def privilege_count(role_grants: DataFrame) -> DataFrame:
    rows = users_own(in_force(role_grants), "grantee_name")
    return rows.groupBy("grantee_name").agg(F.countDistinct("name").alias("inherited_roles"), F.countDistinct(F.when(F.col("granted_on") != "ROLE", F.col("name"))).alias("direct_privileges"))


def role_edges(role_grants: DataFrame) -> DataFrame:
    return users_own(in_force(role_grants).where("granted_on = 'ROLE'"), "grantee_name").select(F.col("name").alias("child"), F.col("grantee_name").alias("parent"), "created_on")


def remaining(grants: DataFrame, now: Column) -> DataFrame:
    """Grants in force with the days that they have left and what that means."""
    left = F.datediff("expires_on", now)
    state = F.when(F.col("expires_on") < now, "EXPIRED").when(left <= 7, "EXPIRING_SOON").when(left <= 30, "EXPIRING_MONTH").otherwise("ACTIVE")
    return grants.where("is_active").withColumns({"days_remaining": left, "status": state})


def role_catalog(roles: DataFrame, prefix: str) -> DataFrame:
    return in_force(roles).where(F.col("name").startswith(prefix)).select("name", "owner", "comment", "created_on")


def tag_catalog(tags: DataFrame) -> DataFrame:
    """Every tag in use, with its values."""
    return _governed(tags).groupBy("tag_name").agg(_listed("tag_value").alias("allowed_values"), F.min("tag_created").alias("first_used"))


def tag_coverage_by_db(tables: DataFrame, tags: DataFrame) -> DataFrame:
    marked = in_force(tables, "deleted").join(_tagged(tags).withColumn("hit", F.lit(True)), list(_TABLE), "left")
    return marked.groupBy("table_catalog").agg(F.count("*").alias("n_tables"), F.count("hit").alias("n_tagged"), F.round(100.0 * F.count("hit") / F.count("*"), 2).alias("coverage_pct"))


def policy_associations(tags: DataFrame, refs: DataFrame) -> DataFrame:
    """Tags and policies that meet on a column."""
    at = in_force(refs, "deleted").select(F.col("ref_database").alias(_OBJECT[0]), F.col("ref_schema").alias(_OBJECT[1]), F.col("ref_table").alias(_OBJECT[2]), F.col("ref_column").alias("column_name"), "policy_name", "policy_kind")
    return _governed(tags).join(at, [*_OBJECT, "column_name"]).select("tag_name", "policy_name", "policy_kind").distinct()


def access_by_object(accesses: DataFrame, name: str, since: Column) -> DataFrame:
    """Accesses of one object; `objects` is an array of (name, domain, columns)."""
    rows = accesses.where(F.col("ts") > since).select("query_id", "user_name", "role_name", "ts", F.explode("objects").alias("o"))
    return rows.where(F.col("o.name") == name).drop("o")


def access_by_column(accesses: DataFrame, name: str, columns: Sequence[str], since: Column) -> DataFrame:
    rows = accesses.where(F.col("ts") > since).select("query_id", "user_name", "role_name", "ts", F.explode("objects").alias("o")).where(F.col("o.name") == name)
    return rows.select("query_id", "user_name", "role_name", "ts", F.explode("o.columns").alias("column_name")).where(F.col("column_name").isin(*columns))


def access_pii_count(accesses: DataFrame, pii: DataFrame, since: Column) -> DataFrame:
    """Accesses of columns that pii (name, column_name) lists, by user and role."""
    rows = accesses.where(F.col("ts") > since).select("user_name", "role_name", "ts", F.explode("objects").alias("o"))
    rows = rows.select("user_name", "role_name", "ts", F.col("o.name").alias("name"), F.explode("o.columns").alias("column_name"))
    return rows.join(pii.distinct(), ["name", "column_name"]).groupBy("user_name", "role_name").agg(F.count("*").alias("access_count"), F.min("ts").alias("first_access"), F.max("ts").alias("last_access"))


def access_recent(accesses: DataFrame, since: Column) -> DataFrame:
    return accesses.where(F.col("ts") > since).select("query_id", "ts", "user_name", "role_name", F.size("objects").alias("n_objects"))


def access_shared(accesses: DataFrame, domain: str, since: Column) -> DataFrame:
    rows = accesses.where(F.col("ts") > since).select("query_id", "user_name", "role_name", "ts", F.explode("objects").alias("o"))
    return rows.where(F.col("o.domain") == domain).select("query_id", "user_name", "role_name", "ts", F.col("o.name").alias("object_accessed"))


def failed_logins(logins: DataFrame, since: Column) -> DataFrame:
    return logins.where((F.col("is_success") == "NO") & (F.col("ts") > since))


def brute_force(logins: DataFrame, since: Column, least: int = 5) -> DataFrame:
    """Addresses with more than `least` failures."""
    per = failed_logins(logins, since).groupBy("client_ip").agg(F.count("*").alias("failed_attempts"), F.countDistinct("user_name").alias("users_attempted"), F.min("ts").alias("first_attempt"), F.max("ts").alias("last_attempt"))
    return per.where(F.col("failed_attempts") > least)


def admin_activity(queries: DataFrame, since: Column, role: str = "ACCOUNTADMIN") -> DataFrame:
    return queries.where((F.col("role_name") == role) & (F.col("start_time") > since)).select("query_id", "user_name", "role_name", "query_type", "query_text", "start_time")


def ddl_changes(queries: DataFrame, since: Column) -> DataFrame:
    return queries.where(F.col("query_type").isin(*DDL) & (F.col("start_time") > since)).select("query_id", "user_name", "role_name", "query_type", "query_text", "start_time", "database_name")


def user_changes(users: DataFrame) -> DataFrame:
    return users.select("name", "created_on", "deleted_on", "disabled", "default_role")


def storage_cost(tables: DataFrame) -> DataFrame:
    gb = float(1 << 30)
    return in_force(tables, "deleted").select(*_TABLE, (F.col("bytes") / gb).alias("active_gb"), (F.col("history_bytes") / gb).alias("history_gb"))
