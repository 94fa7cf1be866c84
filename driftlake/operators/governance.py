"""Masking by role, row access, retention, and closures of role grants."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from driftlake.sources.tables import work_dir

Form = Callable[[Column], Column]


def clear(c: Column) -> Column:
    return c


def shown(text: str) -> Form:
    """The same text for every value, null too."""
    return lambda c: F.lit(text)


def last(n: int, before: str) -> Form:
    return lambda c: F.concat(F.lit(before), F.right(c, F.lit(n)))


def nothing(c: Column) -> Column:
    return F.nullif(c, c)


def rounded(digits: int) -> Form:
    """To the nearest 10**digits, halves away from zero."""
    return lambda c: F.round(c.cast("decimal(28,8)"), -digits).cast("double")


def stars(keep_left: int = 0, keep_right: int = 0) -> Form:
    """One star for each character but those kept at the ends."""
    hidden = lambda c: F.repeat(F.lit("*"), F.greatest(F.length(c) - keep_left - keep_right, F.lit(0)))
    return lambda c: F.concat(F.left(c, F.lit(keep_left)), hidden(c), F.right(c, F.lit(keep_right)))


def replaced(pattern: str, by: str) -> Form:
    return lambda c: F.regexp_replace(c, pattern, by)


def initials(c: Column) -> Column:
    first, final = F.substring_index(c, " ", 1), F.substring_index(c, " ", -1)
    return F.concat(F.left(first, F.lit(1)), F.lit(". "), F.left(final, F.lit(1)), F.lit("."))


_TWO_LETTERS = replaced(r"^(.{2})(.*)(@.*)$", "$1***$3")
_KEEPERS = ("SYSADMIN", "GOVERNANCE_ADMIN", "COMPLIANCE_OFFICER")
#: For each policy the roles of each tier and the form in which they see a value, then the form that others see.
MASKS: dict[str, tuple[list[tuple[tuple[str, ...], Form]], Form]] = {
    "email": ([((*_KEEPERS, "SECURITYADMIN"), clear), (("CUSTOMER_SUPPORT", "MARKETING_TEAM", "SALES_TEAM"), _TWO_LETTERS), (("DATA_ANALYST", "BUSINESS_ANALYST"), replaced(r"^(.*)(@.*)$", "***$2"))], shown("***@***.***")),
    "email_strict": ([(_KEEPERS, clear), (("DATA_STEWARD", "DATA_OWNER"), _TWO_LETTERS)], shown("***@***")),
    "phone": ([(_KEEPERS, clear), (("CUSTOMER_SUPPORT", "SALES_TEAM"), replaced(r"(.*)(\d{4})$", "***-***-$2")), (("DATA_ANALYST", "MARKETING_TEAM"), last(4, "XXX-XXX-"))], shown("***-***-****")),
    "phone_international": ([(_KEEPERS, clear), (("CUSTOMER_SUPPORT",), last(4, "+XX XXX XXX "))], shown("+XX XXX XXX XXXX")),
    "ssn": ([(("SYSADMIN", "COMPLIANCE_OFFICER", "HR_ADMIN", "PAYROLL_ADMIN"), clear), (("HR_ANALYST", "HR_MANAGER"), last(4, "***-**-"))], shown("***-**-****")),
    "tax_id": ([(("SYSADMIN", "COMPLIANCE_OFFICER", "FINANCE_ADMIN", "TAX_ADMIN"), clear), (("FINANCE_ANALYST", "ACCOUNTANT"), last(2, "**-*****"))], shown("**-*******")),
    "address": ([(_KEEPERS, clear), (("CUSTOMER_SUPPORT", "LOGISTICS_TEAM", "OPERATIONS_TEAM"), replaced(r"^(\d+)\s+(.*)$", "XXX $2")), (("MARKETING_TEAM", "SALES_TEAM"), lambda c: F.substring_index(c, ",", -1))], shown("[REDACTED]")),
    "credit_card": ([(("SYSADMIN", "COMPLIANCE_OFFICER", "PCI_ADMIN"), clear), (("FINANCE_ADMIN", "PAYMENT_PROCESSOR"), last(4, "XXXX-XXXX-XXXX-"))], shown("XXXX-XXXX-XXXX-XXXX")),
    "cvv": ([(("SYSADMIN", "PCI_ADMIN", "PAYMENT_PROCESSOR"), clear)], shown("***")),
    "salary": ([(("SYSADMIN", "HR_ADMIN", "PAYROLL_ADMIN", "COMPLIANCE_OFFICER"), clear), (("HR_MANAGER", "FINANCE_MANAGER"), rounded(3)), (("HR_ANALYST",), rounded(4))], nothing),
    "bank_account": ([(("SYSADMIN", "FINANCE_ADMIN", "TREASURY_ADMIN", "COMPLIANCE_OFFICER"), clear), (("FINANCE_ANALYST", "ACCOUNTANT"), last(4, "****"))], shown("********")),
    "financial_amount": ([(("SYSADMIN", "FINANCE_ADMIN", "CFO", "COMPLIANCE_OFFICER"), clear), (("FINANCE_ANALYST", "CONTROLLER"), rounded(3)), (("BUSINESS_ANALYST", "DATA_ANALYST"), rounded(4))], nothing),
    "date_of_birth": ([(("SYSADMIN", "HR_ADMIN", "COMPLIANCE_OFFICER", "HEALTHCARE_ADMIN"), clear), (("HR_ANALYST", "DATA_ANALYST"), lambda c: F.trunc(c, "year"))], nothing),
    "name": ([(("SYSADMIN", "HR_ADMIN", "COMPLIANCE_OFFICER"), clear), (("CUSTOMER_SUPPORT", "SALES_TEAM"), initials), (("DATA_ANALYST", "MARKETING_TEAM"), shown("*** ***"))], shown("[REDACTED]")),
    "ip_address": ([(("SYSADMIN", "SECURITY_ADMIN", "NETWORK_ADMIN", "COMPLIANCE_OFFICER"), clear), (("IT_SUPPORT", "DATA_ENGINEER"), replaced(r"(\d+\.\d+\.)(\d+\.\d+)", "$1XXX.XXX"))], shown("XXX.XXX.XXX.XXX")),
    "mrn": ([(("SYSADMIN", "HEALTHCARE_ADMIN", "PROVIDER", "COMPLIANCE_OFFICER"), clear), (("HEALTHCARE_ANALYST",), last(4, "****"))], shown("********")),
    "diagnosis": ([(("SYSADMIN", "HEALTHCARE_ADMIN", "PROVIDER", "COMPLIANCE_OFFICER"), clear), (("HEALTHCARE_ANALYST", "RESEARCHER"), lambda c: F.concat(F.left(c, F.lit(3)), F.lit("XXX")))], shown("[REDACTED]")),
    "pii_generic": ([((*_KEEPERS, "DATA_OWNER"), clear), (("DATA_STEWARD",), stars(4))], stars()),
    "partial": ([(_KEEPERS, clear), (("DATA_ANALYST", "BUSINESS_ANALYST"), stars(2, 2))], stars()),
    "email_null_safe": ([(_KEEPERS, clear), (("CUSTOMER_SUPPORT", "MARKETING_TEAM"), _TWO_LETTERS)], lambda c: F.when(c.isNotNull(), "***@***.***")),
    "hash": ([(_KEEPERS, clear)], lambda c: F.sha2(c.cast("string"), 256)),
}
#: The roles that see a value of each sensitivity; PUBLIC is for all.
BY_FLAG = {"INTERNAL": ("SYSADMIN", "DATA_ANALYST", "EMPLOYEE"), "CONFIDENTIAL": ("SYSADMIN", "GOVERNANCE_ADMIN", "MANAGER"), "RESTRICTED": ("SYSADMIN", "COMPLIANCE_OFFICER", "EXECUTIVE")}


def masked(value: Column, policy: str, role: Column) -> Column:
    """What role sees of value under a policy of MASKS; a role that no tier names, or null, sees the least."""
    tiers, least = MASKS[policy]
    out = None
    for roles, form in tiers:
        hit = role.isin(*roles)
        out = F.when(hit, form(value)) if out is None else out.when(hit, form(value))
    return out.otherwise(least(value))


def masked_by_flag(value: Column, flag: Column, role: Column) -> Column:
    """The value where its sensitivity lets role see it, else a mark."""
    seen = flag == "PUBLIC"
    for name, roles in BY_FLAG.items():
        seen = seen | (flag == name) & role.isin(*roles)
    return F.when(seen, value).otherwise("[MASKED]")


def mask(df: DataFrame, role: str | Column, rules: dict[str, str]) -> DataFrame:
    """The columns of rules (column -> policy) as role, a name or a column, sees them."""
    who = F.lit(role) if isinstance(role, str) else role
    return df.withColumns({c: masked(F.col(c), policy, who) for c, policy in rules.items()})


def mask_by_tag(df: DataFrame, role: str | Column, column_tags: dict[str, str], tag_masks: dict[str, str]) -> DataFrame:
    """Every column that has a tag with a policy, masked by it."""
    return mask(df, role, {c: tag_masks[t] for c, t in column_tags.items() if c in df.columns and t in tag_masks})


def row_access_filter(df: DataFrame, role: str, mapping: DataFrame, column: str) -> DataFrame:
    """Rows of the regions that the mapping (role, allowed_region) allows the role; ALL allows every row, of null region too.

    An equi-join with the role's regions, and one row that tells whether ALL is among them."""
    allowed = mapping.where(F.col("role") == role).select(F.col("allowed_region").alias("__region")).distinct()
    every = allowed.agg(F.coalesce(F.max(F.col("__region") == "ALL"), F.lit(False)).alias("__every"))
    both = df.join(allowed, F.col(column) == F.col("__region"), "left").crossJoin(every)
    return both.where("__every or __region is not null").select(*df.columns)


def row_access_by_department(df: DataFrame, role: str, column: str, full: Sequence[str] = ("ACCOUNTADMIN", "HR_ADMIN")) -> DataFrame:
    """Rows of departments that stand, with a character on each side, in the role's name; roles of full see all."""
    return df if role in full else df.where(F.like(F.lit(role), F.concat(F.lit("%_"), F.col(column), F.lit("_%"))))


def row_access_by_case(df: DataFrame, role: Column, column: str, full: Sequence[str], regions: dict[str, str]) -> DataFrame:
    """Rows of the region that regions has for the role; roles of full see all."""
    seen = role.isin(*full)
    for name, region in regions.items():
        seen = seen | (role == name) & (F.col(column) == region)
    return df.where(seen)


def suggest_pii_tag(name: Column) -> Column:
    """The tag that a column's name asks for, whatever its case."""
    has = lambda *parts: reduce(Column.__or__, [name.ilike(f"%{p}%") for p in parts])
    # fixed values: parts of names by tag, in order
    return (
        F.when(has("email"), "pii_email")
        .when(has("phone", "mobile"), "pii_phone")
        .when(has("ssn", "social_security"), "pii_ssn")
        .when(has("tax_id", "ein"), "pii_tax_id")
        .when(has("address", "street"), "pii_address")
        .when(has("credit_card", "cc_number"), "pii_credit_card")
        .when(has("account") & has("number"), "pii_bank_account")
        .when(has("dob", "birth_date"), "pii_date_of_birth")
        .when(has("name") & ~has("file"), "pii_name")
        .when(has("ip_address") | (name == "ip"), "pii_ip_address")
        .otherwise("pii_generic")
    )


def retention_split(df: DataFrame, date_col: str, days: int, as_of: Column) -> DataFrame:
    """Rows young enough to keep; those without a date aren't old."""
    return df.where(F.col(date_col).isNull() | (F.col(date_col) >= as_of - F.expr(f"INTERVAL {days} DAYS")))


def retention_log(df: DataFrame, table: str, date_col: str, days: int, as_of: Column) -> DataFrame:
    """What a clean-up would do: counts before and after, or SKIPPED where the column is missing."""
    if date_col not in df.columns:
        return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("rows_before"), F.lit(0).cast("long").alias("rows_deleted"), F.count("*").alias("rows_after"), F.lit("SKIPPED").alias("status"))
    old = F.coalesce(F.col(date_col) < as_of - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))
    return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("rows_before"), F.count_if(old).alias("rows_deleted"), F.count_if(~old).alias("rows_after"), F.lit("SUCCESS").alias("status"))


#: Steps of a hierarchy that one job works out.
TOGETHER = 3
#: Edges for each bucket of a closure, about, and buckets at most.
BUCKET_EDGES, MOST_BUCKETS = 1 << 15, 1 << 16


def _written(df: DataFrame, name: str, goes_on: str = "true") -> tuple[DataFrame, int]:
    """df in a table of its own, and how many of its rows go on."""
    path, seen = work_dir(df.sparkSession, name), Observation()
    df.observe(seen, F.count_if(F.expr(goes_on)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n"]


def role_hierarchy(edges: DataFrame, depth: int = 10) -> DataFrame:
    """Ancestors of every role over edges (child, parent), at most depth steps away: role, ancestor, steps, the path there (the role
    and what comes after its parent) and is_cycle.

    Each way is a row. A step extends the ways of the step before alone, and steps are written, TOGETHER of them at once, before the
    next one reads them, so that no plan grows with the depth and no recursion holds all rows. A way that comes to a role that it has passed is marked is_cycle and
    ends there. Edges of null ends are none; repeated edges count once."""
    known, _ = _written(edges.select("child", "parent").dropna().distinct(), "edges")
    told = lambda rows, n: rows.withColumns({"is_cycle": F.array_contains("way", F.col("ancestor")), "steps": F.lit(n)})
    text = F.col("parent").cast("string")
    step = told(known.select(F.col("child").alias("role"), F.col("parent").alias("ancestor"), F.array("child").alias("way"), F.col("child").cast("string").alias("path")), 1)
    out, n, left = step, 1, 1
    while n < depth and left:
        ahead = []
        for n in range(n + 1, min(n + TOGETHER, depth) + 1):
            open_ = step.where("not is_cycle")
            met = open_.join(known, open_["ancestor"] == known["child"])
            step = told(met.select("role", F.col("parent").alias("ancestor"), F.concat("way", F.array("child")).alias("way"), F.concat("path", F.lit(" -> "), text).alias("path")), n)
            ahead.append(step)
        both, left = _written(reduce(DataFrame.unionByName, ahead), f"step_{n}", f"steps = {n} and not is_cycle")
        out, step = out.unionByName(both), both.where(F.col("steps") == n)
    return out.select("role", "ancestor", "steps", "path", "is_cycle")


def role_closure(edges: DataFrame, depth: int | None = None) -> DataFrame:
    """Every ancestor of every role once, with the fewest steps to it, and is_cycle where a role comes back to itself.

    Pairs that were found before are not followed again: ways that meet don't multiply, cycles end, and depth may be without bound.
    A step hands what it found for a role on to the role's children. All steps are one table in buckets of its pairs, so that
    pairs are shuffled in the step that finds them, and not again in each that must not find them once more."""
    spark = edges.sparkSession
    known, left = _written(edges.select("child", "parent").dropna().distinct(), "edges")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(min(parts, 1 + left // (BUCKET_EDGES // 8)), 1 + left // BUCKET_EDGES), MOST_BUCKETS)
    pairs, path = f"pairs_{uuid.uuid4().hex}", work_dir(spark, "pairs")

    def add(rows: DataFrame, n: int) -> bool:
        dealt = rows.repartition(buckets, "role", "ancestor") if n == 1 else rows
        dealt.withColumn("steps", F.lit(n)).write.mode("append").format("parquet").option("path", path).bucketBy(buckets, "role", "ancestor").saveAsTable(pairs)
        return not spark.table(pairs).where(F.col("steps") == n).isEmpty()

    try:
        n = 1
        left = add(known.selectExpr("child AS role", "parent AS ancestor"), n)
        while n != depth and left:
            found = spark.table(pairs)
            step = found.where(F.col("steps") == n).select(F.col("role").alias("parent"), "ancestor")
            n += 1
            ahead = step.join(known, "parent").select(F.col("child").alias("role"), "ancestor").repartition(buckets, "role", "ancestor").distinct()
            left = add(ahead.join(found.select("role", "ancestor"), ["role", "ancestor"], "left_anti"), n)
        found = spark.read.schema(spark.table(pairs).schema).parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {pairs}")
    return found.withColumn("is_cycle", F.col("role") == F.col("ancestor"))


def role_path_from(edges: DataFrame, role: str, depth: int = 10) -> DataFrame:
    """The role itself (level 0) and its ancestors, with the type that their names tell."""
    start = edges.sparkSession.createDataFrame([(role,)], "at string")
    found = edges.sparkSession.sql(
        f"""WITH RECURSIVE way(level, role_name) AS (
            SELECT 0, at FROM {{start}}
            UNION ALL
            SELECT w.level + 1, CAST(e.parent AS STRING) FROM way w JOIN {{edges}} e ON w.role_name = CAST(e.child AS STRING) WHERE w.level < {int(depth)})
        SELECT DISTINCT level, role_name FROM way""",
        start=start,
        edges=edges.select("child", "parent").distinct(),
    )
    return found.withColumn("role_type", F.when(F.col("level") == 0, "TARGET").otherwise(role_type(F.col("role_name"))))


def role_type(name: Column) -> Column:
    # fixed values: names and patterns of names, in order
    return (
        F.when(name.isin("SYSADMIN", "SECURITYADMIN", "USERADMIN", "ACCOUNTADMIN"), "SYSTEM")
        .when(name.like("%_admin") | name.like("%_steward"), "ADMIN")
        .when(name.like("%_db_%"), "ACCESS")
        .when(name.like("%_service_role"), "SERVICE")
        .otherwise("FUNCTIONAL")
    )
