"""Sales facts, customers seen from all sides, and ranks over whole tables that no single task sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.sources.tables import work_dir

MONEY = "decimal(18,2)"


def _total(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c.cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def gold_daily_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Figures by day, status and priority over orders left join lines, where an order's price counts once for each line.

    Lines are summed by order first, so that nothing fans out: a price is weighed by its count of lines."""
    net = F.round(F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)") * (1 + F.col("l_tax")).cast("decimal(4,2)"), 2)
    per = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("__rows"), F.count("l_linenumber").alias("__lines"), F.sum(F.col("l_quantity").cast(MONEY)).alias("__quantity"), F.sum(net).alias("__net"))
    rows = orders.join(per, "o_orderkey", "left").withColumn("__weight", F.coalesce("__rows", F.lit(1)))
    # an order's customers are nearly always one; only its first row counts for the order, so that no distinct count expands rows
    by = [F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority"]
    keys = ["day", "o_orderstatus", "o_orderpriority"]
    price, weight = F.col("o_totalprice"), F.col("__weight")
    sums = {"__total": F.sum(price.cast(MONEY) * weight), "__priced": F.sum(F.when(price.isNotNull(), weight)), "least": F.min(price), "most": F.max(price), "__q": F.sum("__quantity"), "__n": F.sum("__net"), "__l": F.sum("__lines")}
    once = rows.groupBy("o_orderkey", *by).agg(F.min("o_custkey").alias("__low"), F.max("o_custkey").alias("__high"), F.collect_set("o_custkey").alias("__all"), *[v.alias(k) for k, v in sums.items()])
    one = F.col("__low").eqNullSafe(F.col("__high"))
    per_customer = once.withColumn("custkey", F.explode(F.when(one, F.array("__low")).otherwise(F.col("__all"))))
    first = one | (F.col("custkey") == F.col("__low"))
    add = lambda c: F.sum(F.when(first, F.col(c))).alias(c)
    known = per_customer.groupBy(*keys, "custkey").agg(F.count_if(first & F.col("o_orderkey").isNotNull()).alias("__orders"), F.min("least").alias("least"), F.max("most").alias("most"), *map(add, ("__total", "__priced", "__q", "__n", "__l")))
    total = F.sum("__total").cast("double")
    return known.groupBy(*keys).agg(
        F.sum("__orders").alias("n_orders"),
        F.count("custkey").alias("unique_customers"),
        total.alias("total"),
        (total / F.sum("__priced")).alias("average"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("__q").cast("double").alias("quantity"),
        F.sum("__n").cast("double").alias("net_amount"),
        F.coalesce(F.sum("__l"), F.lit(0)).alias("n_lines"),
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """df with its rows' numbers (from 1) in an order of the whole table, which no task sorts by itself.

    Rows are parted by range of the first key and written with their part's number; the rows of the parts before
    come from a table of one count a part."""
    at = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    path = work_dir(df.sparkSession, "ranked")
    df.repartitionByRange(int(at), *order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    per = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = per.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return rows.withColumn("__at", inside).join(before, "__part").withColumn(name, F.col("__before") + F.col("__at")).select(*df.columns, name)


def ntiles(df: DataFrame, order: Sequence[Column], n: int, name: str) -> DataFrame:
    """df with the tile of each row (1 to n): the first ones have a row more where n doesn't divide the rows."""
    total = df.count()
    size, more = divmod(total, n)
    row = F.col("__row")
    tile = F.when(row <= more * (size + 1), F.ceil(row / (size + 1))).otherwise(more + F.ceil((row - more * (size + 1)) / max(1, size)))
    return row_numbers(df, order, "__row").withColumn(name, tile.cast("int")).drop("__row")


def customer_360(customers: DataFrame, orders: DataFrame, today: Column) -> DataFrame:
    """customers: custkey, birth_date; orders: orderkey, custkey, order_date, amount, category, channel. A row for each customer."""
    amount = _total("amount")
    per = customers.join(orders, "custkey", "left").groupBy("custkey", "birth_date").agg(F.countDistinct("orderkey").alias("total_orders"), amount.alias("lifetime_value"), (amount / F.nullif(F.count("amount"), F.lit(0))).alias("average"), F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    rows = per.withColumn("average_order_value", F.coalesce("average", F.lit(0.0))).drop("average")
    idle, value, n = F.datediff(today, "last_order"), F.col("lifetime_value"), F.col("total_orders")
    engaged = F.when(idle <= 30, 0.4).otherwise(0.0) + F.when(n >= 5, 0.3).otherwise(n * 0.06) + F.when(value >= 1000, 0.3).otherwise(value / 1000 * 0.3)
    rows = rows.withColumns(
        {
            "customer_segment": F.when(value >= 10000, "VIP").when(value >= 5000, "High Value").when(value >= 1000, "Medium Value").otherwise("Low Value"),
            "days_since_last_order": idle,
            "order_frequency_days": F.when(n > 1, F.datediff("last_order", "first_order") / n),
            "engagement_score": F.least(F.lit(1.0), engaged),
            "churn_risk_score": F.when(idle > 180, 0.9).when(idle > 90, 0.6).when(idle > 60, 0.3).otherwise(0.1),
            "age_group": _age_group(F.year(today) - F.year("birth_date")),
            "is_active": idle <= 90,
            "customer_status": F.when(n == 0, "Never Purchased").when(idle > 180, "Inactive").when(idle > 90, "At Risk").otherwise("Active"),
        }
    )
    rows = rows.join(most_frequent(orders, "custkey", "category", "preferred_category"), "custkey", "left").join(most_frequent(orders, "custkey", "channel", "preferred_channel"), "custkey", "left")
    rows = ntiles(rows, [F.col("last_order").asc_nulls_first(), F.col("custkey")], 5, "recency_score")
    rows = ntiles(rows, [F.col("total_orders"), F.col("custkey")], 5, "frequency_score")
    rows = ntiles(rows, [F.col("lifetime_value"), F.col("custkey")], 5, "monetary_score")
    r, f = F.col("recency_score"), F.col("frequency_score")
    segment = F.when((r >= 4) & (f >= 4), "Champions").when((r >= 3) & (f >= 3), "Loyal").when((r >= 4) & (f <= 2), "Promising").when((r <= 2) & (f >= 4), "At Risk").when((r <= 2) & (f <= 2), "Lost").otherwise("Regular")
    return rows.withColumn("rfm_segment", segment)


def _age_group(years: Column) -> Column:
    out = F.when(years < 25, "18-24")
    for low in (25, 35, 45, 55):
        out = out.when(years < low + 10, f"{low}-{low + 9}")
    return out.otherwise("65+")


def most_frequent(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Each key's commonest value that isn't null, the smallest of equals; counted before it is chosen."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    top = counts.groupBy(key).agg(F.max("n").alias("n")).join(counts, [key, "n"])
    return top.groupBy(key).agg(F.min(value).alias(name))


def monthly_kpis(facts: DataFrame) -> DataFrame:
    """facts: sale_date, revenue, profit, n_orders, custkey. Months, which are few, are ordered after they are summed."""
    months = facts.groupBy(F.date_trunc("month", "sale_date").alias("month")).agg(_total("revenue").alias("revenue"), _total("profit").alias("profit"), F.sum("n_orders").alias("n_orders"), F.countDistinct("custkey").alias("active_customers"))
    w = Window.orderBy("month")
    before, year_ago = F.lag("revenue").over(w), F.lag("revenue", 12).over(w)
    growth = lambda base: (F.col("revenue") - base) / base * 100
    return months.withColumns(
        {
            "previous": before,
            "growth_pct": growth(before),
            "year_ago": year_ago,
            "yoy_growth_pct": growth(year_ago),
            "revenue_per_customer": F.col("revenue") / F.nullif("active_customers", F.lit(0)),
            "profit_margin_pct": F.col("profit") / F.nullif("revenue", F.lit(0.0)) * 100,
        }
    )
