"""The business queries on the star schema.

Each takes the star as a dict of DataFrames. Facts are aggregated before they
meet a dimension wherever the result allows it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..rules import SALARY_EXPENSES
from ..session import materialised, shared_folder

Star = dict[str, DataFrame]


def _sum(column: str, name: str):
    return F.sum(column).cast("decimal(20,2)").alias(name)


def sales_by_month(star: Star) -> DataFrame:
    """The sales with `sale_month`: the folder column where there is one, so that a
    condition on it skips whole folders, else computed."""
    sales = star["fact_sales"]
    if "sale_month" in sales.columns:
        return sales
    return sales.withColumn("sale_month", month_start(F.col("date_id")))


def top_customers(star: Star, n: int = 20) -> DataFrame:
    """Customers by revenue.

    The cut comes before the ranking: only n rows reach the ordered window. Rows
    above the cut are the same ones, so the ranks are too; ties at the cut go to
    the smaller customer number.
    """
    revenue = (
        star["fact_sales"]
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(_sum("net_amount", "total_revenue"))
    )
    customer = star["dim_customer"].select("customer_id", "customer_type", "home_area")
    best = (
        revenue.join(customer, "customer_id")
        .orderBy(F.desc_nulls_first("total_revenue"), "customer_id")
        .limit(n)
    )
    rank = F.rank().over(W.partitionBy(F.lit(0)).orderBy(F.desc_nulls_first("total_revenue")))
    return best.select(
        "customer_id", "customer_type", "home_area", "total_revenue", rank.alias("revenue_rank")
    ).orderBy("revenue_rank", "customer_id")


# Sums of the clean sales that a run writes beside them. A star without them is summed anew.
PRODUCT_MONTHS = "sales_by_product_month"
DAYS = "sales_by_day"


def product_months(star: Star) -> DataFrame:
    """Sums per calendar month and product.

    The calendar is small and checks the date in place. Summing before the product
    lookup leaves one row per month and product to shuffle, also for a product that
    makes up much of the table.
    """
    if PRODUCT_MONTHS in star:
        return star[PRODUCT_MONTHS]
    return (
        sales_by_month(star)
        .where(F.col("product_id").isNotNull())
        .join(star["dim_date"].select("date_id"), "date_id")
        .groupBy("sale_month", "product_id")
        .agg(F.sum("net_amount").alias("net"), F.sum("quantity").alias("pieces"))
    )


def sales_by_day(star: Star) -> DataFrame:
    """Sales summed per day: small enough to meet the calendar."""
    if DAYS in star:
        return star[DAYS]
    return (
        sales_by_month(star)
        .where(F.col("date_id").isNotNull())
        .groupBy("date_id", "sale_month")
        .agg(
            F.sum("net_amount").alias("net"),
            F.sum("discount_pct").alias("discounts"),
            F.count("discount_pct").alias("n_discounts"),
        )
    )


def summaries(star: Star) -> Star:
    """What the reports on days and months read instead of the sales."""
    return {PRODUCT_MONTHS: product_months(star), DAYS: sales_by_day(star)}


def _category_months(star: Star) -> DataFrame:
    return (
        product_months(star)
        .join(star["dim_product"].select("product_id", "category"), "product_id")
        .groupBy(
            F.year("sale_month").alias("year"), F.month("sale_month").alias("month"), "category"
        )
        .agg(_sum("net", "revenue"))
    )


def _with_growth(months: DataFrame, prior) -> DataFrame:
    growth = F.lit(100.0).cast("decimal(4,1)") * (F.col("revenue") - F.col("prior_year_revenue"))
    base = F.nullif(F.col("prior_year_revenue"), F.lit(0).cast("decimal(20,2)"))
    return (
        months.withColumn("prior_year_revenue", prior)
        .withColumn("yoy_pct", F.round(growth / base, 1).cast("decimal(18,1)"))
        .select("year", "month", "category", "revenue", "prior_year_revenue", "yoy_pct")
        .orderBy("category", "year", "month")
    )


def category_yoy(star: Star) -> DataFrame:
    """Growth over the same month one calendar year before; a gap year gives none."""
    w = W.partitionBy("category", "month").orderBy("year").rangeBetween(-1, -1)
    return _with_growth(_category_months(star), F.first("revenue").over(w))


def category_yoy_lag12(star: Star) -> DataFrame:
    """The variant that looks twelve rows back within a category and calendar month."""
    w = W.partitionBy("category", "month").orderBy("year")
    return _with_growth(_category_months(star), F.lag("revenue", 12).over(w))


def po_delay_by_hub(star: Star) -> DataFrame:
    late = F.col("actual_delivery_date") > F.col("expected_delivery_date")
    per_product = (
        star["fact_purchase_order"]
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"))
    )
    hubs = star["dim_product"].select("product_id", "manufacturing_hub")
    return (
        per_product.join(hubs, "product_id")
        .groupBy("manufacturing_hub")
        .agg(F.sum("n").alias("total_pos"), F.sum("late").alias("delayed_pos"))
        .withColumn(
            "delay_rate_pct",
            F.round(
                F.lit(100).cast("decimal(3,0)")
                * F.col("delayed_pos").cast("decimal(15,0)")
                / F.col("total_pos").cast("decimal(15,0)"),
                1,
            ).cast("decimal(5,1)"),
        )
        .orderBy(F.desc("delay_rate_pct"), "manufacturing_hub")
    )


_MASTER_COLUMNS = (
    "tamil_month", "season_tag", "customer_type", "category", "item_name", "brand_name",
    "quantity", "net_amount", "payment_mode", "stock_on_hand",
)
_MASTER_ORDER = (
    "date_id", "transaction_id", "product_id", "customer_id", "quantity", "net_amount",
    "payment_mode",
)


def _described(sales: DataFrame, star: Star) -> DataFrame:
    return (
        sales.join(star["dim_date"].select("date_id", "tamil_month", "season_tag"), "date_id")
        .join(star["dim_customer"].select("customer_id", "customer_type"), "customer_id")
        .join(
            star["dim_product"].select("product_id", "category", "item_name", "brand_name"),
            "product_id",
        )
    )


def _stock_levels(star: Star) -> DataFrame:
    return star["fact_stock"].select("product_id", "date_id", "stock_event_id", "stock_on_hand")


def master_join_all(star: Star) -> DataFrame:
    """Every sale with its date, customer, product and the stock events of that day."""
    return (
        _described(star["fact_sales"].select(*_MASTER_ORDER), star)
        .join(_stock_levels(star), ["product_id", "date_id"], "left")
        .select(*_MASTER_COLUMNS)
    )


def _only(table: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a table with keys among those of a few rows, which are few enough to broadcast."""
    return table.join(F.broadcast(few.select(*keys).distinct()), keys, "left_semi")


def first_sales(star: Star, n: int) -> DataFrame:
    """The first n sales, in the order of the master join, that have a known day, customer and
    product, with what is known of these.

    Months are folders: only as many of the first ones are read as hold the wanted number of
    rows. The rows are cut to that number before any join, which then has few rows on one side;
    if too few of them have all three, four times as many are taken.
    """
    sales = sales_by_month(star)
    months = sales.where("sale_month is not null").groupBy("sale_month").count()
    # One row a month of the calendar.
    sizes = sorted((r["sale_month"], r["count"]) for r in months.collect())
    total, wanted = sum(size for _, size in sizes), n
    while True:
        held, chosen = 0, []
        for month, size in sizes:
            if held < wanted:
                held, chosen = held + size, [*chosen, month]
        early = sales.where(F.col("sale_month").isin(chosen)).select(*_MASTER_ORDER)
        few = _written(early.orderBy(*_MASTER_ORDER).limit(wanted), "first-sales")
        known = {**star} | {
            name: _only(star[name], few, [key])
            for name, key in (
                ("dim_date", "date_id"), ("dim_customer", "customer_id"), ("dim_product", "product_id"),
            )
        }
        found = _written(_described(few, known), "described-sales")
        if wanted >= total or found.count() >= n:
            return found.orderBy(*_MASTER_ORDER).limit(n)
        wanted *= 4


def _written(few_rows: DataFrame, name: str) -> DataFrame:
    spark = few_rows.sparkSession
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/ledgerloom/{app}/{name}-{uuid.uuid4().hex}"
    return materialised(few_rows, folder)


def master_join(star: Star, n: int = 1000) -> DataFrame:
    """The first n rows of the master join by date.

    Every sale gives at least one row, so the first n rows come from the first n sales. The stock
    table is only searched for their products and days, and gives at most n events of each, cut
    before they are shuffled. The broadcast sides have at most n rows.
    """
    sales = first_sales(star, n)
    keys = ["product_id", "date_id"]
    of_day = W.partitionBy(*keys).orderBy("stock_event_id")
    stock = (
        _only(_stock_levels(star), sales, keys)
        .withColumn("place", F.row_number().over(of_day))
        .where(F.col("place") <= n)
        .drop("place")
    )
    return (
        sales.join(stock, keys, "left")
        .orderBy(*_MASTER_ORDER, "stock_event_id")
        .limit(n)
        .select(*_MASTER_COLUMNS)
    )


def _salaried_headcount(star: Star) -> DataFrame:
    return (
        star["fact_opex"]
        .where(F.col("expense_type").isin(*SALARY_EXPENSES) & F.col("month").isNotNull())
        .groupBy("month")
        .agg(_sum("headcount", "total_headcount"))
    )


def monthly_revenue(star: Star) -> DataFrame:
    months = sales_by_day(star).groupBy(F.col("sale_month").alias("month"))
    return months.agg(_sum("net", "revenue"))


def revenue_per_employee(star: Star) -> DataFrame:
    staff = F.nullif(F.col("total_headcount"), F.lit(0).cast("decimal(20,2)"))
    return (
        monthly_revenue(star)
        .join(_salaried_headcount(star), "month")
        .withColumn(
            "revenue_per_employee", F.round(F.col("revenue") / staff, 0).cast("decimal(20,0)")
        )
        .orderBy("month")
    )


def operating_margin(star: Star) -> DataFrame:
    """Revenue, cost of goods and operating expenses per month."""
    months = (
        product_months(star)
        .join(star["dim_product"].select("product_id", "unit_cost"), "product_id")
        .groupBy(F.col("sale_month").alias("month"))
        .agg(
            _sum("net", "revenue"),
            F.sum(F.col("pieces") * F.col("unit_cost")).cast("decimal(20,2)").alias("cogs"),
        )
    )
    opex = (
        star["fact_opex"]
        .where(F.col("month").isNotNull())
        .groupBy("month")
        .agg(_sum("amount", "total_opex"))
    )
    left = (F.col("revenue") - F.col("cogs") - F.col("total_opex")).cast("decimal(20,2)")
    base = F.nullif(F.col("revenue"), F.lit(0).cast("decimal(20,2)"))
    return (
        months.join(opex, "month")
        .withColumn("gross_margin", (F.col("revenue") - F.col("cogs")).cast("decimal(20,2)"))
        .withColumn("operating_margin", left)
        .withColumn(
            "operating_margin_pct",
            F.round(F.lit(100).cast("decimal(3,0)") * left / base, 1).cast("decimal(18,1)"),
        )
        .select(
            "month", "revenue", "cogs", "gross_margin", "total_opex", "operating_margin",
            "operating_margin_pct",
        )
        .orderBy("month")
    )
