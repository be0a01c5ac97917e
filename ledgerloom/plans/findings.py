"""Seasonal, supplier and staffing reports on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..rules import Rules
from .analytics import Star, _salaried_headcount, _sum, monthly_revenue, sales_by_day


_DAY = ["date_id", "sale_month"]


def _calendar(star: Star) -> DataFrame:
    """The calendar with its months. Joined on day and month, a choice of days also
    chooses the month folders of the sales that are read."""
    return star["dim_date"].withColumn("sale_month", month_start(F.col("date_id")))


def tamil_month_profile(star: Star) -> DataFrame:
    """Revenue and mean discount per Tamil month, with the year's best and worst month."""
    calendar = _calendar(star).select(*_DAY, "year", "tamil_month")
    months = (
        sales_by_day(star)
        .join(calendar, _DAY)
        .groupBy("year", "tamil_month")
        .agg(
            _sum("net", "revenue"),
            F.try_divide(F.sum("discounts").cast("double"), F.sum("n_discounts")).alias(
                "avg_discount_pct"
            ),
        )
    )
    year = W.partitionBy("year")
    return months.select(
        "year",
        "tamil_month",
        "revenue",
        F.round("avg_discount_pct", 6).alias("avg_discount_pct"),
        (F.rank().over(year.orderBy("revenue")) == 1).alias("is_lowest"),
        (F.rank().over(year.orderBy(F.desc("revenue"))) == 1).alias("is_highest"),
    )


def festival_months(star: Star) -> DataFrame:
    """Revenue per festival and year, ranked within the year."""
    # Also true of every name; unlike `is not null` it counts as a choice of days.
    festivals = _calendar(star).where(F.col("festival_name") != "")
    return (
        sales_by_day(star)
        .join(festivals.select(*_DAY, "year", "festival_name"), _DAY)
        .groupBy("year", "festival_name")
        .agg(_sum("net", "revenue"))
        .withColumn(
            "revenue_rank", F.rank().over(W.partitionBy("year").orderBy(F.desc("revenue")))
        )
        .withColumn("is_biggest", F.col("revenue_rank") == 1)
    )


def lead_time_range(star: Star) -> DataFrame:
    """Planned lead times and actual delivery days per hub and category.

    Deliveries are counted per product and day count before products are looked up,
    and the median weighs those counts.
    """
    places = ["manufacturing_hub", "category"]
    product = star["dim_product"]
    planned = product.groupBy(*places).agg(
        F.min("lead_time_days").alias("min_lead_days"),
        F.max("lead_time_days").alias("max_lead_days"),
        F.try_divide(F.sum("lead_time_days"), F.count("lead_time_days")).alias("avg_lead_days"),
    )
    days = F.col("days_to_deliver").cast("int")
    delivered = (
        star["fact_purchase_order"]
        .where(days.isNotNull())
        .groupBy("product_id", days.alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(product.select("product_id", *places), "product_id")
        .groupBy(*places)
        .agg(
            F.min("days").alias("min_delivery_days"),
            F.max("days").alias("max_delivery_days"),
            (F.sum(F.col("days") * F.col("n")) / F.sum("n")).alias("avg_delivery_days"),
            F.percentile("days", 0.5, F.col("n")).alias("median_delivery_days"),
        )
    )
    return planned.join(delivered, places, "left").select(
        *places,
        "min_lead_days",
        "max_lead_days",
        F.round("avg_lead_days", 6).alias("avg_lead_days"),
        "min_delivery_days",
        "max_delivery_days",
        F.round("avg_delivery_days", 6).alias("avg_delivery_days"),
        "median_delivery_days",
    )


def surge_ratio(star: Star, rules: Rules) -> DataFrame:
    """Staff and revenue of the surge months against all other months, one row."""
    surge = (
        star["dim_date"]
        .where(F.col("festival_name") == rules.surge_festival)
        .select(month_start(F.col("date_id")).alias("month"))
        .distinct()
        .withColumn("is_surge", F.lit(True))
    )
    months = (
        monthly_revenue(star)
        .join(_salaried_headcount(star), "month")
        .join(surge, "month", "left")
        .withColumn("is_surge", F.coalesce("is_surge", F.lit(False)))
    )

    def mean(column: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(column))).cast("double") / F.nullif(
            F.count_if(when), F.lit(0).cast("bigint")
        )

    is_surge = F.col("is_surge")
    means = months.agg(
        F.count_if(is_surge).alias("surge_months"),
        F.count_if(~is_surge).alias("ordinary_months"),
        mean("total_headcount", is_surge).alias("hs"),
        mean("total_headcount", ~is_surge).alias("ho"),
        mean("revenue", is_surge).alias("rs"),
        mean("revenue", ~is_surge).alias("ro"),
    )
    headcount, revenue = F.try_divide("hs", "ho"), F.try_divide("rs", "ro")
    return means.select(
        "surge_months",
        "ordinary_months",
        F.round(headcount, 6).alias("headcount_ratio"),
        F.round(revenue, 6).alias("revenue_ratio"),
        F.round(F.try_divide(revenue, headcount), 6).alias("revenue_per_head_ratio"),
    )


def period_compare(star: Star, rules: Rules) -> DataFrame:
    """Mean yearly revenue of two periods and their ratio, one row."""
    year = F.year("month")
    period = F.when(year.between(*rules.period_before), "before").when(
        year.between(*rules.period_after), "after"
    )
    yearly = (
        monthly_revenue(star)
        .where(year.between(*rules.period_before) | year.between(*rules.period_after))
        .groupBy(year.alias("year"), period.alias("period"))
        .agg(_sum("revenue", "revenue"))
    )
    periods = (
        yearly.groupBy()
        .pivot("period", ["before", "after"])
        .agg(_sum("revenue", "revenue"), F.count(F.lit(1)).alias("years"))
    )

    def per_year(p: str) -> Column:
        return F.try_divide(F.col(f"{p}_revenue").cast("double"), F.col(f"{p}_years"))

    return periods.select(
        "before_revenue",
        "after_revenue",
        F.round(per_year("before"), 4).alias("before_per_year"),
        F.round(per_year("after"), 4).alias("after_per_year"),
        F.round(F.try_divide(per_year("after"), per_year("before")), 6).alias("ratio"),
    )
