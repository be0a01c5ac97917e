"""Tables held against each other: customers, settlements, headcount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.numbers import AMOUNT, hit
from ..rules import Rules


def reconcile_first_purchase(customer: DataFrame, sales: DataFrame, rules: Rules) -> DataFrame:
    """A first purchase cannot be later than the first sale; then days since it."""
    first_sales = (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("date_id").alias("first_sale"))
    )
    late = hit(F.col("first_sale") < F.col("first_purchase_date"))
    return (
        customer.join(first_sales, "customer_id", "left")
        .withColumns(
            {
                "first_purchase_date": F.when(late, F.col("first_sale")).otherwise(
                    F.col("first_purchase_date")
                ),
                "fixed_first_purchase": late,
            }
        )
        .withColumn(
            "customer_tenure_days", F.datediff(F.lit(rules.as_of), F.col("first_purchase_date"))
        )
        .select(*customer.columns, "customer_tenure_days", "fixed_first_purchase")
    )


def _per_day_and_mode(df: DataFrame, amount: str, name: str) -> DataFrame:
    keys = ("date_id", "payment_mode")
    return df.dropna(subset=keys).groupBy(*keys).agg(F.sum(amount).cast(AMOUNT).alias(name))


def settlement_drift(settlement: DataFrame, sales: DataFrame, rules: Rules) -> DataFrame:
    """Settled sums per day and mode that differ from the sales of that day and mode."""
    settled = _per_day_and_mode(settlement, "gross_amount_settled", "settled")
    sold = _per_day_and_mode(sales, "net_amount", "sold")
    drift = F.abs(F.col("settled") - F.coalesce("sold", F.lit(0)))
    return settled.join(sold, ["date_id", "payment_mode"], "left").where(
        drift > F.lit(rules.tolerance)
    )


def unsettled_sales(settlement: DataFrame, sales: DataFrame) -> DataFrame:
    """Days and modes with sales but without any settlement."""
    settled = _per_day_and_mode(settlement, "gross_amount_settled", "settled")
    sold = _per_day_and_mode(sales, "net_amount", "sold")
    return sold.join(settled, ["date_id", "payment_mode"], "left_anti")


def active_staff(employee: DataFrame, opex: DataFrame) -> DataFrame:
    """For every month of the expenses the staff that joined up to then.

    Staff is counted per joining month first, so the running sum sees months only.
    """
    joined = (
        employee.where(F.col("join_date").isNotNull())
        .groupBy(month_start(F.col("join_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    months = opex.where(F.col("month").isNotNull()).select(
        month_start(F.col("month")).alias("month"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        joined.unionByName(months.distinct())
        .groupBy("month")
        .agg(F.sum("n").alias("n"))
        .select(
            "month",
            F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("month")).alias("active_staff"),
        )
    )


def headcount_drift(opex: DataFrame, employee: DataFrame) -> DataFrame:
    """Expense rows whose headcount differs from the staff that had joined by then.

    A row without a readable month counts zero staff. Expenses without a headcount
    column have nothing to compare.
    """
    if "headcount" not in opex.columns:
        return opex.withColumn("active_staff", F.lit(0).cast("bigint")).limit(0)
    staff = active_staff(employee, opex).withColumnRenamed("month", "staff_month")
    return (
        opex.join(staff, month_start(opex["month"]) == staff["staff_month"], "left")
        .withColumn("active_staff", F.coalesce("active_staff", F.lit(0)))
        .where(F.col("headcount") != F.col("active_staff"))
        .select(*opex.columns, "active_staff")
    )
