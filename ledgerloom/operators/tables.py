"""Repair of the other tables: products, staff, promotions, orders, settlements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import MONEY, clipped, hit, outside
from ..functions.quantiles import grouped_quantiles
from ..functions.text import mapped, strip, title_case
from ..rules import Rules


def fix_brands(product: DataFrame, rules: Rules) -> DataFrame:
    brand = strip(F.col("brand_name"))
    better = mapped(brand, rules.brand_fixes)
    return product.withColumns(
        {"brand_name": F.coalesce(better, brand), "fixed_brand": better.isNotNull()}
    )


def repair_cost(product: DataFrame, rules: Rules) -> DataFrame:
    wrong = hit(F.col("unit_cost") > F.col("unit_price"))
    value = F.bround(F.col("unit_price") * F.lit(rules.cost_ratio), 2).cast(MONEY)
    return product.withColumns(
        {"unit_cost": F.when(wrong, value).otherwise(F.col("unit_cost")), "fixed_cost": wrong}
    )


def repair_gst(product: DataFrame, rules: Rules) -> DataFrame:
    """A rate outside the legal set, or none at all, becomes the default."""
    wrong = ~hit(F.col("gst_rate").isin(*rules.gst_rates))
    default = F.lit(rules.gst_default).cast(MONEY)
    return product.withColumns(
        {"gst_rate": F.when(wrong, default).otherwise(F.col("gst_rate")), "fixed_gst": wrong}
    )


def clean_product(product: DataFrame, rules: Rules) -> DataFrame:
    return repair_gst(repair_cost(fix_brands(product, rules), rules), rules)


def salary_bounds(employee: DataFrame, rules: Rules) -> DataFrame:
    """Per role the third quartile plus a multiple of the quartile distance, in cents."""
    cents = employee.where(F.col("role").isNotNull()).select(
        "role", (F.col("monthly_salary") * 100).cast("bigint").alias("cents")
    )
    quartiles = grouped_quantiles(cents, ["role"], "cents", {"q1": 0.25, "q3": 0.75})
    return quartiles.select(
        "role", (F.col("q3") + (F.col("q3") - F.col("q1")) * rules.iqr_factor).alias("bound_cents")
    )


def cap_salary(employee: DataFrame, rules: Rules) -> DataFrame:
    """An employee without a role keeps the salary."""
    salary = F.col("monthly_salary")
    wrong = hit((salary * 100).cast("bigint") > F.col("bound_cents"))
    cents = F.rint("bound_cents").try_cast("decimal(18,0)")
    bound = (cents * F.lit("0.01").cast("decimal(2,2)")).try_cast(MONEY)
    return (
        employee.join(salary_bounds(employee, rules), "role", "left")
        .withColumns(
            {"monthly_salary": F.when(wrong, bound).otherwise(salary), "fixed_salary": wrong}
        )
        .select(*employee.columns, "fixed_salary")
    )


def salary_line_report(employee: DataFrame, rules: Rules) -> DataFrame:
    """Salaries above a fixed line before and after the cap, beside the capped rows."""
    capped = cap_salary(employee, rules).withColumnRenamed("monthly_salary", "capped_salary")
    before = employee.agg(
        F.count_if(F.col("monthly_salary") > rules.salary_line).alias("n_above_before")
    )
    after = capped.agg(
        F.count_if(F.col("capped_salary") > rules.salary_line).alias("n_above_after"),
        F.count_if("fixed_salary").alias("n_capped"),
    )
    return after.select(before.scalar().alias("n_above_before"), "n_above_after", "n_capped")


def repair_join_date(employee: DataFrame, rules: Rules) -> DataFrame:
    wrong = hit(F.col("join_date") > F.lit(rules.join_date_limit))
    default = F.lit(rules.join_date_default)
    return employee.withColumns(
        {
            "join_date": F.when(wrong, default).otherwise(F.col("join_date")),
            "fixed_join_date": wrong,
        }
    )


def clean_employee(employee: DataFrame, rules: Rules) -> DataFrame:
    return repair_join_date(cap_salary(employee, rules), rules)


def _in_order(df: DataFrame, first: str, last: str, flag: str) -> DataFrame:
    wrong = hit(F.col(last) < F.col(first))

    def either(when_wrong: str, otherwise: str) -> Column:
        return F.when(wrong, F.col(when_wrong)).otherwise(F.col(otherwise))

    return df.withColumns({first: either(last, first), last: either(first, last), flag: wrong})


def order_promotion_dates(promotion: DataFrame) -> DataFrame:
    return _in_order(promotion, "start_date", "end_date", "fixed_dates")


def clip_promotion_discount(promotion: DataFrame) -> DataFrame:
    discount = F.col("discount_pct")
    low, high = F.lit(0).cast(MONEY), F.lit(100).cast(MONEY)
    return promotion.withColumns(
        {
            "discount_pct": clipped(discount, low, high),
            "fixed_discount": outside(discount, 0, 100),
        }
    )


def clean_promotion(promotion: DataFrame) -> DataFrame:
    return clip_promotion_discount(order_promotion_dates(promotion))


def cap_received(orders: DataFrame) -> DataFrame:
    ordered, received = F.col("quantity_ordered"), F.col("quantity_received")
    wrong = hit(received > ordered)
    return orders.withColumns(
        {"quantity_received": F.when(wrong, ordered).otherwise(received), "fixed_received": wrong}
    )


def order_delivery_dates(orders: DataFrame) -> DataFrame:
    return _in_order(orders, "order_date", "actual_delivery_date", "fixed_dates")


def add_days_to_deliver(orders: DataFrame) -> DataFrame:
    return orders.withColumn(
        "days_to_deliver", F.datediff("actual_delivery_date", "order_date")
    )


def clean_purchase_order(orders: DataFrame) -> DataFrame:
    return add_days_to_deliver(order_delivery_dates(cap_received(orders)))


def clean_settlement(settlement: DataFrame, rules: Rules) -> DataFrame:
    mode = title_case(strip(F.col("payment_mode")))
    return settlement.withColumn(
        "payment_mode", F.coalesce(mapped(mode, rules.settlement_modes), mode)
    )
