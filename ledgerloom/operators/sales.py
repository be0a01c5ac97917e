"""Repair and enrichment of sales rows.

Every repair adds a boolean `fixed_...` column, so that corrections are counted
from the result and not by extra passes. All joins here bring in one table, the
product card, with one row per product. Prices, costs and amounts are decimals, so
their products with whole quantities are exact; only percentages are rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import AMOUNT, cents, clipped, hit, percent_off
from ..functions.quantiles import grouped_quantiles, overall_quantile
from ..functions.text import mapped, strip
from ..rules import UNKNOWN_MODE, Rules

FIX_FLAGS = ("fixed_mode", "fixed_price", "fixed_quantity", "fixed_gross", "fixed_net")


def fill_unknown(sales: DataFrame) -> DataFrame:
    return sales.withColumn("payment_mode", F.coalesce("payment_mode", F.lit(UNKNOWN_MODE)))


def fill_sentinel(sales: DataFrame, rules: Rules) -> DataFrame:
    return sales.withColumn(
        "employee_id", F.coalesce("employee_id", F.lit(rules.sentinel_employee).cast("bigint"))
    )


def canonical_mode(sales: DataFrame, rules: Rules) -> DataFrame:
    """Bring spellings of the known modes to one form; leave all other texts alone."""
    mode = F.col("payment_mode")
    settled = [*rules.payment_modes.values(), UNKNOWN_MODE]
    better = F.when(~mode.isin(*settled), mapped(F.upper(strip(mode)), rules.payment_modes))
    return sales.withColumns(
        {"payment_mode": F.coalesce(better, mode), "fixed_mode": better.isNotNull()}
    )


def quantity_caps(sales: DataFrame, rules: Rules) -> DataFrame:
    """Per product the quantity quantile and the whole number it is capped to."""
    return grouped_quantiles(
        sales, ["product_id"], "quantity", {"quantity_limit": rules.quantity_quantile}
    ).withColumn("quantity_cap", F.col("quantity_limit").cast("bigint"))


def product_card(sales: DataFrame, product: DataFrame, rules: Rules) -> DataFrame:
    """One row per product key: master price and cost, quantity cap, whether known."""
    master = (
        product.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.min(F.struct("unit_price", "unit_cost")).alias("m"))
        .select(
            "product_id",
            F.col("m.unit_price").alias("master_price"),
            F.col("m.unit_cost").alias("master_cost"),
            F.lit(True).alias("in_master"),
        )
    )
    return quantity_caps(sales, rules).join(master, "product_id", "full")


def with_card(sales: DataFrame, card: DataFrame) -> DataFrame:
    """Bring the product card to each sale; a missing key has its own quantity cap."""
    c = card.withColumnRenamed("product_id", "card_product")
    return (
        sales.join(c, sales["product_id"].eqNullSafe(c["card_product"]), "left")
        .drop("card_product")
        .withColumn("in_master", F.coalesce("in_master", F.lit(False)))
    )


def repair_price(sales: DataFrame, rules: Rules) -> DataFrame:
    master = F.col("master_price")
    wrong = hit(F.col("unit_price") < F.lit(rules.glitch_ratio) * master)
    return sales.withColumns(
        {"unit_price": F.when(wrong, master).otherwise(F.col("unit_price")), "fixed_price": wrong}
    )


def cap_quantity(sales: DataFrame) -> DataFrame:
    wrong = hit(F.col("quantity") > F.col("quantity_limit"))
    return sales.withColumns(
        {
            "quantity": F.when(wrong, F.col("quantity_cap")).otherwise(F.col("quantity")),
            "fixed_quantity": wrong,
        }
    )


def clip_discount(sales: DataFrame) -> DataFrame:
    kind = sales.schema["discount_pct"].dataType
    low, high = F.lit(0).cast(kind), F.lit(100).cast(kind)
    return sales.withColumn("discount_pct", clipped(F.col("discount_pct"), low, high))


def _recomputed(sales: DataFrame, column: str, value: Column, flag: str, rules: Rules):
    wrong = hit(F.abs(F.col(column) - value) > F.lit(rules.tolerance))
    return sales.withColumns(
        {column: F.when(wrong, value).otherwise(F.col(column)), flag: wrong}
    )


def repair_gross(sales: DataFrame, rules: Rules) -> DataFrame:
    value = (F.col("unit_price") * F.col("quantity")).cast(AMOUNT)
    return _recomputed(sales, "gross_amount", value, "fixed_gross", rules)


def repair_net(sales: DataFrame, rules: Rules) -> DataFrame:
    value = percent_off(F.col("gross_amount"), F.col("discount_pct"))
    return _recomputed(sales, "net_amount", value, "fixed_net", rules)


def add_margin(sales: DataFrame) -> DataFrame:
    cost = F.col("master_cost") * F.col("quantity")
    return sales.withColumn("gross_margin", (F.col("net_amount") - cost).cast(AMOUNT))


def flag_wholesale(sales: DataFrame, rules: Rules) -> DataFrame:
    return sales.withColumn("is_wholesale_bulk", hit(F.col("quantity") >= rules.bulk_quantity))


def high_value_limit(sales: DataFrame, rules: Rules) -> DataFrame:
    """One row: the quantile of the net amount over all sales, in cents."""
    amounts = sales.select(cents(F.col("net_amount")).alias("cents"))
    return overall_quantile(amounts, "cents", rules.high_value_quantile, "limit_cents")


def flag_high_value(sales: DataFrame, limit: DataFrame) -> DataFrame:
    """`limit` has one row; it enters as a scalar subquery, not as a join."""
    return sales.withColumn(
        "is_high_value",
        hit(cents(F.col("net_amount")) > limit.select("limit_cents").scalar()),
    )


def fill_gaps(sales: DataFrame, rules: Rules) -> DataFrame:
    return canonical_mode(fill_sentinel(fill_unknown(sales), rules), rules)


def clean_sales(sales: DataFrame, card: DataFrame, rules: Rules) -> DataFrame:
    """All row repairs and derived columns except the high-value flag.

    The order matters: amounts are recomputed from repaired prices, quantities
    and discounts, and the margin from repaired amounts.
    """
    priced = repair_price(with_card(fill_gaps(sales, rules), card), rules)
    counted = clip_discount(cap_quantity(priced))
    return flag_wholesale(add_margin(repair_net(repair_gross(counted, rules), rules)), rules)
