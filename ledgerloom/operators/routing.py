"""Sales that cannot be right: six rules, one reason per row, one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import hit
from ..rules import (
    FUTURE_DATE,
    GODOWN_BILLING,
    GODOWN_ROLE,
    ORPHAN_EMPLOYEE,
    ORPHAN_PRODUCT,
    ORPHAN_STORE,
    PROMO_WINDOW,
    Rules,
)

_HELPERS = ("known_employee", "is_godown", "known_store", "promo_start", "promo_end")


def lookups(
    employee: DataFrame, store: DataFrame, promotion: DataFrame
) -> dict[str, DataFrame]:
    """What the rules need of each dimension, one row per key, so that no sale doubles.

    Write these before joining sales to them: the planner then knows their size, and a
    shuffled join of two plain tables can split the partition of a hot or missing key,
    which it cannot behind an aggregate.
    """
    return {
        "lookup_employee": employee.where(F.col("employee_id").isNotNull())
        .groupBy("employee_id")
        .agg(F.max(hit(F.col("role") == GODOWN_ROLE)).alias("is_godown"))
        .withColumn("known_employee", F.lit(True)),
        "lookup_store": store.where(F.col("store_id").isNotNull())
        .select("store_id")
        .distinct()
        .withColumn("known_store", F.lit(True)),
        "lookup_promotion": promotion.where(F.col("promotion_id").isNotNull())
        .groupBy("promotion_id")
        .agg(F.min(F.struct("start_date", "end_date")).alias("p"))
        .select(
            "promotion_id",
            F.col("p.start_date").alias("promo_start"),
            F.col("p.end_date").alias("promo_end"),
        ),
    }


def with_references(sales: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    return (
        sales.join(tables["lookup_employee"], "employee_id", "left")
        .join(tables["lookup_store"], "store_id", "left")
        .join(tables["lookup_promotion"], "promotion_id", "left")
    )


def rule_conditions(rules: Rules) -> dict[str, Column]:
    """Reason -> condition, in the order in which a row is tested.

    Expects the columns of `with_references` and `in_master` of the product card.
    """
    day = F.col("date_id")
    return {
        ORPHAN_EMPLOYEE: F.col("known_employee").isNull()
        & ~F.col("employee_id").eqNullSafe(F.lit(rules.sentinel_employee)),
        ORPHAN_STORE: F.col("known_store").isNull(),
        ORPHAN_PRODUCT: ~F.col("in_master"),
        FUTURE_DATE: hit(day >= F.lit(rules.leakage_cutoff)),
        GODOWN_BILLING: hit(F.col("is_godown")),
        PROMO_WINDOW: hit((day < F.col("promo_start")) | (day > F.col("promo_end"))),
    }


def route(sales: DataFrame, tables: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """Add `quarantine_reason`: the first rule a row breaks, missing for a good row."""
    reasons = [F.when(cond, F.lit(text)) for text, cond in rule_conditions(rules).items()]
    return (
        with_references(sales, tables)
        .withColumn("quarantine_reason", F.coalesce(*reasons))
        .drop(*_HELPERS)
    )
