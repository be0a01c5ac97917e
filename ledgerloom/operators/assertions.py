"""Final conditions on sales: each gives the rows that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import hit


class IntegrityError(ValueError):
    """Published sales would break a final condition."""


def _breaks_net_le_gross() -> Column:
    """Sold quantity, but net is not at most gross (or one of them is missing)."""
    holds = hit(F.col("net_amount") <= F.col("gross_amount"))
    return hit(F.col("quantity") >= 0) & ~holds


def _breaks_returns() -> Column:
    holds = hit(F.col("net_amount") >= F.col("gross_amount"))
    return hit(F.col("quantity") < 0) & ~holds


def _breaks_discount() -> Column:
    return ~hit(F.col("discount_pct").between(0, 100))


def net_above_gross(sales: DataFrame) -> DataFrame:
    return sales.where(_breaks_net_le_gross())


def net_below_gross_on_return(sales: DataFrame) -> DataFrame:
    return sales.where(_breaks_returns())


def discount_out_of_range(sales: DataFrame) -> DataFrame:
    return sales.where(_breaks_discount())


def unknown_product(sales: DataFrame, product: DataFrame) -> DataFrame:
    return sales.join(product.select("product_id"), "product_id", "left_anti")


def integrity_report(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Number of rows against each final condition, in one pass: products are looked up for
    the counts per product, not for the sales."""
    broken = {
        "net_le_gross": _breaks_net_le_gross(),
        "returns": _breaks_returns(),
        "discount_range": _breaks_discount(),
    }
    counts = sales.groupBy("product_id").agg(
        *[F.count_if(cond).alias(name) for name, cond in broken.items()],
        F.count(F.lit(1)).alias("n"),
    )
    known = product.select("product_id").distinct().withColumn("known", F.lit(True))
    orphans = F.when(F.col("known").isNull(), F.col("n"))
    total = counts.join(known, "product_id", "left").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in broken],
        F.coalesce(F.sum(orphans), F.lit(0)).alias("product_fk"),
    )
    return total.unpivot([], [*broken, "product_fk"], "assertion", "n_violations")


def unfinished(spark: SparkSession) -> DataFrame:
    """The report of a run that has not come to its end."""
    return spark.createDataFrame([("finished", 1)], "assertion string, n_violations bigint")


def require_integrity(report: DataFrame) -> None:
    """Stop the job when a condition is broken. The report has four rows."""
    broken = {r["assertion"]: r["n_violations"] for r in report.collect() if r["n_violations"]}
    if broken:
        raise IntegrityError(f"rows against final conditions: {broken}")
