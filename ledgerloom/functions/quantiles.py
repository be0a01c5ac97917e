"""Exact quantiles by linear interpolation, without holding a group in one task.

Rows are counted per value, or per bucket of values, before the shuffle, so a group
with a third of all rows costs one row per distinct value and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def between(low: Column, high: Column, weight: Column) -> Column:
    """Interpolate from the nearer end, so both ends are reached exactly."""
    step = high - low
    return F.when(weight < 0.5, low + step * weight).otherwise(high - step * (1 - weight))


def _counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with a value, per key. Counting values, rather than filtering rows, keeps
    the optimizer from repeating the whole expression behind `value` in a filter."""
    return df.groupBy(*keys).agg(F.count(value).alias("_n")).where("_n > 0")


def _position(total: Column, fraction: float) -> Column:
    return (total - 1) * F.lit(float(fraction))


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], value: str, fractions: dict[str, float]
) -> DataFrame:
    """One row per group with a column per named fraction, as DOUBLE.

    For values with few distinct numbers per group, such as piece counts.
    """
    inside = W.partitionBy(*by)
    ranked = _counts(df, [*by, value], value).select(
        *by,
        F.col(value).cast("double").alias("_v"),
        F.sum("_n").over(inside.orderBy(value)).alias("_upto"),
        F.sum("_n").over(inside).alias("_total"),
    )
    ends = []
    for name, fraction in fractions.items():
        at = F.floor(_position(F.col("_total"), fraction))
        after = F.least(at + 1, F.col("_total") - 1)
        ends += [
            F.min(F.when(F.col("_upto") > at, F.col("_v"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_upto") > after, F.col("_v"))).alias(f"_hi_{name}"),
        ]
    found = ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *ends)
    columns = []
    for name, fraction in fractions.items():
        at = _position(F.col("_total"), fraction)
        columns.append(
            between(F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), at - F.floor(at)).alias(name)
        )
    return found.select(*by, *columns)


def overall_quantile(
    df: DataFrame, value: str, fraction: float, name: str, bucket: int = 1_000_000
) -> DataFrame:
    """One row with the quantile of a whole-number column such as cents, as DOUBLE.

    Two passes, each with a small shuffle. The first counts rows per bucket of
    neighbouring values and finds the bucket that holds the wanted position; the
    second counts the values inside it. The ordered steps see at most one row per
    bucket and one row per value of two buckets, whatever the number of rows; for
    12-digit cents that is two million rows.
    """
    rows = df.select(
        value, F.coalesce(F.floor(F.col(value) / F.lit(bucket)), F.lit(0)).alias("_bucket")
    )
    everything = W.partitionBy(F.lit(0))
    buckets = (
        _counts(rows, ["_bucket"], value)
        .select(
            "_bucket",
            (F.sum("_n").over(everything.orderBy("_bucket")) - F.col("_n")).alias("_before"),
            "_n",
            F.sum("_n").over(everything).alias("_total"),
        )
        .withColumn("_at", _position(F.col("_total"), fraction))
        .withColumn("_lo", F.floor("_at"))
        .withColumn("_hi", F.least(F.col("_lo") + 1, F.col("_total") - 1))
    )

    def covers(position: str, start: Column, size: Column) -> Column:
        return (F.col(position) >= start) & (F.col(position) < start + size)

    wanted = buckets.where(
        covers("_lo", F.col("_before"), F.col("_n")) | covers("_hi", F.col("_before"), F.col("_n"))
    ).select("_bucket", "_before", "_at", "_lo", "_hi")
    # At most two rows by construction, so the broadcast is bounded.
    inside = _counts(rows.join(F.broadcast(wanted), "_bucket"), [*wanted.columns, value], value)
    ranked = inside.withColumn(
        "_start",
        F.col("_before") + F.sum("_n").over(W.partitionBy("_bucket").orderBy(value)) - F.col("_n"),
    )
    ends = ranked.agg(
        F.max(F.when(covers("_lo", F.col("_start"), F.col("_n")), F.col(value))).alias("_l"),
        F.max(F.when(covers("_hi", F.col("_start"), F.col("_n")), F.col(value))).alias("_h"),
        F.max(F.col("_at") - F.col("_lo")).alias("_w"),
    )
    return ends.select(
        between(F.col("_l").cast("double"), F.col("_h").cast("double"), F.col("_w")).alias(name)
    )
