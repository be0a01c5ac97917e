"""Isolated spikes in the stock level, found from each event's two neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import MONEY, hit
from ..rules import STOCKOUT_EVENT, Rules


def _counts(stock: DataFrame) -> DataFrame:
    return stock.groupBy(F.col("product_id").alias("heavy_product")).agg(F.count("*").alias("n"))


def _block_rows(stock: DataFrame) -> int | None:
    """The events a shuffle partition holds on average, if any product has more of them. There
    are fewer such products than partitions, so a list of them is safe to broadcast."""
    total, most = _counts(stock).agg(F.sum("n"), F.max("n")).first()
    limit = -(-(total or 0) // int(stock.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return limit if (most or 0) > limit else None


def _of_heavy(stock: DataFrame, heavy: DataFrame) -> DataFrame:
    same = stock["product_id"].eqNullSafe(heavy["heavy_product"])
    return stock.join(F.broadcast(heavy), same).drop("heavy_product")


def _heavy_days(rows: DataFrame, limit: int) -> DataFrame:
    """Days of heavy products that are cut into slices of event numbers, fewer than partitions."""
    return (
        rows.groupBy(F.col("product_id").alias("heavy_product"), F.col("date_id").alias("heavy_day"))
        .agg(
            F.count("*").alias("n"),
            F.min("stock_event_id").alias("first_id"),
            F.max("stock_event_id").alias("last_id"),
        )
        .where(F.col("n") > limit)
        .withColumn("slices", F.ceil(F.col("n") / F.lit(max(limit, 1))))
        .drop("n")
    )


def _in_blocks(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Add `block` to events of heavy products: the day, and its slice. It keeps the order."""
    share = (F.col("stock_event_id") - F.col("first_id")).cast("double") / (
        F.col("last_id").cast("double") - F.col("first_id").cast("double") + 1
    )
    slice_ = F.coalesce(F.floor(share * F.col("slices")), F.lit(0)).alias("slice")
    same_day = rows["product_id"].eqNullSafe(days["heavy_product"]) & rows["date_id"].eqNullSafe(
        days["heavy_day"]
    )
    joined = rows.join(F.broadcast(days), same_day, "left")
    return joined.select(*rows.columns, F.struct("date_id", slice_).alias("block"))


def _neighbours_across_blocks(rows: DataFrame) -> DataFrame:
    """For each block of a heavy product the last event before and the first after it."""
    # A block lies within one day, so this is the order of the events in it.
    event = F.struct("stock_event_id", "stock_on_hand", "quantity_change", "date_id")
    blocks = rows.groupBy("product_id", "block").agg(
        F.min(event).alias("first"), F.max(event).alias("last")
    )
    in_order = W.partitionBy("product_id").orderBy(
        F.col("block.date_id").asc_nulls_last(), "block.slice"
    )
    before, after = F.lag("last").over(in_order), F.lead("first").over(in_order)
    return (
        blocks.select("product_id", "block", F.array_compact(F.array(before, after)).alias("halo"))
        .select("product_id", "block", F.explode("halo").alias("event"))
        .select("product_id", "block", "event.*")
    )


def _with_neighbours(stock: DataFrame, limit: int) -> DataFrame:
    """Events with `block`, null for a product that is one window, and beside them (not `kept`)
    those at the edges of neighbouring blocks."""
    heavy = _counts(stock).where(F.col("n") > limit).select("heavy_product")
    own = _of_heavy(stock, heavy)
    days = _heavy_days(own, limit)
    marks = heavy.select("heavy_product", F.lit(True).alias("is_heavy"))
    marked = stock.join(
        F.broadcast(marks), stock["product_id"].eqNullSafe(marks["heavy_product"]), "left"
    ).select(*stock.columns, "is_heavy")
    rows = _in_blocks(marked, days).withColumn("block", F.when(F.col("is_heavy"), F.col("block")))
    halo = _neighbours_across_blocks(_in_blocks(own, days))
    rows = rows.select(*stock.columns, "block", F.lit(True).alias("kept"))
    return rows.unionByName(halo.withColumn("kept", F.lit(False)), allowMissingColumns=True)


def repair_spikes(stock: DataFrame, rules: Rules, block_rows: int | None = None) -> DataFrame:
    """Take back a jump in the level that the next event takes back, or that comes last.

    The error of an event is the change of the level beyond the booked quantity.
    All errors are taken from the levels as they came in.

    An event needs its two neighbours, so a product is one window. A product with more events than
    a partition holds on average is cut by day, a heavy day by event number, and each such block
    gets the events at the edges of its neighbours. A narrow count of the products comes first;
    where none is heavy, there is nothing else but one shuffle of the events. `block_rows` sets
    another limit than that average, for tests.
    """
    if block_rows is None:
        block_rows = _block_rows(stock)
    if block_rows is None:
        rows = stock.withColumns({"block": F.lit(0), "kept": F.lit(True)})
    else:
        rows = _with_neighbours(stock, block_rows)

    # Level and change settle the order of events that repeat a number, here as in the halo.
    w = W.partitionBy("product_id", "block").orderBy(
        F.col("date_id").asc_nulls_last(), "stock_event_id", "stock_on_hand", "quantity_change"
    )
    level, change = F.col("stock_on_hand"), F.col("quantity_change")
    error = level - F.lag(level).over(w) - change
    next_error = F.lead(level).over(w) - level - F.lead(change).over(w)
    low, high = rules.spike_range
    back_low, back_high = rules.rebound_range
    spike = hit(
        ~F.col("event_type").eqNullSafe(STOCKOUT_EVENT)
        & F.col("error").between(low, high)
        & (F.col("next_error").isNull() | F.col("next_error").between(back_low, back_high))
    )
    return (
        rows.withColumns({"error": error, "next_error": next_error})
        .where("kept")
        .withColumn("fixed_level", spike)
        .withColumn(
            "stock_on_hand",
            F.when(F.col("fixed_level"), level - F.col("error")).otherwise(level).cast(MONEY),
        )
        .select(*stock.columns, "fixed_level")
    )
