"""The batch job: raw tables in, published tables, working tables and metrics out.

The sales table is shuffled as whole rows twice: to drop equal rows, and to lay the
result out by month. The grain report shuffles two columns of it, the other reports sums.
What lies between are narrow passes over a written table that look up products, staff,
stores and promotions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import assertions, reconcile, routing, sales, stock, structuring, tables
from ..operators.star import accepted, apply_schema, load_star, refused
from ..rules import Rules
from ..schemas import LAYOUT, RAW_TABLES, REFUSED, STAR, UNREADABLE
from ..session import folder_version, freed_shuffles, write_table
from ..sources import published as pub
from ..sources.raw import raw_row_counts, stacked
from . import analytics

# The repairs that count as corrected values, per table.
COUNTED_FLAGS = {
    "fact_sales": sales.FIX_FLAGS,
    "dim_product": ("fixed_brand", "fixed_cost", "fixed_gst"),
    "dim_employee": ("fixed_salary", "fixed_join_date"),
    "dim_promotion": ("fixed_dates", "fixed_discount"),
    "fact_purchase_order": ("fixed_received", "fixed_dates"),
    "fact_stock": ("fixed_level",),
}


# The product of a sale as it was written, which need not be a number.
PRODUCT_TEXT = "product_text"


def stored_schema(table: str) -> T.StructType:
    """Columns of a published table: declared ones, the notes, repair flags."""
    declared = STAR["fact_sales_quarantine" if table == "fact_sales" else table]
    texts = [REFUSED, UNREADABLE] if table in RAW_TABLES else [REFUSED]
    texts += [PRODUCT_TEXT] if table == "fact_sales" else []
    flags = [T.StructField(f, T.BooleanType()) for f in COUNTED_FLAGS.get(table, ())]
    notes = [T.StructField(name, T.StringType()) for name in texts]
    return T.StructType([*declared.fields, *notes, *flags])


@dataclass(frozen=True)
class Published:
    """The tables one run has written, read lazily."""

    spark: SparkSession
    folder: str
    rules: Rules

    def path(self, kind: str, table: str) -> str:
        return f"{self.folder}/{kind}/{table}"

    def stored(self, table: str) -> DataFrame:
        """A published table with its refusal note and repair flags.

        `fact_sales` also has `route` and `sale_month` and holds both routes.
        """
        path, schema = self.path("published", table), stored_schema(table)
        if table == "fact_sales":
            return pub.read_routed(self.spark, path, schema)
        return self.spark.read.schema(schema).parquet(path)

    def table(self, name: str, layout: bool = False) -> DataFrame:
        """One of the twelve tables with its refusal note, on request with its folders."""
        columns = [*STAR[name].fieldNames(), REFUSED, *(LAYOUT.get(name, ()) if layout else ())]
        routes = {"fact_sales": pub.CLEAN, "fact_sales_quarantine": pub.QUARANTINE}
        if name in routes:
            stored = self.stored("fact_sales").where(F.col("route") == routes[name])
        else:
            stored = self.stored(name)
        return stored.select(*columns)

    def clean(self, name: str) -> DataFrame:
        return accepted(self.table(name))

    def star(self) -> dict[str, DataFrame]:
        """The tables to be loaded, if the run has ended and its final conditions hold."""
        assertions.require_integrity(self.metric("integrity"))
        tables = {name: self.table(name, layout=True) for name in STAR}
        return load_star(tables, self.rules) | self.summaries()

    def _sales_version(self) -> str:
        return folder_version(self.spark, self.path("published", "fact_sales"))

    def summaries(self) -> dict[str, DataFrame]:
        """Sums of the clean sales by day and by month and product, if they were taken of the
        files that are there now."""
        if self.metric("summarised").first()["version"] != self._sales_version():
            return {}
        return {name: self.working(name) for name in (analytics.PRODUCT_MONTHS, analytics.DAYS)}

    def write_summaries(self) -> None:
        tables = {name: self.table(name, layout=True) for name in ("fact_sales", "dim_date")}
        tables = {name: accepted(df) for name, df in tables.items()}
        version = self._sales_version()
        for name, df in analytics.summaries(tables).items():
            write_table(df, self.path("work", name))
        taken = self.spark.range(1).select(F.lit(version).alias("version"))
        write_table(taken, self.path("metrics", "summarised"))

    def quarantine(self) -> DataFrame:
        """Every quarantined sale, the product as it was written."""
        columns = STAR["fact_sales_quarantine"].fieldNames()
        product = F.col(PRODUCT_TEXT).alias("product_id")
        sales = self.stored("fact_sales").where(F.col("route") == pub.QUARANTINE)
        return sales.select(*[product if c == "product_id" else c for c in columns])

    def refused_rows(self, name: str) -> DataFrame:
        """Whole rows of a table that is loaded which have a value that it cannot hold; the
        note has the text. Quarantined sales are not loaded, so nothing of them is refused."""
        return refused(self.table(name))

    def refused(self) -> DataFrame:
        return stacked(
            self.refused_rows(name).select(F.lit(name).alias("table_name"), REFUSED)
            for name in STAR
            if name != "fact_sales_quarantine"
        )

    def working(self, name: str) -> DataFrame:
        """A table the job wrote to go on from: distinct sales, the product card, ..."""
        return self.spark.read.parquet(self.path("work", name))

    def metric(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("metrics", name))

    def corrections(self) -> DataFrame:
        return corrections({name: self.stored(name) for name in COUNTED_FLAGS})

    def run_summary(self) -> DataFrame:
        def ways(name: str) -> DataFrame:
            """Rows of a table by where they went: a quarantined row is never refused too."""
            df = self.stored(name)
            quarantined = F.col("route") == pub.QUARANTINE if name == "fact_sales" else F.lit(False)
            way = (
                F.when(quarantined, pub.QUARANTINE)
                .when(F.col(REFUSED).isNotNull(), "refused")
                .otherwise(pub.CLEAN)
            )
            counts = df.groupBy(way.alias("route")).agg(F.count(F.lit(1)).alias("n"))
            return counts.select(F.lit(name).alias("table_name"), "route", "n")

        raw_counts = self.metric("profile").select("table_name", F.col("n_rows").alias("n"))
        routed = stacked(ways(name) for name in RAW_TABLES)
        return run_summary(raw_counts.distinct(), routed, self.corrections())

    def quarantine_reasons(self) -> DataFrame:
        quarantined = self.table("fact_sales_quarantine")
        return quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n"))

    def settlement_drift(self) -> DataFrame:
        return reconcile.settlement_drift(
            self.clean("fact_payment_settlement"), self.clean("fact_sales"), self.rules
        )

    def headcount_drift(self) -> DataFrame:
        return reconcile.headcount_drift(self.clean("fact_opex"), self.clean("dim_employee"))

    def integrity(self) -> DataFrame:
        return assertions.integrity_report(self.clean("fact_sales"), self.clean("dim_product"))


def corrections(flagged: dict[str, DataFrame]) -> DataFrame:
    """Corrected values per table and rule; a row hit by two rules counts twice."""
    parts = []
    for name, df in flagged.items():
        flags = list(COUNTED_FLAGS[name])
        counts = df.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
        parts.append(
            counts.unpivot([], flags, "rule", "n_corrected").select(
                F.lit(name).alias("table_name"), "rule", "n_corrected"
            )
        )
    return stacked(parts)


def run_summary(raw_counts: DataFrame, routed: DataFrame, corrected: DataFrame) -> DataFrame:
    """Rows in, out, quarantined, refused and dropped and values corrected, per table and in
    total. Copies of a row are what is dropped."""
    n = F.col("n")
    ways = routed.groupBy("table_name").agg(
        F.sum(F.when(F.col("route") == pub.CLEAN, n)).alias("rows_out"),
        F.sum(F.when(F.col("route") == pub.QUARANTINE, n)).alias("rows_quarantined"),
        F.sum(F.when(F.col("route") == "refused", n)).alias("rows_refused"),
    )
    fixes = corrected.groupBy("table_name").agg(F.sum("n_corrected").alias("values_corrected"))
    ways_out = ["rows_out", "rows_quarantined", "rows_refused"]
    numbers = ["rows_in", *ways_out, "values_corrected"]
    return (
        raw_counts.withColumnRenamed("n", "rows_in")
        .join(ways, "table_name", "left")
        .join(fixes, "table_name", "left")
        .fillna(0, numbers)
        .rollup("table_name")
        .agg(*[F.sum(c).alias(c) for c in numbers])
        .select(
            F.coalesce("table_name", F.lit("total")).alias("table_name"),
            "rows_in",
            "rows_out",
            "rows_quarantined",
            "rows_refused",
            F.expr(" - ".join(["rows_in", *ways_out])).alias("rows_dropped"),
            "values_corrected",
        )
    )


def run(raw: dict[str, DataFrame], calendar: DataFrame, rules: Rules, folder: str) -> Published:
    """Run the whole job into `folder`, which all executors must be able to reach.

    Raises IntegrityError after writing when clean sales break a final condition;
    the folder then serves to find out why, and `Published.star` refuses it.
    """
    out = Published(calendar.sparkSession, folder, rules)
    with freed_shuffles(out.spark):
        _run(raw, calendar, rules, out)
    return out


def _run(
    raw: dict[str, DataFrame], calendar: DataFrame, rules: Rules, out: Published
) -> None:
    write_table(assertions.unfinished(out.spark), out.path("metrics", "integrity"))
    typed = structuring.structure(raw, rules)

    def work(name: str, df: DataFrame) -> DataFrame:
        return pub.materialised(df, out.path("work", name))

    def conformed(name: str, df: DataFrame) -> DataFrame:
        schema = stored_schema(name)
        declared = STAR["fact_sales_quarantine" if name == "fact_sales" else name]
        beside = [c for c in schema.fieldNames() if c not in {*declared.fieldNames(), REFUSED}]
        if PRODUCT_TEXT in beside:
            df = df.withColumn(PRODUCT_TEXT, F.col("product_id"))
        return apply_schema(df, declared, tuple(beside)).select(*schema.fieldNames())

    rows = work("fact_sales", structuring.distinct_rows(typed["fact_sales"]))
    stock_events = work("fact_stock", typed["fact_stock"])

    product = tables.clean_product(typed["dim_product"], rules)
    others = {
        "dim_date": calendar,
        "dim_store": typed["dim_store"],
        "dim_product": product,
        "dim_employee": tables.clean_employee(typed["dim_employee"], rules),
        "dim_promotion": tables.clean_promotion(typed["dim_promotion"]),
        "dim_customer": reconcile.reconcile_first_purchase(typed["dim_customer"], rows, rules),
        "fact_stock": stock.repair_spikes(stock_events, rules),
        "fact_purchase_order": tables.clean_purchase_order(typed["fact_purchase_order"]),
        "fact_payment_settlement": tables.clean_settlement(
            typed["fact_payment_settlement"], rules
        ),
        "fact_opex": typed["fact_opex"],
    }
    writes = {out.path("published", name): conformed(name, df) for name, df in others.items()}

    # Every table keeps its rows when typed, so these are the raw figures; the copies
    # counted with the distinct sales stand for the raw sales.
    profiled = {**typed, "fact_sales": rows, "fact_stock": stock_events}
    writes[out.path("metrics", "profile")] = structuring.table_profile(profiled).coalesce(1)
    writes[out.path("metrics", "grain")] = structuring.grain_check(rows)

    # What the sales are joined to is read from files, so that the planner knows its true
    # size, and can split skewed partitions where it is too large to broadcast. None of
    # it waits for the other tables, so all are written side by side.
    with ThreadPoolExecutor(4) as pool:
        waiting = [pool.submit(write_table, df, path) for path, df in writes.items()]
        card = work("product_card", sales.product_card(rows, product, rules))
        # Repairs run once; the limit is taken from one column of what they have written.
        cleaned = work("clean_sales", sales.clean_sales(rows, card, rules))
        limit = work("high_value_limit", sales.high_value_limit(cleaned, rules))
        for write in waiting:
            write.result()

    flagged = sales.flag_high_value(cleaned, limit)
    dimensions = [out.stored(t) for t in ("dim_employee", "dim_store", "dim_promotion")]
    lookups = {name: work(name, df) for name, df in routing.lookups(*dimensions).items()}
    routed = routing.route(flagged, lookups, rules)
    pub.write_routed(conformed("fact_sales", routed), out.path("published", "fact_sales"))

    out.write_summaries()
    write_table(out.integrity().coalesce(1), out.path("metrics", "integrity"))
    assertions.require_integrity(out.metric("integrity"))
