"""One registered query per operator, on the staged test tables.

Typing, row deduplication and the rules of single tables start from the raw text.
Everything behind them goes on from the tables that one run of the whole job wrote,
once per session and data folder, as the job itself does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import staged
from ledgerloom.operators import (
    assertions,
    audits,
    reconcile,
    routing,
    sales,
    star,
    stock,
    structuring,
    tables,
)
from ledgerloom.plans import analytics, findings, pipeline
from ledgerloom.schemas import PRIMARY_KEYS, RAW_TABLES, REFERENCES, STAR, raw_columns
from ledgerloom.session import shared_folder, shuffles_for
from ledgerloom.sources import published as pub
from ledgerloom.sources.raw import raw_row_counts, scan_raw, stacked, write_csv

RULES = staged.RULES
Query = Callable[[SparkSession, str], DataFrame]

LINE = ("transaction_id", "product_id", "customer_id")


# Whole numbers that may be missing; both sides give them as DOUBLE.
MAY_BE_MISSING = ("store_id", "employee_id", "promotion_id", "quantity_ordered")


def comparable(df: DataFrame) -> DataFrame:
    """Widen integers, decimals to DOUBLE and dates to text, as the SQL side does."""

    def one(f: T.StructField):
        c = F.col(f.name)
        if f.name in MAY_BE_MISSING and not isinstance(f.dataType, T.StringType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        return c

    return df.select([one(f) for f in df.schema.fields])


# --- shared inputs -----------------------------------------------------------

_done: dict[tuple[str, str, str], object] = {}


def _folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    app = spark.sparkContext.applicationId
    data = hashlib.md5(sf_dir.encode()).hexdigest()[:10]
    return f"{shared_folder(spark)}/ledgerloom/{app}/{data}/{kind}"


def _once(spark: SparkSession, sf_dir: str, kind: str, make: Callable[[str], object]):
    folder = _folder(spark, sf_dir, kind)
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _done:
        _done[key] = make(folder)
    return _done[key]


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the raw tables as text files."""

    def write(folder: str) -> str:
        for name, df in staged.file_text(spark, sf_dir).items():
            write_csv(df, f"{folder}/{name}.csv", packed=True)
        return folder

    return _once(spark, sf_dir, "raw", write)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "calendar plan", lambda _: staged.calendar(spark, sf_dir))


def run_job(spark: SparkSession, sf_dir: str, folder: str) -> pipeline.Published:
    """The whole job, from text files to published tables."""
    raw = scan_raw(spark, text_files(spark, sf_dir))
    return pipeline.run(raw, calendar(spark, sf_dir), RULES, folder)


def published(spark: SparkSession, sf_dir: str) -> pipeline.Published:
    return _once(spark, sf_dir, "run", lambda folder: run_job(spark, sf_dir, folder))


def typed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _once(
        spark,
        sf_dir,
        "typed plans",
        lambda _: structuring.structure(staged.raw_tables(spark, sf_dir), RULES),
    )


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structuring.distinct_rows(typed(spark, sf_dir)["fact_sales"])


def with_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = published(spark, sf_dir)
    return sales.with_card(out.working("fact_sales"), out.working("product_card"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = published(spark, sf_dir)
    return sales.clean_sales(out.working("fact_sales"), out.working("product_card"), RULES)


def referenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled sales rows with everything the routing rules look at."""
    out = published(spark, sf_dir)
    lines = sales.fill_gaps(with_card(spark, sf_dir), RULES)
    return routing.with_references(lines, lookups(out))


def lookups(out: pipeline.Published) -> dict[str, DataFrame]:
    return {t: out.working(t) for t in ("lookup_employee", "lookup_store", "lookup_promotion")}


# --- A: sources, sinks, star -------------------------------------------------


def scan_sales(spark, sf_dir):
    return scan_raw(spark, text_files(spark, sf_dir), ["fact_sales"])["fact_sales"]


def count_raw(spark, sf_dir):
    return raw_row_counts(scan_raw(spark, text_files(spark, sf_dir)))


def whole_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of every table as one text, in the order of its columns; a tilde is missing."""
    return stacked(
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns))
            .alias("row_text"),
        )
        for name, df in tables.items()
    )


def scan_tables(spark, sf_dir):
    return whole_rows(scan_raw(spark, text_files(spark, sf_dir)))


def _clean_folder(spark, sf_dir) -> str:
    out = published(spark, sf_dir)

    def write(folder: str) -> str:
        pub.publish_clean({name: out.clean(name) for name in RAW_TABLES}, folder)
        return folder

    return _once(spark, sf_dir, "clean", write)


def publish_clean(spark, sf_dir):
    return spark.read.parquet(_clean_folder(spark, sf_dir) + "/fact_sales_clean")


def publish_clean_tables(spark, sf_dir):
    folder = _clean_folder(spark, sf_dir)
    return whole_rows({t: spark.read.parquet(f"{folder}/{t}_clean") for t in RAW_TABLES})


def publish_quarantine(spark, sf_dir):
    out = published(spark, sf_dir)

    def write(folder: str) -> str:
        pub.publish_quarantine(out.quarantine(), folder)
        return folder

    folder = _once(spark, sf_dir, "quarantine", write)
    return spark.read.parquet(folder + "/quarantined_fact_sales")


def _loaded(spark, sf_dir) -> dict[str, DataFrame]:
    def write(folder: str) -> str:
        star.write_star(published(spark, sf_dir).star(), folder)
        return folder

    folder = _once(spark, sf_dir, "star", write)
    return {
        t: spark.read.parquet(f"{folder}/{t}").select(*schema.fieldNames())
        for t, schema in STAR.items()
    }


def load_star(spark, sf_dir):
    return stacked(
        df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(df.columns[0]).alias("n_keys")).select(
            F.lit(name).alias("tbl"), "n", "n_keys"
        )
        for name, df in _loaded(spark, sf_dir).items()
    )


def _loaded_text(spark, sf_dir) -> dict[str, DataFrame]:
    """Publish as text, read the text back, load it under the declared types."""
    out = published(spark, sf_dir)
    clean = {t: t for t in ("dim_date", "fact_sales_quarantine")}
    names = {t: clean.get(t, f"{t}_clean") for t in STAR}

    def write(folder: str) -> str:
        pub.publish_clean({t: out.clean(t) for t in RAW_TABLES}, folder, form="csv", packed=True)
        for t in clean:
            write_csv(out.clean(t), f"{folder}/{t}.csv", packed=True)
        return folder

    def load(_: str) -> dict[str, DataFrame]:
        folder = _once(spark, sf_dir, "text", write)
        text = {t: pub.read_published(spark, folder, name, "csv") for t, name in names.items()}
        loaded = star.load_star(text, RULES)
        return {t: df.select(*STAR[t].fieldNames()) for t, df in loaded.items()}

    return _once(spark, sf_dir, "text plans", load)


def _star(spark, sf_dir):
    return _once(spark, sf_dir, "star plans", lambda _: published(spark, sf_dir).star())


def sentinel_member(spark, sf_dir):
    return _star(spark, sf_dir)["dim_employee"]


def apply_schema(spark, sf_dir):
    raw = staged.raw_tables(spark, sf_dir)["fact_purchase_order"]
    declared = T.StructType(
        [STAR["fact_purchase_order"][c] for c in raw_columns("fact_purchase_order")]
    )
    return star.apply_schema(raw, declared)


def audit_pk(spark, sf_dir):
    keys = {**PRIMARY_KEYS, "fact_sales": "transaction_id"}
    return audits.audit_keys(_star(spark, sf_dir), keys)


def audit_fk(spark, sf_dir):
    out = published(spark, sf_dir)
    both_routes = {**out.star(), "fact_sales": out.stored("fact_sales")}
    return audits.audit_references(both_routes, REFERENCES)


# --- B: structuring ----------------------------------------------------------


def nullable_ints(spark, sf_dir):
    return typed(spark, sf_dir)["fact_sales"].select(
        "transaction_id", "employee_id", "store_id", "promotion_id"
    )


def normalise_keys(spark, sf_dir):
    t = typed(spark, sf_dir)
    return stacked(
        t[name]
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("table_name"), "product_id", "n")
        for name in ("fact_sales", "dim_product", "fact_purchase_order", "fact_stock")
    )


def coerce_numeric(spark, sf_dir):
    return typed(spark, sf_dir)["fact_purchase_order"].select(
        "po_id", "quantity_ordered", "quantity_received"
    )


def parse_month(spark, sf_dir):
    return typed(spark, sf_dir)["fact_opex"].select("opex_id", "month")


# --- C and D: cleaning and enrichment ----------------------------------------


def _line(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*LINE, *columns)


def high_value_flag(spark, sf_dir):
    lines = published(spark, sf_dir).working("clean_sales")
    limit = sales.high_value_limit(lines, RULES)
    return _line(sales.flag_high_value(lines, limit), "net_amount", "is_high_value")


def _table_rule(table: str, rule: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: rule(typed(spark, sf_dir)[table]).select(*columns)


def _line_rule(rule: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: _line(rule(rows(spark, sf_dir)), *columns)


def _card_rule(rule: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: _line(rule(with_card(spark, sf_dir)), *columns)


def _cleaned_columns(*columns: str) -> Query:
    return lambda spark, sf_dir: _line(cleaned(spark, sf_dir), *columns)


# --- E: validation -----------------------------------------------------------


def first_purchase(spark, sf_dir):
    return reconcile.reconcile_first_purchase(
        typed(spark, sf_dir)["dim_customer"], rows(spark, sf_dir), RULES
    )


def _breaking(reason: str) -> Query:
    def query(spark, sf_dir):
        condition = routing.rule_conditions(RULES)[reason]
        found = referenced(spark, sf_dir).where(condition)
        return _line(found, "employee_id", "store_id", "promotion_id", "date_id")

    return query


def quarantine_route(spark, sf_dir):
    out = published(spark, sf_dir)
    routed = routing.route(cleaned(spark, sf_dir), lookups(out), RULES)
    return _line(routed, "quantity", "net_amount", "quarantine_reason")


def _both_stages(check: Callable[[DataFrame, DataFrame], DataFrame], *columns: str) -> Query:
    """Rows against a condition before the repairs and after them."""

    def query(spark, sf_dir):
        out = published(spark, sf_dir)
        stages = {
            "raw": (out.working("fact_sales"), typed(spark, sf_dir)["dim_product"]),
            "clean": (out.clean("fact_sales"), out.clean("dim_product")),
        }
        return stacked(
            check(lines, products).select(
                F.lit(stage).alias("stage"),
                "transaction_id",
                F.col("product_id").cast("string").alias("product_id"),
                *[F.col(c).cast("double").alias(c) for c in columns],
            )
            for stage, (lines, products) in stages.items()
        )

    return query


def _on_published(report: Callable[[pipeline.Published], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(published(spark, sf_dir))


def _on_star(report: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_star(spark, sf_dir))


AMOUNTS = ("quantity", "gross_amount", "net_amount", "discount_pct")

_QUERIES: dict[str, Query] = {
    "scan_raw": scan_sales,
    "raw_row_counts": count_raw,
    "publish_clean": publish_clean,
    "publish_quarantine": publish_quarantine,
    "load_star": load_star,
    "load_star_text": lambda spark, sf_dir: _loaded_text(spark, sf_dir)["fact_sales"],
    "scan_raw_tables": scan_tables,
    "publish_clean_tables": publish_clean_tables,
    "load_star_tables": lambda spark, sf_dir: whole_rows(_loaded(spark, sf_dir)),
    "load_star_text_tables": lambda spark, sf_dir: whole_rows(_loaded_text(spark, sf_dir)),
    "quarantine_reasons": _on_published(lambda out: out.quarantine_reasons()),
    "sentinel_member": sentinel_member,
    "apply_schema": apply_schema,
    "audit_pk": audit_pk,
    "audit_fk": audit_fk,
    "audit_not_null": _on_star(audits.audit_required),
    "audit_width": lambda spark, sf_dir: audits.audit_widths(typed(spark, sf_dir)),
    "load_rejects": _on_published(lambda out: out.refused()),
    "load_verification": _on_star(star.load_verification),
    "parse_dates": lambda spark, sf_dir: structuring.missing_dates(typed(spark, sf_dir)),
    "nullable_ints": nullable_ints,
    "domain_profile": lambda spark, sf_dir: structuring.domain_profile(typed(spark, sf_dir)),
    "normalise_keys": normalise_keys,
    "grain_check": lambda spark, sf_dir: structuring.grain_check(rows(spark, sf_dir)),
    "coerce_numeric": coerce_numeric,
    "parse_month": parse_month,
    "dedup_rows": rows,
    "fill_unknown": _line_rule(sales.fill_unknown, "payment_mode"),
    "fill_sentinel": _line_rule(lambda df: sales.fill_sentinel(df, RULES), "employee_id"),
    "canonical_mode": _line_rule(
        lambda df: sales.fill_gaps(df, RULES), "payment_mode", "fixed_mode"
    ),
    "brand_typos": _table_rule(
        "dim_product",
        lambda df: tables.fix_brands(df, RULES),
        "product_id", "brand_name", "fixed_brand",
    ),
    "price_glitch": _card_rule(
        lambda df: sales.repair_price(df, RULES), "quantity", "unit_price", "fixed_price"
    ),
    "quantity_caps": lambda spark, sf_dir: sales.quantity_caps(rows(spark, sf_dir), RULES),
    "cap_quantity_p99": _card_rule(sales.cap_quantity, "quantity", "fixed_quantity"),
    "cap_salary_iqr": _table_rule(
        "dim_employee",
        lambda df: tables.cap_salary(df, RULES),
        "employee_id", "monthly_salary", "fixed_salary",
    ),
    "clip_discount": _line_rule(sales.clip_discount, "quantity", "discount_pct"),
    "repair_gross": _cleaned_columns("unit_price", "quantity", "gross_amount", "fixed_gross"),
    "repair_net": _cleaned_columns("gross_amount", "discount_pct", "net_amount", "fixed_net"),
    "repair_cost": _table_rule(
        "dim_product",
        lambda df: tables.repair_cost(df, RULES),
        "product_id", "unit_cost", "fixed_cost",
    ),
    "gst_domain": _table_rule(
        "dim_product",
        lambda df: tables.repair_gst(df, RULES),
        "product_id", "gst_rate", "fixed_gst",
    ),
    "future_join_date": _table_rule(
        "dim_employee",
        lambda df: tables.repair_join_date(df, RULES),
        "employee_id", "join_date", "fixed_join_date",
    ),
    "swap_promo_dates": _table_rule(
        "dim_promotion",
        tables.order_promotion_dates,
        "promotion_id", "start_date", "end_date", "fixed_dates",
    ),
    "clip_promo_discount": _table_rule(
        "dim_promotion",
        tables.clip_promotion_discount,
        "promotion_id", "discount_pct", "fixed_discount",
    ),
    "cap_received": _table_rule(
        "fact_purchase_order",
        tables.cap_received,
        "po_id", "quantity_ordered", "quantity_received", "fixed_received",
    ),
    "swap_po_dates": _table_rule(
        "fact_purchase_order",
        tables.order_delivery_dates,
        "po_id", "order_date", "actual_delivery_date", "fixed_dates",
    ),
    "stock_spikes": _on_published(
        lambda out: stock.repair_spikes(out.working("fact_stock"), RULES).select(
            "stock_event_id", "product_id", "date_id", "stock_on_hand", "fixed_level"
        )
    ),
    "salary_line": lambda spark, sf_dir: tables.salary_line_report(
        typed(spark, sf_dir)["dim_employee"], RULES
    ),
    "corrections": _on_published(lambda out: out.corrections()),
    "gross_margin": _cleaned_columns("quantity", "net_amount", "gross_margin"),
    "days_to_deliver": _table_rule(
        "fact_purchase_order", tables.clean_purchase_order, "po_id", "days_to_deliver"
    ),
    "wholesale_flag": _cleaned_columns("quantity", "is_wholesale_bulk"),
    "high_value_flag": high_value_flag,
    "tenure_days": lambda spark, sf_dir: first_purchase(spark, sf_dir).select(
        "customer_id", "customer_tenure_days"
    ),
    "reconcile_first_purchase": lambda spark, sf_dir: first_purchase(spark, sf_dir).select(
        "customer_id", "first_purchase_date", "fixed_first_purchase"
    ),
    "q_orphan_employee": _breaking(routing.ORPHAN_EMPLOYEE),
    "q_orphan_store": _breaking(routing.ORPHAN_STORE),
    "q_orphan_product": _breaking(routing.ORPHAN_PRODUCT),
    "q_future_date": _breaking(routing.FUTURE_DATE),
    "q_godown_billing": _breaking(routing.GODOWN_BILLING),
    "q_promo_window": _breaking(routing.PROMO_WINDOW),
    "quarantine_route": quarantine_route,
    "settlement_mode": _table_rule(
        "fact_payment_settlement",
        lambda df: tables.clean_settlement(df, RULES),
        "settlement_id", "payment_mode",
    ),
    "settlement_recon": _on_published(lambda out: out.settlement_drift()),
    "settlement_unmatched": _on_published(
        lambda out: reconcile.unsettled_sales(
            out.clean("fact_payment_settlement"), out.clean("fact_sales")
        )
    ),
    "headcount_recon": _on_published(
        lambda out: out.headcount_drift().select("opex_id", "month", "headcount", "active_staff")
    ),
    "assert_net_le_gross": _both_stages(lambda s, p: assertions.net_above_gross(s), *AMOUNTS),
    "assert_returns": _both_stages(
        lambda s, p: assertions.net_below_gross_on_return(s), *AMOUNTS
    ),
    "assert_discount_range": _both_stages(
        lambda s, p: assertions.discount_out_of_range(s), *AMOUNTS
    ),
    "assert_product_fk": _both_stages(assertions.unknown_product, *AMOUNTS),
    "run_summary": _on_published(lambda out: out.run_summary()),
    "top_customers": _on_star(analytics.top_customers),
    "category_yoy": _on_star(analytics.category_yoy),
    "category_yoy_lag12": _on_star(analytics.category_yoy_lag12),
    "po_delay_by_hub": _on_star(analytics.po_delay_by_hub),
    "master_join": _on_star(analytics.master_join),
    "master_join_all": _on_star(analytics.master_join_all),
    "revenue_per_employee": _on_star(analytics.revenue_per_employee),
    "operating_margin": _on_star(analytics.operating_margin),
    "tamil_month_profile": _on_star(findings.tamil_month_profile),
    "festival_months": _on_star(findings.festival_months),
    "lead_time_range": _on_star(findings.lead_time_range),
    "surge_ratio": _on_star(lambda s: findings.surge_ratio(s, RULES)),
    "period_compare": _on_star(lambda s: findings.period_compare(s, RULES)),
}


def registered() -> dict[str, Query]:
    def shown(query: Query) -> Query:
        def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
            shuffles_for(spark, staged.packed_bytes(spark, sf_dir))
            return comparable(query(spark, sf_dir))

        return sized

    return {name: shown(query) for name, query in _QUERIES.items()}
