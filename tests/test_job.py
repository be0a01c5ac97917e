"""The whole job and all registered queries against their SQL."""

import re

import pytest
from conftest import plan_of, values

from checks import compare, oracle, queries, staged
from ledgerloom.operators import routing, sales, structuring
from ledgerloom.operators.assertions import IntegrityError
from ledgerloom.plans import analytics, findings, pipeline
from ledgerloom.schemas import LAYOUT, RAW_TABLES, STAR
from ledgerloom.session import input_bytes, settings_for
from ledgerloom.sources import published as pub
from ledgerloom.sources.raw import write_csv
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.fixture(scope="module")
def job(spark, sf_dir):
    return queries.published(spark, sf_dir)


def test_every_query_has_sql():
    assert set(queries.registered()) == set(oracle.statements())


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_query_matches_sql(spark, sf_dir, duck, name):
    got = queries.registered()[name](spark, sf_dir).toPandas()
    want = duck.execute(oracle.statements()[name]).df()
    assert compare.difference(got, want) is None


def test_rows_add_up(spark, job, sf_dir, tmp_path):
    """The summary against what is in the written folders."""
    total = {r["table_name"]: r.asDict() for r in job.run_summary().collect()}
    assert set(total) == {*RAW_TABLES, "total"}
    folder = str(tmp_path)
    pub.publish_clean({name: job.clean(name) for name in RAW_TABLES}, folder)
    pub.publish_quarantine(job.quarantine(), folder)
    raw = staged.raw_tables(spark, sf_dir)
    for name in RAW_TABLES:
        r = total[name]
        assert r["rows_out"] == spark.read.parquet(f"{folder}/{name}_clean").count()
        assert r["rows_in"] == raw[name].count()
        quarantined = 0
        if name == "fact_sales":
            quarantined = spark.read.parquet(f"{folder}/quarantined_fact_sales").count()
        assert r["rows_quarantined"] == quarantined
        assert r["rows_refused"] == job.refused_rows(name).count()
        copies = raw[name].count() - raw[name].distinct().count() if name == "fact_sales" else 0
        assert r["rows_dropped"] == copies


def test_refused_rows_are_kept_whole(job):
    refused = job.refused_rows("fact_sales").collect()
    assert refused and all(r["transaction_id"] and r["refused_values"] for r in refused)
    notes = " ".join(r["refused_values"] for r in refused)
    assert "employee_id=E-77" in notes
    assert job.refused().count() == sum(job.refused_rows(t).count() for t in STAR
                                        if t != "fact_sales_quarantine")


def test_quarantine_keeps_the_written_product(job):
    products = {r[0] for r in job.quarantine().select("product_id").distinct().collect()}
    assert "XYZ-9" in products and "9999999" in products
    assert job.quarantine().count() == job.table("fact_sales_quarantine").count()


def test_routes_are_disjoint_and_complete(spark, sf_dir, job):
    stored = job.stored("fact_sales")
    rows = queries.rows(spark, sf_dir).count()
    loaded = job.clean("fact_sales").count() + job.refused_rows("fact_sales").count()
    assert loaded + job.quarantine().count() == rows
    assert stored.where("(route = 'clean') != (quarantine_reason is null)").count() == 0


def test_route_reads_only_its_folders(job):
    plan = plan_of(job.table("fact_sales_quarantine"))
    assert "PartitionFilters: [isnotnull(route" in plan


def test_reports_on_some_months_read_only_their_folders(job):
    star = {name: df for name, df in job.star().items() if name in STAR}  # no summaries
    festivals = plan_of(findings.festival_months(star))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", festivals)
    periods = plan_of(findings.period_compare(star, staged.RULES))
    assert re.search(r"PartitionFilters: \[[^\]]*year\(sale_month", periods)


REPORTS = (
    analytics.category_yoy, analytics.revenue_per_employee, analytics.operating_margin,
    findings.tamil_month_profile, findings.festival_months,
    lambda star: findings.surge_ratio(star, staged.RULES),
    lambda star: findings.period_compare(star, staged.RULES),
)


def test_reports_read_the_summaries_and_not_the_sales(job):
    star = job.star()
    bare = {name: df for name, df in star.items() if name in STAR}
    for report in REPORTS:
        read, instead = (" ".join(report(x).inputFiles()) for x in (star, bare))
        assert "/work/sales_by_" in read and "/published/fact_sales/" not in read
        assert "/published/fact_sales/" in instead
        assert sorted(map(str, values(report(star), "*"))) == sorted(map(str, values(report(bare), "*")))


def test_summaries_of_other_sales_are_not_read(spark, sf_dir, tmp_path):
    job = queries.run_job(spark, sf_dir, str(tmp_path / "run"))
    assert set(job.summaries()) == {analytics.PRODUCT_MONTHS, analytics.DAYS}
    days = job.star()["fact_sales"].where("date_id is not null").select("date_id").distinct().count()
    assert job.star()[analytics.DAYS].count() == days
    files = next((tmp_path / "run/published/fact_sales/route=clean").glob("sale_month=*"))
    files.rename(tmp_path / "gone")
    assert job.summaries() == {}
    assert analytics.DAYS not in job.star()


def test_published_types(job):
    star = job.star()
    for name in STAR:
        df = star[name]
        found = [(f.name, f.dataType) for f in df.schema if f.name not in LAYOUT.get(name, ())]
        assert found == [(f.name, f.dataType) for f in STAR[name]]


def test_failed_condition_stops_the_job(spark, sf_dir, tmp_path):
    """Sales without a discount cannot be published."""
    raw = dict(staged.raw_tables(spark, sf_dir))
    raw["fact_sales"] = raw["fact_sales"].withColumn("discount_pct", F.lit(None).cast("string"))
    with pytest.raises(IntegrityError, match="discount_range"):
        pipeline.run(raw, staged.calendar(spark, sf_dir), staged.RULES, str(tmp_path))
    failed = pipeline.Published(spark, str(tmp_path), staged.RULES)
    with pytest.raises(IntegrityError, match="discount_range"):
        failed.star()


def test_a_run_that_has_not_ended_is_not_loaded(spark, sf_dir, tmp_path, monkeypatch):
    def stopped(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(pipeline.structuring, "distinct_rows", stopped)
    raw = staged.raw_tables(spark, sf_dir)
    with pytest.raises(RuntimeError, match="stopped"):
        pipeline.run(raw, staged.calendar(spark, sf_dir), staged.RULES, str(tmp_path))
    with pytest.raises(IntegrityError, match="finished"):
        pipeline.Published(spark, str(tmp_path), staged.RULES).star()


def test_final_conditions_read_the_sales_once(job):
    plan = plan_of(job.integrity())
    assert len(re.findall(r"FileScan parquet \[[^\]]*gross_amount", plan)) == 1
    assert plan.count("FileScan") == 2


def test_csv_publication(spark, job, tmp_path):
    pub.publish_clean({"dim_store": job.clean("dim_store")}, str(tmp_path), form="csv")
    back = pub.read_published(spark, str(tmp_path), "dim_store_clean", "csv")
    stores = values(job.clean("dim_store"), "store_name", "location")
    assert sorted(values(back, "store_name", "location")) == sorted(stores)
    assert any("\n" in location for _, location in stores)  # one has line breaks
    empty = job.clean("fact_sales_quarantine").limit(0)
    pub.publish_quarantine(empty, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/quarantined_fact_sales").columns == empty.columns


def test_folder_to_folder(spark, sf_dir, tmp_path):
    """The command: a folder of text files in, tables and text files out."""
    from ledgerloom.__main__ import run_folder

    raw = f"{tmp_path}/raw"
    for name, df in staged.file_text(spark, sf_dir).items():
        write_csv(df, f"{raw}/{name}.csv")
    write_csv(staged.calendar(spark, sf_dir), f"{raw}/dim_date.csv")
    with open(f"{raw}/dim_store.csv/part-broken.csv", "w") as f:
        f.write("store_id,store_name,store_type,location\n7,too short\n")
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        out = run_folder(spark, raw, f"{tmp_path}/out", staged.RULES, csv=True)
        assert {name: spark.conf.get(name) for name in names} == settings_for(
            input_bytes(spark, raw)
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    lines = spark.read.parquet(f"{tmp_path}/out/malformed").collect()
    assert [tuple(r) for r in lines] == [("dim_store", "7,too short")]
    expected = queries.published(spark, sf_dir)
    for table in ("dim_date", "dim_customer", "fact_sales", "fact_sales_quarantine"):
        assert out.clean(table).exceptAll(expected.clean(table)).count() == 0
    text = pub.read_published(spark, f"{tmp_path}/out/clean", "fact_sales_clean", "csv")
    assert text.count() == expected.clean("fact_sales").count()
    reasons = {r["quarantine_reason"]: r["n"] for r in out.quarantine_reasons().collect()}
    assert sum(reasons.values()) == expected.quarantine().count()


# --- plans -------------------------------------------------------------------


@pytest.fixture(scope="module")
def routed(spark, sf_dir, job):
    """Cleaning and routing as the job plans it, on its written working tables."""
    rows = spark.read.parquet(job.path("work", "fact_sales"))
    card = spark.read.parquet(job.path("work", "product_card"))
    limit = spark.read.parquet(job.path("work", "high_value_limit"))
    flagged = sales.flag_high_value(sales.clean_sales(rows, card, staged.RULES), limit)
    return routing.route(flagged, queries.lookups(job), staged.RULES)


def test_routing_reads_sales_once_and_does_not_move_them(routed):
    plan = plan_of(routed)
    assert len(re.findall(r"FileScan parquet \[[^\]]*transaction_id", plan)) == 1
    assert plan.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_routing_without_broadcast_joins_by_shuffle(spark, routed, job):
    """Dimensions beyond the size limit lead to the same rows by another join."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = routed.groupBy("quarantine_reason").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = routed.select("*").groupBy("quarantine_reason").count()
        plan = plan_of(shuffled)
        assert "BroadcastHashJoin" not in plan
        # nothing but a sort lies between a shuffle and its join, or a skewed
        # partition could not be split
        between = re.findall(r"SortMergeJoin.*\n\s*:- (\w+).*\n\s*:\s+\+- (\w+)", plan)
        assert between and set(between) == {("Sort", "Exchange")}
        found = sorted(shuffled.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert found == sorted(expected.collect(), key=str)


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(queries.registered()[name](spark, sf_dir))
    for node in ("Python", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_copies_are_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(queries.rows(spark, sf_dir))
    final, partial = plan.index("count(1)"), plan.index("partial_count(1)")
    assert final < plan.index("Exchange hashpartitioning(transaction_id") < partial


def test_one_product_with_most_rows(spark, rules):
    """A product with nearly all sales, and one row repeated often, come out right."""
    schema = (
        "id bigint, product_id string, quantity int, unit_price decimal(18,2), "
        "discount_pct decimal(7,2), gross_amount decimal(18,2), net_amount decimal(18,2), "
        "payment_mode string, employee_id bigint"
    )
    lines = spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then 0 else id end as id",
        "case when id % 50 = 1 then cast(id as string) else 'hot' end as product_id",
        "cast(case when id % 3 = 0 then 1 else id % 100 end as int) as quantity",
        "cast(10 as decimal(18,2)) as unit_price",
        "cast(0 as decimal(7,2)) as discount_pct",
        "cast(0 as decimal(18,2)) as gross_amount",
        "cast(0 as decimal(18,2)) as net_amount",
        "'Cash' as payment_mode",
        "cast(1 as bigint) as employee_id",
    )
    assert lines.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    rows = structuring.distinct_rows(lines)
    product = spark.createDataFrame([("hot",)], "product_id string").selectExpr(
        "product_id", "cast(10 as decimal(18,2)) as unit_price",
        "cast(5 as decimal(18,2)) as unit_cost",
    )
    card = sales.product_card(rows, product, rules)
    cleaned = sales.clean_sales(rows, card, rules)
    expected = lines.distinct().count()
    assert cleaned.count() == expected
    assert rows.selectExpr("sum(copies)").first()[0] == 60_000
    assert cleaned.where("product_id = 'hot' and in_master").count() == (
        lines.distinct().where("product_id = 'hot'").count()
    )
