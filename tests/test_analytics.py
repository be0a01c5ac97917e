import re

import pytest
from conftest import plan_of, values

from ledgerloom.functions.quantiles import grouped_quantiles, overall_quantile
from ledgerloom.plans import analytics, findings
from ledgerloom.rules import Rules


@pytest.fixture
def star(table):
    """A star with single-day months; parts are replaced by the tests."""

    def make(sales=(), stock=(), orders=(), opex=(), days=None):
        days = days or sorted({s[1] for s in sales if s[1]})
        return {
            "fact_sales": table(
                "transaction_id string; product_id bigint; date_id date; customer_id bigint;"
                "quantity int; net_amount decimal(12,2); payment_mode string;"
                "discount_pct decimal(5,2)",
                [(f"T{i}", *s, "Cash", 10) for i, s in enumerate(sales)],
            ),
            "dim_date": table(
                "date_id date; year int; tamil_month string; season_tag string;"
                "festival_name string",
                [(d, int(d[:4]), f"M{d[5:7]}", "S", "Deepavali" if d[5:7] == "11" else None)
                 for d in days],
            ),
            "dim_customer": table(
                "customer_id bigint; customer_type string; home_area string",
                [(c, "t", "h") for c in range(1, 60)],
            ),
            "dim_product": table(
                "product_id bigint; category string; item_name string; brand_name string;"
                "manufacturing_hub string; unit_cost decimal(10,2); lead_time_days int",
                [(1, "silk", "i", "b", "K", 4, 20), (2, "cotton", "j", "c", "S", 3, 30),
                 (3, "cotton", "j", "c", "S", 3, 10)],
            ),
            "fact_stock": table(
                "stock_event_id bigint; product_id bigint; date_id date;"
                "stock_on_hand decimal(10,2)",
                list(stock),
            ),
            "fact_purchase_order": table(
                "po_id bigint; product_id bigint; expected_delivery_date date;"
                "actual_delivery_date date; days_to_deliver decimal(10,2)",
                list(orders),
            ),
            "fact_opex": table(
                "month date; expense_type string; amount decimal(12,2); headcount decimal(10,2)",
                list(opex),
            ),
        }

    return make


def test_growth_over_a_gap_year(star):
    sales = [
        (1, f"{y}-05-03", 1, 1, r) for y, r in ((2018, 10), (2019, 12), (2022, 20), (2023, 30))
    ]
    s = star(sales)
    assert values(analytics.category_yoy(s), "year", "prior_year_revenue", "yoy_pct") == [
        (2018, None, None), (2019, 10, 20.0), (2022, None, None), (2023, 20, 50.0),
    ]
    literal = analytics.category_yoy_lag12(s)
    assert {v for v in values(literal, "prior_year_revenue", "yoy_pct")} == {(None, None)}


def test_growth_over_zero(star):
    s = star([(1, "2018-05-03", 1, 1, 0), (1, "2019-05-03", 1, 1, 5)])
    assert values(analytics.category_yoy(s), "prior_year_revenue", "yoy_pct") == [
        (None, None), (0, None),
    ]


def test_top_customers(star):
    sales = [(1, "2018-05-03", c, 1, 100 - c // 2) for c in range(1, 40)]
    sales += [(1, "2018-05-03", 999, 1, 10_000), (1, "2018-05-03", None, 1, 10_000)]
    found = values(
        analytics.top_customers(star(sales), 5), "customer_id", "total_revenue", "revenue_rank"
    )
    assert found == [(1, 100, 1), (2, 99, 2), (3, 99, 2), (4, 98, 4), (5, 98, 4)]


def test_top_customers_cuts_before_it_ranks(spark, sf_dir):
    from checks import queries

    plan = plan_of(analytics.top_customers(queries._star(spark, sf_dir)))
    assert "TakeOrderedAndProject" in plan
    assert plan.index("Window") < plan.index("TakeOrderedAndProject")


def test_delay_by_hub(star):
    orders = [
        (1, 1, "2020-01-01", "2020-01-02", 1), (2, 1, "2020-01-01", "2020-01-01", 1),
        (3, 1, "2020-01-01", None, None), (4, 1, "2020-01-03", "2020-01-01", 1),
        (5, 2, "2020-01-03", "2020-01-01", 1), (6, 99, "2020-01-01", "2020-01-02", 1),
    ]
    assert values(analytics.po_delay_by_hub(star(orders=orders)), "*") == [
        ("K", 4, 1, 25.0), ("S", 1, 0, 0.0),
    ]


def test_master_join_fans_out_and_keeps_sales_without_stock(star):
    sales = [
        (1, "2020-01-01", 1, 1, 10), (1, "2020-01-02", 1, 2, 20), (2, "2020-01-01", 1, 3, 30),
        (9, "2020-01-01", 1, 4, 40), (1, None, 1, 5, 50),
    ]
    stock = [(1, 1, "2020-01-01", 7), (2, 1, "2020-01-01", 8), (3, 2, "2020-02-01", 9)]
    s = star(sales, stock)
    rows = values(analytics.master_join_all(s), "quantity", "stock_on_hand")
    assert sorted(rows, key=str) == [(1, 7), (1, 8), (2, None), (3, None)]
    first = values(analytics.master_join(s, 3), "quantity", "stock_on_hand")
    assert first == [(1, 7), (1, 8), (3, None)]
    assert values(analytics.master_join(s, 1), "quantity", "stock_on_hand") == [(1, 7)]


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_master_join_goes_on_until_enough_sales_are_known(star, n):
    """The first days' sales have no known product, so that more months are needed."""
    sales = [(99, f"2020-0{m}-0{d}", 1, 1, 10) for m in (1, 2, 3) for d in range(1, 9)]
    sales += [(1, "2020-04-01", 1, 7, 20), (2, "2020-04-02", 1, 8, 20), (1, "2020-05-01", 77, 9, 1)]
    stock = [(i, 1, "2020-04-01", i) for i in range(60)]
    s = star(sales, stock)
    want = [(7, i) for i in range(60)] + [(8, None)]
    assert values(analytics.master_join(s, n), "quantity", "stock_on_hand") == want[:n]
    assert analytics.first_sales(s, n).count() == min(n, 2)


def test_master_join_reads_few_folders_and_moves_no_sales(spark, sf_dir, monkeypatch):
    from checks import queries

    s = queries._star(spark, sf_dir)
    want = values(analytics.master_join(s), "*")
    plans, written = [], analytics._written

    def seen(df, name):
        plans.append((name, plan_of(df)))
        return written(df, name)

    monkeypatch.setattr(analytics, "_written", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = analytics.master_join(s, 20)
        last = plan_of(got)
        assert values(got, "*") == want[:20]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    cut = [p for name, p in plans if name == "first-sales"]
    months = s["fact_sales"].select("sale_month").distinct().count()
    for p in cut:
        assert "TakeOrderedAndProject" in p and "Exchange" not in p
        chosen = re.search(r"PartitionFilters: \[.*?sale_month#\d+ (?:IN \((.*?)\)|= \S+)", p)
        assert chosen and len((chosen[1] or "one").split(",")) < months / 2
    assert "WindowGroupLimit" in last  # events of a product's day are cut before they are moved


OPEX = [
    ("2020-01-01", "Salary-Permanent", 10, 3), ("2020-01-01", "Salary-Seasonal", 5, 1),
    ("2020-01-01", "Rent", 7, None), ("2020-02-01", "Salary-Permanent", 10, 0),
    ("2020-03-01", "Salary-Permanent", 10, 5),
]


def test_revenue_per_employee(star):
    s = star([(1, "2020-01-05", 1, 1, 90), (1, "2020-02-05", 1, 1, 100)], opex=OPEX)
    assert values(analytics.revenue_per_employee(s), "*") == [
        ("2020-01-01", 90, 4, 23), ("2020-02-01", 100, 0, None),
    ]


def test_operating_margin(star):
    sales = [(1, "2020-01-05", 1, 2, 90), (2, "2020-01-06", 1, 1, 10), (9, "2020-01-06", 1, 1, 99)]
    s = star(sales, opex=OPEX)
    assert values(analytics.operating_margin(s), "*") == [
        ("2020-01-01", 100, 11, 89, 22, 67, 67.0),
    ]


def test_findings(star):
    sales = [
        (1, "2018-11-05", 1, 2, 90), (1, "2018-07-05", 1, 2, 20), (1, "2022-11-05", 1, 1, 60),
        (1, "2022-07-05", 1, 1, 20),
    ]
    opex = [(f"{y}-{m}-01", "Salary-Permanent", 1, 7 if m == "11" else 3)
            for y in (2018, 2022) for m in ("07", "11")]
    orders = [(i, 2, None, None, d) for i, d in enumerate((1, 4, 4, 9))]
    s = star(sales, opex=opex, orders=orders)
    months = findings.tamil_month_profile(s).where("year = 2018").orderBy("tamil_month")
    assert values(months, "tamil_month", "revenue", "avg_discount_pct", "is_lowest") == [
        ("M07", 20, 10, True), ("M11", 90, 10, False),
    ]
    festivals = findings.festival_months(s).orderBy("year")
    assert values(festivals, "year", "festival_name", "revenue", "is_biggest") == [
        (2018, "Deepavali", 90, True), (2022, "Deepavali", 60, True),
    ]
    lead = findings.lead_time_range(s).where("manufacturing_hub = 'S'")
    assert values(lead, "min_lead_days", "max_lead_days", "avg_lead_days", "avg_delivery_days",
                  "median_delivery_days") == [(10, 30, 20, 4.5, 4)]
    surge = values(findings.surge_ratio(s, Rules()), "*")
    assert surge == [(2, 2, pytest.approx(7 / 3, abs=1e-6), 3.75, pytest.approx(45 / 28, abs=1e-6))]
    assert values(findings.period_compare(s, Rules()), "*") == [
        (110, 80, 110, 80, pytest.approx(8 / 11, abs=1e-6))
    ]


def test_surge_without_festival(star):
    s = star([(1, "2018-07-05", 1, 2, 20)], opex=[("2018-07-01", "Salary-Permanent", 1, 3)])
    assert values(findings.surge_ratio(s, Rules()), "surge_months", "headcount_ratio") == [
        (0, None)
    ]


@pytest.mark.parametrize("bucket", [1, 7, 100, 1_000_000])
def test_overall_quantile_matches_numpy(spark, bucket):
    import numpy as np

    numbers = [((i * 7919) % 1013) - 300 for i in range(777)] + [5] * 500
    df = spark.createDataFrame([(n,) for n in [*numbers, None]], "v bigint")
    for fraction in (0.0, 0.25, 0.5, 0.95, 0.99, 1.0):
        found = overall_quantile(df, "v", fraction, "q", bucket).first()["q"]
        assert found == pytest.approx(np.quantile(numbers, fraction), rel=1e-12)


def test_overall_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v bigint")
    assert overall_quantile(df, "v", 0.95, "q").first()["q"] is None


def test_grouped_quantiles_match_numpy(spark):
    import numpy as np

    rows = [(g, (i * 7919) % 101) for g in (None, "a", "b") for i in range(50 + len(g or ""))]
    df = spark.createDataFrame([*rows, ("c", None)], "g string, v int")
    found = grouped_quantiles(df, ["g"], "v", {"low": 0.25, "high": 0.99}).collect()
    assert {r["g"] for r in found} == {None, "a", "b"}
    for r in found:
        numbers = [v for g, v in rows if g == r["g"]]
        assert r["low"] == pytest.approx(np.quantile(numbers, 0.25), rel=1e-12)
        assert r["high"] == np.quantile(numbers, 0.99)
