from decimal import Decimal

import pytest
from conftest import column, plan_of, values

from ledgerloom.operators import sales, stock, structuring, tables
from ledgerloom.rules import Rules
from pyspark.sql import functions as F

SALE = (
    "id int; product_id string; quantity int; unit_price decimal(18,2); discount_pct decimal(7,2);"
    "gross_amount decimal(18,2); net_amount decimal(18,2); payment_mode string; employee_id bigint"
)


@pytest.fixture
def sale(table):
    def make(*rows):
        blank = {
            "product_id": "p", "quantity": 1, "unit_price": 10, "discount_pct": 0,
            "gross_amount": 10, "net_amount": 10, "payment_mode": "Cash", "employee_id": 1,
        }
        return table(SALE, [(i, *{**blank, **row}.values()) for i, row in enumerate(rows)])

    return make


@pytest.fixture
def product(table):
    def make(*rows):
        return table(
            "product_id string; unit_price decimal(18,2); unit_cost decimal(18,2)", list(rows)
        )

    return make


def carded(lines, product, rules):
    return sales.with_card(lines, sales.product_card(lines, product, rules))


def test_gaps_and_modes(sale, rules):
    modes = [None, " cash\t", "CARD", "upi", "Cash", " unknown", "Cheque"]
    df = sales.fill_gaps(sale(*[{"payment_mode": m} for m in modes]), rules)
    assert column(df, "payment_mode") == [
        "Unknown", "Cash", "Card", "UPI", "Cash", " unknown", "Cheque",
    ]
    assert sum(column(df, "fixed_mode")) == 3


def test_sentinel(sale, rules):
    df = sales.fill_gaps(sale({"employee_id": None}, {"employee_id": 5}), rules)
    assert column(df, "employee_id") == [-1, 5]


def test_price_glitch(sale, product, rules):
    lines = sale(
        {"unit_price": "4.99"}, {"unit_price": "5.00"}, {"unit_price": None},
        {"unit_price": 1, "product_id": "unknown"}, {"unit_price": 1, "product_id": None},
    )
    df = sales.repair_price(carded(lines, product(("p", 100, 50)), rules), rules)
    assert column(df, "unit_price") == [100, 5, None, 1, 1]
    assert column(df, "fixed_price") == [True, False, False, False, False]
    assert column(df, "in_master") == [True, True, True, False, False]


def test_quantity_cap(sale, product, rules):
    groups = {"a": [1, 2, 3, 4, 500], "b": [-5, -4, -3], "c": [None, None], None: [1, 1, 9]}
    lines = sale(*[{"product_id": p, "quantity": q} for p, qs in groups.items() for q in qs])
    df = sales.cap_quantity(carded(lines, product(("a", 1, 1)), rules))
    assert column(df, "quantity") == [1, 2, 3, 4, 480, -5, -4, -3, None, None, 1, 1, 8]
    assert column(df, "fixed_quantity") == [
        *[False] * 4, True, False, False, True, False, False, False, False, True,
    ]


def test_duplicate_master_rows_do_not_double_sales(sale, product, rules):
    df = carded(sale({}, {}), product(("p", 100, 50), ("p", 90, 50)), rules)
    assert df.count() == 2


def test_discount_is_clipped(sale):
    df = sales.clip_discount(
        sale(*[{"discount_pct": d} for d in (-5, 0, 120, None, "12.50")])
    )
    assert column(df, "discount_pct") == [0, 0, 100, None, 12.5]


def test_amounts(sale, rules):
    lines = sale(
        {"quantity": 3, "discount_pct": 10, "gross_amount": 40, "net_amount": 40},
        {"gross_amount": "10.01", "net_amount": "10.01"},
        {"gross_amount": None, "net_amount": None},
        {"quantity": None, "gross_amount": 7, "net_amount": 7},
        {"unit_price": "0.25", "gross_amount": "0.25", "discount_pct": 50, "net_amount": 9},
        {"unit_price": "0.75", "gross_amount": "0.75", "discount_pct": 50, "net_amount": 9},
    )
    df = sales.repair_net(sales.repair_gross(lines, rules), rules)
    assert column(df, "gross_amount") == [30, 10.01, None, 7, 0.25, 0.75]
    # half a cent goes to the even cent
    assert column(df, "net_amount") == [27, 10.01, None, 7, 0.12, 0.38]
    assert column(df, "fixed_gross") == [True, False, False, False, False, False]
    assert column(df, "fixed_net") == [True, False, False, False, True, True]


def test_absurd_amounts_do_not_stop_the_job(sale, product, rules):
    lines = sale({"unit_price": "9999999999999999.99", "quantity": 2_000_000_000})
    card = sales.product_card(lines, product(("p", "9999999999999999.99", 1)), rules)
    df = sales.clean_sales(lines, card, rules)
    assert values(df, "gross_amount", "fixed_gross") == [(pytest.approx(2e25), True)]


def test_margin_and_flags(sale, product, rules):
    lines = sale(
        {"quantity": 3, "unit_price": 10, "gross_amount": 30, "net_amount": 27, "discount_pct": 10},
        {"product_id": "unknown"},
    )
    df = sales.add_margin(carded(lines, product(("p", 10, 7)), rules))
    assert column(df, "gross_margin") == [6, None]
    bulk = sales.flag_wholesale(
        sale(*[{"quantity": q} for q in (49, 50, -50, None)]), rules
    )
    assert column(bulk, "is_wholesale_bulk") == [False, True, False, False]


def test_high_value(sale, rules):
    lines = sale(*[{"net_amount": n} for n in [*range(1, 101), None]])
    limit = sales.high_value_limit(lines, rules)
    assert values(limit, "limit_cents") == [(pytest.approx(9505),)]
    flagged = sales.flag_high_value(lines, limit)
    assert column(flagged.where("is_high_value"), "net_amount") == [96, 97, 98, 99, 100]


def test_brands(table, rules):
    df = table("id int; brand_name string", list(enumerate([" rcm ", "CO-OPTEX", "Rcm", None])))
    fixed = tables.fix_brands(df, rules)
    assert column(fixed, "brand_name") == ["RCM", "Co-optex", "Rcm", None]
    assert column(fixed, "fixed_brand") == [True, True, False, False]


def test_cost_and_gst(table, rules):
    df = table(
        "id int; unit_cost decimal(18,2); unit_price decimal(18,2); gst_rate decimal(18,2)",
        [(0, 12, 10, 5), (1, 10, 10, "7.5"), (2, None, 10, None), (3, 9, "0.35", 28)],
    )
    fixed = tables.repair_gst(tables.repair_cost(df, rules), rules)
    assert column(fixed, "unit_cost") == [7, 10, None, 0.24]
    assert column(fixed, "gst_rate") == [5, 18, 18, 28]


def test_salary_cap(table, rules):
    rows = [*[("a", s) for s in (1, 2, 3, 4, 100)], (None, 9), ("b", None)]
    df = table(
        "id int; role string; monthly_salary decimal(18,2)",
        [(i, *row) for i, row in enumerate(rows)],
    )
    fixed = tables.cap_salary(df, rules)
    assert column(fixed, "monthly_salary") == [1, 2, 3, 4, 7, 9, None]
    assert column(fixed, "fixed_salary") == [*[False] * 4, True, False, False]


def test_salary_line(table):
    df = table(
        "role string; monthly_salary decimal(18,2)", [("a", s) for s in (1, 2, 3, 4, 100)]
    )
    report = tables.salary_line_report(df, Rules(salary_line=5))
    assert values(report, "n_above_before", "n_above_after", "n_capped") == [(1, 1, 1)]


def test_join_date(table, rules):
    df = table(
        "id int; join_date date", list(enumerate(["2024-01-01", "2023-12-31", None]))
    )
    assert column(tables.repair_join_date(df, rules), "join_date") == [
        "2023-01-01", "2023-12-31", None,
    ]


def test_promotions(table):
    df = table(
        "id int; start_date date; end_date date; discount_pct decimal(18,2)",
        [(0, "2020-02-01", "2020-01-01", -5), (1, "2020-02-01", None, 120), (2, None, None, None)],
    )
    fixed = tables.clean_promotion(df)
    assert values(fixed.orderBy("id"), "start_date", "end_date", "discount_pct") == [
        ("2020-01-01", "2020-02-01", 0), ("2020-02-01", None, 100), (None, None, None),
    ]
    assert column(fixed, "fixed_discount") == [True, True, False]


def test_purchase_orders(table):
    df = table(
        "id int; quantity_ordered decimal(18,2); quantity_received decimal(18,2);"
        "order_date date; actual_delivery_date date",
        [(0, 10, 12, "2020-02-01", "2020-01-01"), (1, None, 12, "2020-02-01", None)],
    )
    fixed = tables.clean_purchase_order(df).orderBy("id")
    assert values(fixed, "quantity_received", "order_date", "days_to_deliver") == [
        (10, "2020-01-01", 31), (12, "2020-02-01", None),
    ]


def test_settlement_modes(table, rules):
    df = table("id int; payment_mode string", list(enumerate([" upi", "CASH", "wallet", None])))
    assert column(tables.clean_settlement(df, rules), "payment_mode") == [
        "UPI", "Cash", "Wallet", None,
    ]


STOCK = (
    "stock_event_id bigint; date_id date; product_id string; event_type string;"
    "quantity_change decimal(18,2); stock_on_hand decimal(18,2)"
)


def events(levels, changes, kinds=None, product="p", first=1):
    kinds = kinds or ["Sale"] * len(levels)
    return [
        (first + i, f"2020-01-{1 + i // 2:02d}", product, kind, change, level)
        for i, (level, change, kind) in enumerate(zip(levels, changes, kinds, strict=True))
    ]


def test_stock_spikes(table, rules):
    rows = [
        *events([100, 95, 140, 85], [0, -5, -5, -5]),
        *events([100, 95, 140, 85], [0, -5, -5, -5], ["Sale", "Sale", "Stockout", None], "q", 11),
        *events([100, 125], [0, -5], product="r", first=21),
        *events([100, 125], [0, -5], [None, None], product="s", first=31),
    ]
    fixed = stock.repair_spikes(table(STOCK, rows), rules)
    assert column(fixed, "stock_on_hand", "stock_event_id") == [
        100, 95, 90, 85, 100, 95, 140, 85, 100, 95, 100, 95,
    ]


@pytest.mark.parametrize("block_rows", [0, 3, 10])
def test_stock_spikes_of_heavy_products(spark, sf_dir, block_rows):
    """Day by day with neighbours across days gives what one ordered pass gives."""
    from checks import queries

    events_in = queries.typed(spark, sf_dir)["fact_stock"]
    whole = stock.repair_spikes(events_in, Rules())
    split = stock.repair_spikes(events_in, Rules(), block_rows)
    assert whole.where("fixed_level").count() > 100
    assert split.count() == whole.count()
    assert split.exceptAll(whole).count() == 0


def test_heavy_product_with_missing_dates(table, rules):
    rows = [
        (1, "2020-01-01", "p", "Sale", 0, 100), (2, "2020-01-02", "p", "Sale", -5, 140),
        (3, None, "p", "Sale", -5, 90), (4, None, "p", "Sale", -5, 130),
        (5, None, None, "Sale", -5, 130), (6, None, None, "Sale", -5, 170),
    ]
    df = table(STOCK, rows)
    whole = stock.repair_spikes(df, rules)
    split = stock.repair_spikes(df, Rules(), 1)
    assert column(whole, "stock_on_hand", "stock_event_id") == [100, 95, 90, 85, 130, 125]
    assert split.exceptAll(whole).count() == 0


def test_cleaning_twice_changes_nothing_more(table, sale, rules):
    product = table(
        "product_id string; brand_name string; unit_cost decimal(18,2); unit_price decimal(18,2);"
        "gst_rate decimal(18,2)",
        [("p", " rcm", 12, 10, "7.5")],
    )
    once = tables.clean_product(product, rules).select(product.columns)
    again = tables.clean_product(once, rules)
    assert once.exceptAll(again.select(product.columns)).count() == 0
    assert again.where("fixed_brand or fixed_cost or fixed_gst").count() == 0

    lines = sale({"payment_mode": " upi", "discount_pct": 120, "gross_amount": 50, "quantity": 4})

    def repaired(df):
        df = sales.clip_discount(sales.fill_gaps(df, rules))
        return sales.repair_net(sales.repair_gross(df, rules), rules)

    first = repaired(lines)
    second = repaired(first.select(lines.columns))
    assert second.where("fixed_mode or fixed_gross or fixed_net").count() == 0
    assert first.select(lines.columns).exceptAll(second.select(lines.columns)).count() == 0


def test_repairs_feed_later_repairs(sale, product, rules):
    """A repaired price and quantity change the amounts and the margin."""
    lines = sale(
        {"unit_price": "1.00", "quantity": 2, "gross_amount": 2, "net_amount": 2},
    )
    rows = structuring.distinct_rows(lines)
    card = sales.product_card(rows, product(("p", 100, 60)), rules)
    df = sales.clean_sales(rows, card, rules)
    assert values(df, "unit_price", "gross_amount", "net_amount", "gross_margin") == [
        (100, 200, 200, 80)
    ]
    assert isinstance(df.first()["gross_margin"], Decimal)


def test_stock_is_shuffled_once_unless_a_product_is_heavy(spark, sf_dir, rules):
    from checks import queries

    df = queries.published(spark, sf_dir).working("fact_stock")
    assert stock._block_rows(df) is None
    plan = plan_of(stock.repair_spikes(df, rules))
    assert plan.count("Exchange ") == 1 and plan.count("FileScan") == 1
    assert "Broadcast" not in plan
    hot = df.withColumn("product_id", F.when(F.col("stock_event_id") % 3 < 2, "hot").otherwise(F.col("product_id")))
    assert stock._block_rows(hot) is not None
    whole = stock.repair_spikes(hot, rules, 10**12)
    assert stock.repair_spikes(hot, rules).exceptAll(whole).count() == 0
    assert whole.where("fixed_level").count() > 0
