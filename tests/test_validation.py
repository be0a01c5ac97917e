import pytest
from conftest import column, values

from ledgerloom.operators import assertions, audits, reconcile, routing, star
from ledgerloom.rules import (
    FUTURE_DATE,
    GODOWN_BILLING,
    ORPHAN_EMPLOYEE,
    ORPHAN_PRODUCT,
    ORPHAN_STORE,
    PROMO_WINDOW,
)
from ledgerloom.schemas import STAR
from pyspark.sql import functions as F
from pyspark.sql import types as T


@pytest.fixture
def dims(table):
    employee = table(
        "employee_id bigint; role string",
        [(1, "Sales Staff"), (2, "Stock/Godown Staff"), (3, None), (3, "Manager"), (None, "x")],
    )
    store = table("store_id bigint", [(1,), (1,), (None,)])
    promotion = table(
        "promotion_id bigint; start_date date; end_date date",
        [(7, "2020-01-10", "2020-01-20"), (8, None, "2020-01-20")],
    )
    return employee, store, promotion


@pytest.fixture
def routed(table, dims, rules):
    def make(*rows):
        blank = {
            "employee_id": 1, "store_id": 1, "in_master": True, "date_id": "2020-01-15",
            "promotion_id": None,
        }
        lines = table(
            "id int; employee_id bigint; store_id bigint; in_master boolean; date_id date;"
            "promotion_id bigint",
            [(i, *{**blank, **row}.values()) for i, row in enumerate(rows)],
        )
        return routing.route(lines, routing.lookups(*dims), rules)

    return make


def test_reasons(routed):
    cases = [
        ({}, None),
        ({"employee_id": -1}, None),
        ({"employee_id": 999}, ORPHAN_EMPLOYEE),
        ({"employee_id": 3}, None),
        ({"store_id": 99}, ORPHAN_STORE),
        ({"store_id": None}, ORPHAN_STORE),
        ({"in_master": False}, ORPHAN_PRODUCT),
        ({"date_id": "2023-12-31"}, None),
        ({"date_id": "2024-01-01"}, FUTURE_DATE),
        ({"date_id": None}, None),
        ({"employee_id": 2}, GODOWN_BILLING),
        ({"promotion_id": 7, "date_id": "2020-01-10"}, None),
        ({"promotion_id": 7, "date_id": "2020-01-09"}, PROMO_WINDOW),
        ({"promotion_id": 7, "date_id": "2020-01-21"}, PROMO_WINDOW),
        ({"promotion_id": 8, "date_id": "2020-01-21"}, PROMO_WINDOW),
        ({"promotion_id": 99}, None),
        ({"promotion_id": 7, "date_id": None}, None),
        ({"employee_id": 999, "date_id": "2024-01-01"}, ORPHAN_EMPLOYEE),
        ({"store_id": 99, "in_master": False}, ORPHAN_STORE),
    ]
    found = routed(*[row for row, _ in cases])
    assert column(found, "quarantine_reason") == [reason for _, reason in cases]


def test_first_purchase(table, rules):
    customer = table(
        "customer_id bigint; first_purchase_date date",
        [(1, "2018-02-01"), (2, "2017-12-01"), (3, "2018-05-01"), (4, None)],
    )
    sales = table(
        "customer_id bigint; date_id date",
        [(1, "2018-01-01"), (1, "2019-01-01"), (2, "2018-01-01"), (4, "2018-01-01"), (None, None)],
    )
    fixed = reconcile.reconcile_first_purchase(customer, sales, rules)
    assert column(fixed, "first_purchase_date", "customer_id") == [
        "2018-01-01", "2017-12-01", "2018-05-01", None,
    ]
    assert column(fixed, "customer_tenure_days", "customer_id")[0] == 2190


MONEY = "date_id date; payment_mode string; {} decimal(18,2)"


def test_settlement_drift(table, rules):
    settled = [
        ("2020-01-01", "Cash", 100), ("2020-01-01", "Card", 100), ("2020-01-01", "UPI", 60),
        ("2020-01-01", "UPI", 40), ("2020-01-02", "Cash", "0.01"), (None, "Cash", 5),
    ]
    sold = [("2020-01-01", "Cash", "100.01"), ("2020-01-01", "Card", "100.02"),
            ("2020-01-03", "UPI", 9)]
    s = table(MONEY.format("gross_amount_settled"), settled)
    f = table(MONEY.format("net_amount"), sold)
    drift = reconcile.settlement_drift(s, f, rules)
    assert sorted(values(drift, "payment_mode", "settled", "sold")) == [
        ("Card", 100, 100.02), ("UPI", 100, None),
    ]
    assert values(reconcile.unsettled_sales(s, f), "*") == [("2020-01-03", "UPI", 9)]


def test_headcount_drift(table):
    employee = table("join_date date", [("2020-01-15",), ("2020-03-02",), (None,)])
    opex = table(
        "id int; month date; headcount decimal(18,2)",
        [(0, "2020-02-01", 1), (1, "2020-02-01", 2), (2, "2020-02-01", None), (3, None, 0),
         (4, None, 1), (5, "2020-03-01", 2), (6, "2019-12-01", 0), (7, "2021-01-01", 9)],
    )
    drift = reconcile.headcount_drift(opex, employee)
    assert values(drift.orderBy("id"), "id", "active_staff") == [(1, 1), (4, 0), (7, 2)]
    assert reconcile.headcount_drift(opex.drop("headcount"), employee).count() == 0


def test_final_conditions(table):
    lines = table(
        "id int; product_id bigint; quantity int; gross_amount decimal(18,2);"
        "net_amount decimal(18,2); discount_pct decimal(7,2)",
        [(0, 1, 1, 10, 10, 0), (1, 1, 1, 10, 11, 0), (2, 1, -1, -10, -11, 0),
         (3, 1, -1, -10, -9, 5), (4, 1, 1, 10, None, 0), (5, 2, 1, 10, 9, None),
         (6, None, None, 10, 11, 101)],
    )
    product = table("product_id bigint", [(1,)])
    assert column(assertions.net_above_gross(lines), "id") == [1, 4]
    assert column(assertions.net_below_gross_on_return(lines), "id") == [2]
    assert column(assertions.discount_out_of_range(lines), "id") == [5, 6]
    assert column(assertions.unknown_product(lines, product), "id") == [5, 6]
    report = assertions.integrity_report(lines, product)
    assert dict(values(report, "*")) == {
        "net_le_gross": 2, "returns": 1, "discount_range": 2, "product_fk": 2,
    }
    with pytest.raises(assertions.IntegrityError, match="returns"):
        assertions.require_integrity(report)
    assertions.require_integrity(assertions.integrity_report(lines.where("id = 0"), product))


def test_audits(table):
    dim = table("k bigint", [(1,), (1,), (None,), (2,)])
    assert sorted(values(audits.key_violations(dim, "k"), "*"), key=str) == [("1", 2), (None, 1)]
    child = table("r bigint", [(1,), (9,), (9,), (None,)])
    assert values(audits.orphans(child, "r", dim, "k"), "*") == [(9, 2)]
    required = audits.audit_required({"t": table("a int; b int", [(None, 1)])}, {"t": ("a", "b")})
    assert values(required, "*") == [("t", "a", 1), ("t", "b", 0)]
    wide = table(
        "store_id bigint; store_name string; store_type string; location string",
        [(1, "x" * 41, "y" * 20, None)],
    )
    found = audits.audit_widths({"dim_store": wide})
    assert dict(values(found, "column_name", "n_too_wide")) == {
        "store_name": 1, "store_type": 0, "location": 0,
    }
    numbers = table("a decimal(18,2)", [("99999999.99",), ("100000000",), ("-100000000",), (None,)])
    declared = STAR["dim_product"]["unit_cost"]
    counted = numbers.withColumnRenamed("a", "unit_cost").agg(
        F.count_if(audits._too_wide(declared)).alias("n")
    )
    assert values(counted, "n") == [(2,)]


def test_apply_schema_notes_what_does_not_fit(table):
    raw = table(
        "store_id string; store_name string; store_type string; location string",
        [("1", "a", "b", "c"), ("x", "a", "b", "c"), (None, "a", "b", "c")],
    )
    typed = star.apply_schema(raw, STAR["dim_store"])
    assert values(star.refused(typed), "store_id", star.REFUSED) == [(None, "store_id=x")]
    assert sorted(values(star.accepted(typed), "store_id"), key=str) == [(1,), (None,)]


def test_amount_beyond_declared_range_is_refused(table):
    df = table("amount decimal(18,2)", [("9999999999.99",), ("10000000000.00",)])
    typed = star.apply_schema(df, T.StructType([STAR["fact_opex"]["amount"]]))
    assert values(star.refused(typed), star.REFUSED) == [("amount=10000000000.00",)]
    assert star.accepted(typed).count() == 1


def test_sentinel_is_added_once(spark, rules):
    empty = spark.createDataFrame([], STAR["dim_employee"])
    once = star.add_sentinel_employee(empty, rules)
    twice = star.add_sentinel_employee(once, rules)
    assert values(twice, "employee_id", "role", "monthly_salary") == [(-1, "Unknown", None)]
    assert twice.schema == empty.schema
