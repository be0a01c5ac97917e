"""Operators against plain Python on random data with hot and missing keys."""

import datetime
import random
from decimal import Decimal

import numpy as np
import pytest

from ledgerloom.operators import reconcile, routing, sales, stock, structuring
from ledgerloom.rules import Rules

START = datetime.date(2020, 1, 1)


def day(n):
    return None if n is None else START + datetime.timedelta(days=n)


def plain_spikes(events):
    """{event id: level} after taking back isolated spikes, one product at a time."""
    result = {}
    by_product = {}
    for e in events:
        by_product.setdefault(e[2], []).append(e)
    for group in by_product.values():
        group.sort(key=lambda e: (e[1] is None, e[1] or START, e[0]))
        errors = [None]
        for before, now in zip(group, group[1:], strict=False):
            known = None not in (before[5], now[5], now[4])
            errors.append(now[5] - before[5] - now[4] if known else None)
        for i, e in enumerate(group):
            after = errors[i + 1] if i + 1 < len(group) else None
            spike = (
                e[3] != "Stockout"
                and errors[i] is not None
                and 20 <= errors[i] <= 80
                and (after is None or -100 <= after <= -20)
            )
            result[e[0]] = e[5] - errors[i] if spike else e[5]
    return result


@pytest.mark.parametrize("block_rows", [None, 10**9, 40, 5, 1, 0])
def test_stock_spikes(spark, block_rows):
    rng = random.Random(7)
    events = []
    for i in range(3000):
        product = rng.choice(["hot"] * 3 + [None] + [f"p{n}" for n in range(40)])
        date = rng.choice([None, *range(30)])
        level = rng.choice([None, *[Decimal(n * 10) for n in range(12)]])
        change = rng.choice([None, Decimal(-10), Decimal(0), Decimal(5)])
        kind = rng.choice(["Sale", "Stockout", None])
        events.append((i, day(date), product, kind, change, level))
    df = spark.createDataFrame(
        events,
        "stock_event_id bigint, date_id date, product_id string, event_type string, "
        "quantity_change decimal(18,2), stock_on_hand decimal(18,2)",
    )
    fixed = stock.repair_spikes(df, Rules(), block_rows).collect()
    expected = plain_spikes(events)
    assert {r["stock_event_id"]: r["stock_on_hand"] for r in fixed} == expected
    changed = {e[0] for e in events if e[5] != expected[e[0]]}
    assert len(changed) > 50
    assert {r["stock_event_id"] for r in fixed if r["fixed_level"]} >= changed


def test_quantity_caps(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice(["hot"] * 30 + [None] + [f"p{n}" for n in range(60)]),
         rng.choice([None] + [rng.randint(-9, 60)] * 20 + [rng.randint(0, 6000)]))
        for _ in range(8000)
    ]
    df = spark.createDataFrame(rows, "product_id string, quantity int")
    found = {r[0]: (r[1], r[2]) for r in sales.quantity_caps(df, Rules()).collect()}
    groups = {}
    for product, quantity in rows:
        if quantity is not None:
            groups.setdefault(product, []).append(quantity)
    expected = {p: np.quantile(q, 0.99) for p, q in groups.items()}
    assert found == {p: (limit, int(limit)) for p, limit in expected.items()}


def plain_reason(line, employees, stores, promotions, rules):
    """One rule after another, each on what the rules before it have left."""
    employee, store, known, date, promotion = line
    if employee not in employees and employee != -1:
        return routing.ORPHAN_EMPLOYEE
    if store not in stores:
        return routing.ORPHAN_STORE
    if not known:
        return routing.ORPHAN_PRODUCT
    if date is not None and date >= rules.leakage_cutoff:
        return routing.FUTURE_DATE
    if employees.get(employee) == "Stock/Godown Staff":
        return routing.GODOWN_BILLING
    start, end = promotions.get(promotion, (None, None))
    if date is not None and ((start and date < start) or (end and date > end)):
        return routing.PROMO_WINDOW
    return None


def test_routing(spark):
    rng = random.Random(3)
    rules = Rules(leakage_cutoff=day(40))
    employees = {n: rng.choice(["Cashier", "Stock/Godown Staff", None]) for n in range(8)}
    promotions = {
        n: (day(rng.choice([None, 5, 10])), day(rng.choice([None, 20, 30]))) for n in range(6)
    }
    lines = [
        (rng.choice([-1, 99, *range(8)]), rng.choice([None, 77, 1, 2, 3, 3, 3, 3]),
         rng.random() < 0.9, day(rng.choice([None, *range(45)])),
         rng.choice([None, 55, *range(6)]))
        for _ in range(4000)
    ]
    df = spark.createDataFrame(
        [(i, *line) for i, line in enumerate(lines)],
        "id int, employee_id bigint, store_id bigint, in_master boolean, date_id date, "
        "promotion_id bigint",
    )
    lookups = routing.lookups(
        spark.createDataFrame(list(employees.items()), "employee_id bigint, role string"),
        spark.createDataFrame([(1,), (2,), (3,), (None,)], "store_id bigint"),
        spark.createDataFrame(
            [(n, *dates) for n, dates in promotions.items()],
            "promotion_id bigint, start_date date, end_date date",
        ),
    )
    found = {r["id"]: r["quarantine_reason"] for r in routing.route(df, lookups, rules).collect()}
    expected = {
        i: plain_reason(line, employees, {1, 2, 3}, promotions, rules)
        for i, line in enumerate(lines)
    }
    assert found == expected
    assert len(set(expected.values())) == 7


def test_headcount(spark):
    rng = random.Random(5)
    joined = [day(rng.choice([None, *range(800)])) for _ in range(200)]
    opex = [
        (i, day(rng.choice([None, *range(900)])), rng.choice([None, *map(Decimal, range(200))]))
        for i in range(300)
    ]
    opex = [(i, d and d.replace(day=1), n) for i, d, n in opex]
    found = reconcile.headcount_drift(
        spark.createDataFrame(opex, "id int, month date, headcount decimal(18,2)"),
        spark.createDataFrame([(d,) for d in joined], "join_date date"),
    ).collect()
    expected = {}
    for i, month, headcount in opex:
        active = sum(1 for d in joined if d and month and d.replace(day=1) <= month)
        if headcount is not None and headcount != active:
            expected[i] = active
    assert {r["id"]: r["active_staff"] for r in found} == expected


def test_distinct_rows_and_grain(spark):
    rng = random.Random(13)
    rows = [
        (rng.choice(["T0"] * 50 + [f"T{n}" for n in range(100)]), rng.choice(["p", "q", None]),
         rng.choice([None, 1, 2]))
        for _ in range(5000)
    ]
    df = spark.createDataFrame(rows, "transaction_id string, product_id string, quantity int")
    distinct = structuring.distinct_rows(df)
    assert {(r[0], r[1], r[2]): r[3] for r in distinct.collect()} == {
        row: rows.count(row) for row in set(rows)
    }
    grains = [row[:2] for row in rows]
    assert structuring.grain_check(distinct).first()[0] == sum(
        n for n in (grains.count(g) for g in set(grains)) if n > 1
    )
