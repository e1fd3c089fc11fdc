"""Purchase and web rules against plain Python, one member holding a third of the rows."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest

from visitry.segments import SegmentContext, predicate, rule

FIRST, LAST = date(2024, 1, 10), date(2024, 3, 1)
RANGE = {"start_time": str(FIRST), "end_time": str(LAST)}


@pytest.fixture(scope="module")
def world(spark):
    random.seed(11)
    lines = []
    for n in range(1500):
        member = 1 if n % 3 == 0 else random.choice([None, *range(2, 40)])
        lines.append(
            (
                member, random.randrange(400), f"p{random.randrange(12)}",
                date(2024, 1, 1) + timedelta(days=random.randrange(90)), random.randrange(2),
                Decimal(random.randrange(-200, 90000)) / 100,
            )
        )
    # p1 is listed twice, p2 has no brand
    brand = [(f"p{i}", f"name{i % 5}", f"kind{i % 2}", None if i == 2 else f"b{i % 3}") for i in [*range(12), 1]]
    tables = {
        "purchase": spark.createDataFrame(
            lines, "member_id int, order_id int, product_id string, date date, online int, sales decimal(18,4)"
        ),
        "brand": spark.createDataFrame(
            brand, "product_id string, product_name string, category_name string, brand_name string"
        ),
    }
    return SegmentContext(tables.__getitem__, LAST), lines, brand


def inside(lines, online, products=None):
    return [
        r for r in lines
        if r[0] is not None and r[4] in online and FIRST <= r[3] <= LAST and (products is None or r[2] in products)
    ]


def by_order(lines):
    orders = defaultdict(lambda: defaultdict(list))
    for r in lines:
        orders[r[0]][r[1]].append(r[5])
    return orders


def got(world, tag, value=(), web="整體", count=None, cost=None):
    more = {"time_range": RANGE, "count": count or {}, "cost": cost or {}}
    return {int(r[0]) for r in predicate(world[0], rule("消費行為", tag, value, web, more)).collect()}


def test_buyers(world):
    for web, online in [("整體", (0, 1)), ("線上", (1,)), ("線下", (0,))]:
        want = {
            m for m, orders in by_order(inside(world[1], online)).items()
            if len(orders) >= 4 and all(sum(v) >= -100 for v in orders.values())
        }
        cost = {"moreOrlessForCost": "大於", "cost": -100}
        assert got(world, "有購買的人", (), web, {"count": 4, "moreOrless": "以上(含)"}, cost) == want


def test_products(world):
    for tag, column, values in [
        ("購買的商品名稱", 1, ["name1", "name3"]), ("購買的類別名稱", 2, ["kind0"]), ("購買的品牌名稱", 3, ["b1", "b2"]),
    ]:
        products = {b[0] for b in world[2] if b[column] in values}
        want = {
            m for m, orders in by_order(inside(world[1], (0, 1), products)).items()
            if len(orders) <= 9 and all(s >= 2 for v in orders.values() for s in v)
        }
        cost = {"moreOrlessForCost": "大於", "cost": 2}
        assert want and got(world, tag, values, "整體", {"count": 9, "moreOrless": "以下(含)"}, cost) == want


def test_amounts(world):
    orders = by_order(inside(world[1], (1,)))
    total = {m: sum(s for v in o.values() for s in v) for m, o in orders.items()}
    value = {"moreOrless": "大於", "low": 500, "high": 6000}
    assert got(world, "累計消費金額", value, "線上") == {m for m, x in total.items() if 500 <= x <= 6000}
    assert got(world, "平均客單價", {"moreOrless": "小於", "cost": 450}, "線上") == {
        m for m, x in total.items() if x / len(orders[m]) <= 450
    }
    assert got(world, "累計消費次數", {"moreOrless": "大於", "cost": 8}, "線上") == {
        m for m in total if len(orders[m]) >= 8
    }
    # without limits: anything above zero
    assert got(world, "累計消費金額", {}, "線上") == {m for m, x in total.items() if x > 0}


def test_recency(world):
    last: dict = {}
    for r in world[1]:
        if r[0] is not None and r[4] == 0:
            last[r[0]] = max(last.get(r[0], r[3]), r[3])
    found = {
        int(r[0])
        for r in predicate(world[0], rule("消費行為", "距離上次購買天數區隔", {"low": -20, "high": 0}, "線下")).collect()
    }
    assert found == {m for m, d in last.items() if -20 <= (LAST - d).days <= 0}
