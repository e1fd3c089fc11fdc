"""The index of rules against the labels one by one, and its plan at 400 and at 1,000 labels."""

import random
from decimal import Decimal

import pytest

from visitry.catalog.bindings import AS_OF_PURCHASE
from visitry.segments import label_membership, rule, segment_content
from visitry.segments.index import Tree, comparison, indexed_members

DAYS = {"start_time": "2024-01-03", "end_time": "2024-01-20"}


def some_rule(draw, other=True):
    period = {"time_range": {"start_time": f"199{draw.randrange(3, 8)}-0{draw.randrange(1, 9)}-01", "end_time": f"1998-0{draw.randrange(1, 9)}-01"}}
    channel = draw.choice(["線上", "線下", "整體"])
    amount = draw.choice([
        {"moreOrless": draw.choice(["大於", "小於", "-"]), "cost": draw.randrange(1, 300_000)},
        {"moreOrless": "-", "low": 1000.5, "high": draw.randrange(1000, 200_000)}, {},
    ])
    made = [
        lambda: rule("基本屬性", "年齡級距", {"low": draw.randrange(60), "high": draw.randrange(95)}),
        lambda: rule("基本屬性", "註冊日期", {"low": f"199{draw.randrange(6, 9)}-01-0{draw.randrange(1, 9)}", "high": "1999-06-30"}),
        lambda: rule("基本屬性", "城市", [f"NATION_{draw.randrange(25)}" for _ in range(draw.randrange(4))]),
        lambda: rule("基本屬性", "生日", [draw.randrange(1, 13) for _ in range(2)]),
        lambda: rule("AI顧客分群", "流失風險", [draw.choice("高中低")]),
        lambda: rule("價值分群", "價值分群", ["BUILDING"]),
        lambda: rule("消費行為", "消費金額分級", [draw.choice("高中低")]),
        lambda: rule("消費行為", draw.choice(["累計消費金額", "平均客單價"]), amount, channel, period),
        lambda: rule("消費行為", "累計消費次數", {"moreOrless": "以上(含)", "cost": draw.randrange(1, 6)}, channel, period),
        lambda: rule("消費行為", "有購買的人", [], channel, {**period, "count": {"moreOrless": draw.choice(["以上(含)", "-"]), "count": draw.randrange(1, 4)}, "cost": draw.choice([{}, {"moreOrlessForCost": "大於", "cost": draw.randrange(1, 20_000)}, {"moreOrlessForCost": "-", "lowCost": 10, "highCost": 90_000}])}),
        lambda: rule("渠道再行銷", draw.choice(["有寄出過", "有點擊過", "有開信過"]), web=draw.choice(["Email", "SMS"]), more={"time_range": draw.choice([DAYS, {"days": 30}, {}])}),
        lambda: rule("渠道再行銷", draw.choice(["可寄送名單", "互動評級"]), ["高"], draw.choice(["Email", "SMS"])),
    ]
    if other:
        made += [
            lambda: rule("渠道再行銷", "有點擊過", web="Email", more={"event": "r_"}),
            lambda: rule("網站行為", "有轉換過", [], "main", {"time_range": DAYS}),
            lambda: rule("基本屬性", "會員品牌歸屬", ["AFRICA"]),
            lambda: rule("消費行為", "首購的人", [], "整體", {}),
            lambda: rule("消費行為", "購買的品牌名稱", ["Brand#12"], "整體", {}),
        ]
    return draw.choice(made)()


def labels(n, seed, other=True):
    draw = random.Random(seed)
    out = {}
    for i in range(n):
        rules = [some_rule(draw, other) for _ in range(draw.randrange(1, 6))]
        out[f"C_{i}"] = [{**r, "mode": "初" if j == 0 else draw.choice(["或", "且", "忽略"])} for j, r in enumerate(rules)]
    return out


def by_label(df):
    got = {}
    for row in df.collect():
        assert row["member_id"] not in got.setdefault(row["labelId"], set())
        got[row["labelId"]].add(row["member_id"])
    return got


def test_equal_to_labels_one_by_one(tables):
    contents = {**labels(24, 7), "C_none": []}
    ctx = tables.context(AS_OF_PURCHASE, contents)
    got = by_label(label_membership(ctx, {k: k for k in contents}))
    for label, rules in contents.items():
        assert {r[0] for r in segment_content(ctx, rules).collect()} == got.get(label, set()), rules


def test_thousand_labels(tables):
    """All together as in three parts; the plan has as many lines as that of 400."""
    contents = labels(1000, 1, other=False)
    ctx = tables.context(AS_OF_PURCHASE, contents)
    every = label_membership(ctx, {k: k for k in contents})
    got = by_label(every)
    part = {}
    for i in range(3):
        part |= by_label(label_membership(ctx, {k: k for j, k in enumerate(contents) if j % 3 == i}))
    assert got == part

    def lines(df):
        return df._jdf.queryExecution().analyzed().toString().count("\n")

    few = label_membership(ctx, {k: k for k in list(contents)[:400]})
    assert lines(every) == lines(few)


def test_taking_away(tables):
    ctx = tables.context(AS_OF_PURCHASE)
    men, all_ages = rule("基本屬性", "性別", ["男"]), rule("基本屬性", "年齡級距", {"low": 0, "high": 200})
    got = by_label(indexed_members(ctx, {"a": [(all_ages, "or"), (men, "not")], "b": [(men, "or")]}))
    sides = {k: {r[0] for r in segment_content(ctx, [d]).collect()} for k, d in (("all", all_ages), ("men", men))}
    assert got == {"a": sides["all"] - sides["men"], "b": sides["men"]}


def test_no_labels_and_unknown_words(tables):
    ctx = tables.context(AS_OF_PURCHASE)
    assert indexed_members(ctx, {}).count() == 0 == indexed_members(ctx, {"a": []}).count()
    with pytest.raises(ValueError):
        indexed_members(ctx, {"a": [(rule("消費行為", "累計消費金額", {"moreOrless": "?"}, "整體"), "or")]})
    with pytest.raises(ValueError):
        indexed_members(ctx, {"a": [(rule("消費行為", "累計消費金額", {}, "?"), "or")]})


def test_tree_covers_ranges():
    draw = random.Random(2)
    ranges = [comparison("-", None, draw.randrange(40), draw.randrange(40)) for _ in range(30)] + [comparison(), (None, None), comparison("小於", 7)]
    tree = Tree(ranges)
    for x in range(-2, 43):
        place = sum(c <= (Decimal(x), 0) for c in tree.cuts)
        mine = {f"{level}:{place >> level}" for level in range(tree.levels + 1)}
        for low, high in ranges:
            inside = (low is None or low <= (Decimal(x), 0)) and (high is None or high > (Decimal(x), 0))
            nodes = tree.nodes((low, high))
            assert len(set(nodes)) == len(nodes) and len(mine & set(nodes)) == inside
