"""Laws that must hold on the driver tables, and model invariants."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from visitry.catalog import QUERIES
from visitry.catalog.segments import BUYERS, RULES
from visitry.segments import predicate, rule, segment_content, segment_include_exclude

SF_DIR = "/root/testdata/sf0.001"


def ids(df):
    found = [r[0] for r in df.collect()]
    assert len(found) == len(set(found)), "ids must be distinct"
    assert all(isinstance(x, str) for x in found)
    return set(found)


def test_known_counts(spark):
    """Counts measured independently on the same bindings."""
    assert QUERIES["dwell_time"](spark, SF_DIR).where("stay_time IS NOT NULL").count() == 555
    assert QUERIES["pur_none"](spark, SF_DIR).count() == 30
    assert QUERIES["join_scalar"](spark, SF_DIR).count() == 75
    assert QUERIES["rmk_rule_prefix"](spark, SF_DIR).count() == 13


def test_segment_algebra(tables):
    ctx = tables.context()
    level = rule("基本屬性", "會員等級", ["BUILDING"], mode="且")
    buyers, members = ids(predicate(ctx, BUYERS)), ids(predicate(ctx, level))
    both = ids(segment_content(ctx, [BUYERS, level]))
    assert both == buyers & members and both <= buyers
    either = ids(segment_content(ctx, [BUYERS, {**level, "mode": "或"}]))
    assert either == buyers | members
    assert ids(segment_content(ctx, [])) == set()
    assert ids(segment_content(ctx, [{**BUYERS, "mode": "?"}])) == set()


def test_excluded_last_never_returns(tables):
    ctx = tables.context(contents={"C_x": RULES})
    out = ids(segment_include_exclude(ctx, [("ALL", 1), ("U_3", 0)]))
    gone = {str(r.c_custkey + d) for r in tables("customer").where("c_nationkey = 3").collect() for d in (0, 2)}
    assert out and not out & gone
    assert ids(segment_include_exclude(ctx, [])) == set()
    assert ids(segment_include_exclude(ctx, [("ALL", 0), ("?", 1)])) == set()
    assert ids(segment_include_exclude(ctx, [("C_deleted", 1)])) == set()
    assert ids(segment_include_exclude(ctx, [("C_x", 1), ("C_deleted", 1)])) == ids(segment_content(ctx, RULES))


def test_buyers_and_non_buyers_are_disjoint(tables):
    ctx = tables.context()
    more = {"time_range": {"start_time": "2000-01-01", "end_time": "2001-08-02"}, "count": {}, "cost": {}}
    none = ids(predicate(ctx, rule("消費行為", "未購買的人", [], "整體", more)))
    some = ids(predicate(ctx, rule("消費行為", "有購買的人", [], "整體", more)))
    assert none and some and not none & some


def test_empty_value_lists_select_nothing(tables):
    ctx = tables.context()
    for kind, tag in [("基本屬性", "性別"), ("基本屬性", "會員品牌歸屬"), ("價值分群", "價值分群"), ("AI顧客分群", "流失風險")]:
        assert ids(predicate(ctx, rule(kind, tag, []))) == set()
    assert ids(predicate(ctx, rule("網站行為", "造訪商品名稱", [], "main"))) == set()


@pytest.mark.parametrize(
    "doc",
    [
        rule("nothing", "x"),
        rule("渠道再行銷", "可寄送名單", web="Email", more={"event": "r_1"}),
        rule("渠道再行銷", "有點擊過", web="Line"),
        rule("消費行為", "有購買的人", [], "天上"),
        rule("網站行為", "有造訪過網站", [], "other site"),
        rule("網站行為", "?", [], "main"),
        rule("CF站外瀏覽", "?", []),
    ],
)
def test_unknown_rules_are_errors(tables, doc):
    with pytest.raises(ValueError):
        predicate(tables.context(), doc)


def test_unknown_names_are_errors(tables):
    with pytest.raises(Exception, match="ATLANTIS"):
        predicate(tables.context(), rule("基本屬性", "會員品牌歸屬", ["ATLANTIS"])).collect()


def test_visitors_without_member_mapping(tables):
    """member=False gives visitor ids instead of mapped members."""
    from visitry.segments.online import off_site, on_site

    ctx = tables.context(date(2024, 1, 31))
    visitors = ids(on_site(ctx, "有造訪過網站", web="main", member=False).distinct())
    members = ids(on_site(ctx, "有造訪過網站", web="main").distinct())
    assert members <= visitors and len(visitors) == tables("events").select("user_id").distinct().count()
    assert ids(off_site(ctx, "興趣標籤", ["i1"], member=False).distinct())


def test_shares_sum_to_hundred(spark):
    for key, by in [("share_of_total", ["o_orderstatus"]), ("window_share", ["city"])]:
        column = "share" if key == "share_of_total" else "percent"
        sums = QUERIES[key](spark, SF_DIR).groupBy(*by).agg(F.sum(column).alias("s"))
        assert sums.where(F.abs(F.col("s") - 100) > 1e-9).count() == 0


def test_dwell_is_capped(spark):
    for key, cap in [("dwell_time", 60), ("dwell_time_6h", 21600), ("visit_event_etl_60s", 60), ("visit_event_etl_30s", 30)]:
        stays = QUERIES[key](spark, SF_DIR)
        assert stays.where((F.col("stay_time") > cap) | (F.col("stay_time") < 0)).count() == 0


def test_etl_keeps_every_event_once(spark, tables):
    for key, want in [
        ("visit_event_etl_60s", tables("kiosk_a").where("event_name <> '其他' AND page_url LIKE '%location%'").count()),
        ("visit_event_etl_30s", tables("kiosk_b").where("item_name IS NOT NULL").count()),
    ]:
        out = QUERIES[key](spark, SF_DIR)
        assert out.count() == want == out.select("event_id").distinct().count()


def test_grids_are_complete(spark):
    rating = QUERIES["report_channel_rating"](spark, SF_DIR)
    labels = rating.select("labelId").distinct().count()
    assert rating.count() == labels * 3 * 4
    visitors = QUERIES["dash_b_visitors"](spark, SF_DIR)
    assert visitors.groupBy("TB", "event_name", "item_name").count().where("count <> 5").count() == 0
    assert QUERIES["dash_b_age_gender"](spark, SF_DIR).count() == 8


def test_every_member_gets_one_rfm_label(spark, tables):
    members = tables("member").where("member LIKE 'M%'").count()
    for key in ("rfm_labels", "rfm_labels_kmeans"):
        out = QUERIES[key](spark, SF_DIR)
        assert out.count() == members == out.select("member_id").distinct().count()
        assert out.where("value_label IS NULL").count() == 0


def test_kmeans_is_repeatable(spark):
    first = [tuple(r) for r in QUERIES["rfm_kmeans"](spark, SF_DIR).collect()]
    assert first == [tuple(r) for r in QUERIES["rfm_kmeans"](spark, SF_DIR).collect()]
    assert len(first) == 6 and all(1 <= x <= 3 for row in first for x in row[1:])


def test_kmeans_on_weights_reaches_the_member_objective(spark, tables):
    """The weighted fit's cost per member equals the cost of the assignment it implies."""
    from visitry.catalog.models import _features
    from visitry.plans.rfm import SCORES, assign_clusters, rfm_kmeans

    features = _features(tables)
    model, centroids = rfm_kmeans(features)
    assigned = assign_clusters(model, features).join(features, "member_id").join(centroids.toDF("cluster", "cr", "cf", "cm"), "cluster")
    cost = sum((F.col(s) - F.col(c)) ** 2 for s, c in zip(SCORES, ("cr", "cf", "cm")))
    total = assigned.agg(F.sum(cost)).first()[0]
    assert abs(total - model.summary.trainingCost) < 1e-6


@pytest.mark.parametrize("key,k,item", [("als_recommend", 10, "product_id"), ("hybrid_recommend", 5, "item_id")])
def test_recommendations_are_well_formed(spark, key, k, item):
    recs = QUERIES[key](spark, SF_DIR).cache()
    assert recs.count() > 0
    per = recs.groupBy("member_id").agg(F.count("*").alias("n"), F.countDistinct(item).alias("d"))
    assert per.where((F.col("n") > k) | (F.col("n") != F.col("d"))).count() == 0
    if "rank" in recs.columns:
        later = recs.select("member_id", (F.col("rank") - 1).alias("rank"), F.col("score").alias("next"))
        assert recs.join(later, ["member_id", "rank"]).where("next > score").count() == 0
        assert recs.groupBy("member_id").agg(F.max("rank").alias("m"), F.count("*").alias("n")).where("m <> n").count() == 0
    recs.unpersist()


def test_hybrid_serves_everybody(spark, tables):
    """Members without any interaction get recommendations through their token."""
    recs = QUERIES["hybrid_recommend"](spark, SF_DIR)
    assert recs.select("member_id").distinct().count() == tables("member").count()


def test_split_is_a_partition(spark):
    out = QUERIES["train_test_split"](spark, SF_DIR)
    pairs = out.select("member_id", "product_id").distinct().count()
    shares = {r.side: r["count"] for r in out.groupBy("side").count().collect()}
    assert pairs == out.count() == sum(shares.values())
    assert 0.75 < shares["train"] / pairs < 0.85


def test_final_recommendations_are_full(spark, tables):
    out = QUERIES["recs_final"](spark, SF_DIR)
    assert out.count() == tables("member").count()


def test_rmse_of_the_fit(spark):
    row = QUERIES["rec_rmse_mae"](spark, SF_DIR).first()
    assert 0 < row.mae <= row.rmse


def _mixed_rules():
    span = {"start_time": "1999-01-01", "end_time": "2001-08-02"}
    late = {"time_range": {"start_time": "2000-06-01", "end_time": "2001-08-02"}, "count": {}, "cost": {}}
    wide = {"time_range": span, "count": {"count": 2, "moreOrless": "以上(含)"}, "cost": {"moreOrlessForCost": "大於", "cost": 1000}}
    return [
        rule("消費行為", "有購買的人", [], "整體", wide),
        rule("消費行為", "累計消費金額", {"moreOrless": "大於", "cost": 50000}, "線上", late, "且"),
        rule("基本屬性", "性別", ["男"], mode="或"),
        rule("消費行為", "累計消費次數", {"moreOrless": "小於", "cost": 6}, "線下", wide, "且"),
        rule("基本屬性", "年齡級距", {"low": 10, "high": 70}, mode="且"),
        rule("AI顧客分群", "流失風險", ["高"], mode="或"),
        rule("消費行為", "平均客單價", {"moreOrless": "小於", "low": 1000, "high": 90000}, "整體", late, "且"),
        rule("渠道再行銷", "有點擊過", [], "Email", mode="或"),
        rule("渠道再行銷", "有轉換過", [], "SMS", {"event": "r_3"}, "或"),
        rule("消費行為", "有購買的人", [], "整體", wide, "且"),
        rule("消費行為", "購買的類別名稱", ["ECONOMY"], "線上", late, "或"),
        rule("消費行為", "購買的品牌名稱", ["Brand#2", "Brand#4"], "整體", wide, "或"),
        rule("消費行為", "購買的商品名稱", ["red widget"], "線下", None, "或"),
    ]


def _web_rules():
    def when(first, last, count=None):
        return {"time_range": {"start_time": first, "end_time": last}, "count": count or {}}

    return [
        rule("網站行為", "有造訪過網站", [], "main", when("2024-01-02", "2024-01-20", {"count": 3, "moreOrless": "以上(含)"})),
        rule("網站行為", "有登入過", [], "main", when("2024-01-05", "2024-01-12"), "且"),
        rule("網站行為", "有轉換過", [], "main", when("2024-01-05", "2024-01-25"), "或"),
        rule("網站行為", "有加入購物車但未結", [], "main", None, "或"),
        rule("網站行為", "造訪商品名稱", ["small ring", "red widget"], "main", when("2024-01-01", "2024-01-30"), "或"),
        rule("網站行為", "造訪頁面類別", {"page_SMALL": ["blue bolt"]}, "main", when("2024-01-03", "2024-01-28"), "或"),
        rule("網站行為", "平均瀏覽時長", {"low": 60, "high": 600}, "main", when("2024-01-01", "2024-01-30"), "且"),
        rule("網站行為", "utm campaign source", ["fb"], "main", when("2024-01-03", "2024-01-09"), "或"),
        rule("網站行為", "utm campaign name", ["c3"], "main", when("2024-01-03", "2024-01-12"), "且"),
    ]


@pytest.mark.parametrize("make", [_mixed_rules, _web_rules])
def test_shared_passes_equal_single_rules(tables, make):
    """Rules evaluated together give what folding them one by one gives."""
    from datetime import datetime

    ctx, rules = tables.context(datetime(2024, 1, 31)), make()
    want: set = set()
    for n, r in enumerate(rules, start=1):
        found = ids(predicate(ctx, r))
        want = want & found if r["mode"] == "且" else want | found
        if n in (2, 5, 9, len(rules)):
            assert ids(segment_content(ctx, rules[:n])) == want


def test_labels_together_equal_labels_alone(tables):
    from visitry.segments import label_membership

    rules = _mixed_rules()
    contents = {"C_1": rules[:3], "C_2": rules[3:7], "C_3": list(reversed(rules)), "C_4": []}
    ctx = tables.context(contents=contents)
    out = label_membership(ctx, {k: k.lower() for k in contents}).collect()
    for label, content in contents.items():
        assert {r.member_id for r in out if r.labelId == label} == ids(segment_content(ctx, content))
    assert all(r.label == r.labelId.lower() for r in out)


def test_shared_passes_scan_each_table_once(tables):
    text = segment_content(tables.context(), _mixed_rules())._jdf.queryExecution().executedPlan().toString()
    # purchases once for totals and once, joined with the brands, for products
    for table, scans in [("lineitem", 2), ("events", 1), ("orders", 2), ("part", 1)]:
        assert text.count(f"/{table}.parquet") == scans
    web = segment_content(tables.context(date(2024, 1, 31)), _web_rules())
    text = web._jdf.queryExecution().executedPlan().toString()
    # one pass per log: views, sessions, carts, utm
    assert text.count("/events.parquet") == 4


def test_users_for_items_from_the_model(spark, tables):
    """The n best members of a product are those of the whole score matrix."""
    from visitry.plans.recommend import als_fit, als_scores, als_users, number_ids

    ratings = number_ids(tables("purchase_scores"))[0]
    model = als_fit(ratings, rank=3, maxIter=2)
    members = ratings.select("member_id").distinct().count()
    every = {(r.product_id, r.member_id): r.rating for r in als_scores(model, ratings.select("product_id").distinct().count()).collect()}
    best = als_users(model, 4).collect()
    for product in {r.product_id for r in best}:
        got = sorted((r.rating for r in best if r.product_id == product), reverse=True)
        want = sorted((v for (p, _), v in every.items() if p == product), reverse=True)[: min(4, members)]
        assert got == pytest.approx(want, rel=1e-5)


def test_recommendations_for_text_ids(spark, tables):
    """Ids that are not 32-bit ints are numbered for the fit and come back unchanged."""
    from visitry.plans.recommend import als_recommend

    ratings = tables("purchase_scores").select(
        F.concat(F.lit("M"), "member_id").alias("member_id"),
        (F.col("product_id") + 10**12).alias("product_id"), "rating",
    )
    recs = als_recommend(ratings, 3, rank=2, maxIter=2).cache()
    assert dict(recs.dtypes) == {"member_id": "string", "product_id": "bigint", "rating": "double"}
    assert recs.select("member_id").distinct().count() == ratings.select("member_id").distinct().count()
    assert recs.join(ratings.select("product_id").distinct(), "product_id", "left_anti").count() == 0
    assert recs.groupBy("member_id").count().where("count <> 3").count() == 0
    recs.unpersist()
