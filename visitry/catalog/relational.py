"""Joins, aggregates, windows, top-k and set operators on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import round_half_even
from ..operators.aggregates import (
    grouping_total,
    growth_percent,
    having_every,
    most_frequent,
    period_growth,
    pivot_onehot,
    precedence_group,
    quantile_cuts,
    share_of_total,
    two_level_agg,
    value_counts,
)
from ..operators.joins import (
    below_limits,
    cross_grid,
    densify,
    enrich_left,
    join_lookup,
    join_or_keys,
)
from ..operators.reshape import collect_ranked
from ..operators.sets import set_except, set_intersect, union_all, union_distinct
from ..operators.windows import (
    cohort_id,
    dwell_time,
    number_rows,
    top_bottom_per_group,
    topk_global,
    topn_per_group,
)
from ..plans.recommend import interactions_purchase
from ..plans.visits import group_relations
from .registry import query, rnd
from .scalars import INTERACTIONS, RANKED_SALES

# --- joins ------------------------------------------------------------------------------

query("join_inner", """
    SELECT city, level, count(*) AS lines, CAST(sum(count) AS BIGINT) AS pieces
    FROM purchase JOIN member USING (member_id) GROUP BY city, level""")(
    lambda t: t("purchase")
    .join(t("member").select("member_id", "city", "level"), "member_id")
    .groupBy("city", "level")
    .agg(F.count("*").alias("lines"), F.sum("count").alias("pieces"))
)
query("join_left_enrich", """
    SELECT order_id, product_id, count, level, city FROM purchase LEFT JOIN member USING (member_id)""")(
    lambda t: enrich_left(
        t("purchase").select("member_id", "order_id", "product_id", "count"),
        t("member").select("member_id", "level", "city"), ["member_id"],
    ).select("order_id", "product_id", "count", "level", "city")
)
query("join_left_notnull", """
    SELECT order_id, product_id, join_date IS NOT NULL AS known FROM purchase LEFT JOIN
      (SELECT * FROM member WHERE level = 'BUILDING') m USING (member_id) WHERE m.member IS NOT NULL""")(
    # a left join whose misses are dropped is an inner join
    lambda t: t("purchase")
    .join(t("member").where("level = 'BUILDING'").select("member_id", "join_date"), "member_id")
    .select("order_id", "product_id", F.col("join_date").isNotNull().alias("known"))
)
query("join_right", """
    SELECT activity_id, n FROM (SELECT script_name, count(*) AS n FROM schedule GROUP BY 1) s
    RIGHT JOIN activity ON script_name = activity_id""")(
    lambda t: t("schedule")
    .groupBy(F.col("script_name").alias("activity_id"))
    .agg(F.count("*").alias("n"))
    .join(t("activity").select("activity_id"), "activity_id", "right")
    .select("activity_id", "n")
)
query("join_full_outer", """
    SELECT coalesce(a.city, b.city) AS city, members, spenders FROM
      (SELECT city, count(*) AS members FROM member WHERE age > 85 GROUP BY city) a
    FULL JOIN (SELECT city, count(*) AS spenders FROM member JOIN member_stat USING (member_id) WHERE m > 4000000 GROUP BY city) b
      ON a.city = b.city""")(
    lambda t: t("member").where("age > 85").groupBy("city").agg(F.count("*").alias("members")).join(
        t("member").join(t("member_stat").where("m > 4000000"), "member_id")
        .groupBy("city").agg(F.count("*").alias("spenders")),
        "city", "full",
    )
)
query("join_semi", """
    SELECT order_id, product_id, count FROM purchase
    WHERE product_id IN (SELECT product_id FROM brand WHERE brand_name IN ('Brand#2', 'Brand#4'))""")(
    lambda t: t("purchase").select("order_id", "product_id", "count").join(
        t("brand").where(F.col("brand_name").isin("Brand#2", "Brand#4")), "product_id", "left_semi"
    ).select("order_id", "product_id", "count")
)
query("join_anti", """
    SELECT member_id FROM member WHERE member_id NOT IN
      (SELECT member_id FROM purchase WHERE member_id IS NOT NULL AND date >= DATE '2001-01-01')""")(
    lambda t: t("member").select("member_id").join(
        t("purchase").where(F.col("date") >= F.lit(date(2001, 1, 1))).select("member_id").distinct(), "member_id", "left_anti"
    )
)
RELATIONS_SQL = """
    SELECT group_id, CASE WHEN bool_or(relation = '家庭') THEN '家庭' WHEN bool_or(relation = '情侶') THEN '情侶'
        WHEN bool_or(relation = '朋友') THEN '朋友' ELSE coalesce(min(best), '') END AS relation
    FROM detect_record LEFT JOIN (
      SELECT group_id, relation AS best FROM (
        SELECT group_id, relation, row_number() OVER (PARTITION BY group_id ORDER BY count(*) DESC, relation) AS rn
        FROM detect_record WHERE relation IS NOT NULL GROUP BY group_id, relation) c WHERE rn = 1) m USING (group_id)
    WHERE group_id IS NOT NULL GROUP BY group_id"""
query("join_null_safe", f"""
    SELECT event_id, k.group_id, relation FROM kiosk_a k LEFT JOIN ({RELATIONS_SQL}) r ON k.group_id = r.group_id""")(
    # events without a group stay, and match nothing
    lambda t: enrich_left(
        t("kiosk_a").select("event_id", "group_id"),
        group_relations(t("detect_record"), per_location=False), ["group_id"],
    )
)
query("join_lookup", """
    SELECT event_id, m.member_id FROM web_event e JOIN cid_map m USING (cid)""")(
    lambda t: join_lookup(t("web_event").select("event_id", "cid"), t("cid_map"), "cid", "member_id").select(
        "event_id", "member_id"
    )
)
query("join_or_keys", """
    SELECT member_id FROM member WHERE line_id IN (SELECT line_id FROM line_custom WHERE type = 'error')
      OR line_id2 IN (SELECT line_id FROM line_custom WHERE type = 'error')""")(
    lambda t: join_or_keys(
        t("member"), t("line_custom").where("type = 'error'").select("line_id"), "member_id", ("line_id", "line_id2")
    )
)
query("join_scalar", """
    SELECT member_id FROM quota WHERE daily < (SELECT daily FROM quota WHERE member_id = 'limit')
      AND weekly < (SELECT weekly FROM quota WHERE member_id = 'limit')
      AND monthly < (SELECT monthly FROM quota WHERE member_id = 'limit')
      AND yearly < (SELECT yearly FROM quota WHERE member_id = 'limit')""")(
    lambda t: below_limits(
        t("quota"), t("quota").where("member_id = 'limit'"), ["daily", "weekly", "monthly", "yearly"]
    ).select("member_id")
)
query("cross_grid", """
    SELECT city, gender, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT city FROM member) a
    CROSS JOIN (VALUES ('男'), ('女'), ('無')) g(gender) CROSS JOIN (VALUES ('web'), ('app'), ('store')) s(source)
    LEFT JOIN (SELECT city, gender, source, count(*) AS n FROM member GROUP BY 1, 2, 3) c USING (city, gender, source)""")(
    lambda t: densify(
        t("member").groupBy("city", "gender", "source").agg(F.count("*").alias("n")),
        cross_grid(t("member").select("city").distinct(), gender=["男", "女", "無"], source=["web", "app", "store"]),
        ["city", "gender", "source"], {"n": 0},
    )
)

# --- aggregates -------------------------------------------------------------------------

query("agg_basic", """
    SELECT product_id, count(*) AS lines, CAST(sum(count) AS BIGINT) AS pieces, CAST(sum(sales) AS DOUBLE) AS sales,
           sum(count) / count(*) AS mean, min(date)::VARCHAR AS first, max(date)::VARCHAR AS last
    FROM purchase GROUP BY product_id""")(
    lambda t: t("purchase").groupBy("product_id").agg(
        F.count("*").alias("lines"), F.sum("count").alias("pieces"), F.sum("sales").alias("sales"),
        F.avg("count").alias("mean"), F.min("date").alias("first"), F.max("date").alias("last"),
    )
)
query("agg_nunique", """
    SELECT product_id, count(DISTINCT member_id) AS buyers FROM purchase GROUP BY product_id""")(
    lambda t: t("purchase").groupBy("product_id").agg(F.countDistinct("member_id").alias("buyers"))
)
query("agg_distinct_rows", "SELECT DISTINCT member_id, product_id, online FROM purchase")(
    lambda t: t("purchase").select("member_id", "product_id", "online").dropDuplicates()
)
query("having_count", """
    SELECT member_id, count(DISTINCT order_id) AS orders FROM purchase WHERE member_id IS NOT NULL
    GROUP BY member_id HAVING count(DISTINCT order_id) >= 10""")(
    lambda t: t("purchase").where("member_id IS NOT NULL").groupBy("member_id")
    .agg(F.countDistinct("order_id").alias("orders")).where("orders >= 10")
)
query("having_every", """
    SELECT member_id FROM purchase WHERE member_id IS NOT NULL GROUP BY member_id HAVING bool_and(sales >= 900)""")(
    lambda t: having_every(t("purchase").where("member_id IS NOT NULL"), ["member_id"], F.col("sales") >= 900)
)
query("having_conditional", """
    SELECT cid, count(*) FILTER (type = 'cart') AS carts FROM cart_buy GROUP BY cid
    HAVING count(*) FILTER (type = 'cart') > 0 AND count(*) FILTER (type = 'conversion') = 0""")(
    lambda t: t("cart_buy").groupBy("cid").agg(
        F.count_if(F.col("type") == "cart").alias("carts"), F.count_if(F.col("type") == "conversion").alias("buys")
    ).where("carts > 0 AND buys = 0").select("cid", "carts")
)
query("agg_sum_ratio", """
    SELECT member_id, CAST(sum(sales) AS DOUBLE) AS total, CAST(sum(sales) AS DOUBLE) / count(DISTINCT order_id) AS aov
    FROM purchase WHERE member_id IS NOT NULL GROUP BY member_id
    HAVING CAST(sum(sales) AS DOUBLE) / count(DISTINCT order_id) BETWEEN 50000 AND 120000""")(
    lambda t: t("purchase").where("member_id IS NOT NULL").groupBy("member_id", "order_id")
    .agg(F.sum("sales").alias("order_total")).groupBy("member_id")
    .agg(F.sum("order_total").cast("double").alias("total"), F.count("*").alias("orders"))
    .select("member_id", "total", (F.col("total") / F.col("orders")).alias("aov"))
    .where(F.col("aov").between(50000, 120000))
)
query("two_level_agg", f"""
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS groups, {rnd("avg(s)", 2)} AS mean_l_quantity
    FROM (SELECT l_orderkey, l_returnflag, l_linestatus, sum(l_quantity) AS s FROM lineitem GROUP BY 1, 2, 3) x GROUP BY 1, 2""")(
    lambda t: two_level_agg(
        t("lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"], ["l_returnflag", "l_linestatus"],
        "l_quantity", "l_orderkey",
    )
)
query("share_of_total", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS count, 100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share
    FROM orders GROUP BY 1, 2""")(
    lambda t: share_of_total(t("orders"), ["o_orderstatus", "o_orderpriority"], ["o_orderstatus"], "share")
)
query("precedence_group", RELATIONS_SQL)(
    lambda t: precedence_group(t("detect_record"), "group_id", "relation", "relation")
)
query("agg_mode", """
    SELECT member_id, product_id FROM (
      SELECT member_id, product_id, row_number() OVER (PARTITION BY member_id ORDER BY count(*) DESC, product_id) AS rn
      FROM purchase WHERE member_id IS NOT NULL GROUP BY 1, 2) x WHERE rn = 1""")(
    lambda t: most_frequent(t("purchase").where("member_id IS NOT NULL"), ["member_id"], "product_id")
)
query("agg_collect", f"""
    SELECT member_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rank) AS products
    FROM ({RANKED_SALES}) r WHERE rank <= 10 GROUP BY member_id""")(
    lambda t: collect_ranked(
        topn_per_group(t("purchase_scores"), ["member_id"], [F.desc("rating"), F.asc("product_id")], 10),
        ["member_id"], "rank", "product_id", "p",
    ).select("member_id", F.array_join(F.col("p").cast("array<string>"), ",").alias("products"))
)
EVENT_KINDS = ("click", "error", "purchase", "signup", "view")
query("pivot_onehot", """
    SELECT line_id, count(*) FILTER (type = 'click') AS click, count(*) FILTER (type = 'error') AS error,
           count(*) FILTER (type = 'purchase') AS purchase, count(*) FILTER (type = 'signup') AS signup,
           count(*) FILTER (type = 'view') AS view FROM line_custom GROUP BY line_id""")(
    lambda t: pivot_onehot(t("line_custom"), "line_id", "type", EVENT_KINDS)
)
query("grouping_total", f"""
    SELECT CAST(date AS VARCHAR) AS date, CASE WHEN grouping(gender) = 1 THEN '全' ELSE gender END AS gender,
           count(*) AS n, {rnd("avg(stay)", 2)} AS stay
    FROM (SELECT CAST(visittime AS DATE) AS date, gender, CAST(split_part(staytime, ' ', 1) AS DOUBLE) AS stay FROM detect_record) v
    GROUP BY GROUPING SETS ((date, gender), (date))""")(
    lambda t: grouping_total(
        t("detect_record").select(
            F.to_date("visittime").alias("date"), "gender",
            F.substring_index("staytime", " ", 1).cast("double").alias("stay"),
        ),
        "date", "gender", [F.count("*").alias("n"), round_half_even(F.avg("stay"), 2).alias("stay")],
    )
)


@query("period_growth", f"""
    SELECT cur_lines, prev_lines, cur_buyers, prev_buyers, cur_pieces, prev_pieces,
           {rnd("(cur_lines - prev_lines) * 100 / prev_lines")} AS growth
    FROM (SELECT
      CAST(count(*) FILTER (date >= DATE '2000-07-01') AS DOUBLE) AS cur_lines,
      CAST(count(*) FILTER (date < DATE '2000-07-01') AS DOUBLE) AS prev_lines,
      CAST(count(DISTINCT member_id) FILTER (date >= DATE '2000-07-01') AS DOUBLE) AS cur_buyers,
      CAST(count(DISTINCT member_id) FILTER (date < DATE '2000-07-01') AS DOUBLE) AS prev_buyers,
      avg(count) FILTER (date >= DATE '2000-07-01') AS cur_pieces,
      avg(count) FILTER (date < DATE '2000-07-01') AS prev_pieces
      FROM purchase WHERE date BETWEEN DATE '2000-05-31' AND DATE '2000-07-31') x""")
def _(t):
    both = period_growth(
        t("purchase"), F.col("date"), date(2000, 7, 1), date(2000, 7, 31),
        {
            "lines": ("count", F.lit(1)), "buyers": ("nunique", F.col("member_id")),
            "pieces": ("mean", F.col("count")),
        },
    )
    return both.withColumn("growth", growth_percent(F.col("cur_lines"), F.col("prev_lines")))


query("quantile_cut", f"""
    SELECT quantile_disc(total_count, 0.2) AS q20, quantile_disc(total_count, 0.4) AS q40,
           quantile_disc(total_count, 0.6) AS q60, quantile_disc(total_count, 0.8) AS q80 FROM ({INTERACTIONS}) i""")(
    lambda t: quantile_cuts(interactions_purchase(t("purchase")), "total_count")
)
query("value_counts", """
    SELECT location, item_name, count(*) AS count FROM record_a
    WHERE location IS NOT NULL AND item_name IS NOT NULL GROUP BY 1, 2""")(
    lambda t: value_counts(t("record_a"), ["location"], "item_name")
)

# --- windows ----------------------------------------------------------------------------

DWELL = """
    SELECT event_id, CASE WHEN d > {cap} THEN {cap}::DOUBLE ELSE d END AS stay_time FROM (
      SELECT event_id, CASE WHEN ga_session_id IS NOT NULL THEN date_diff('microsecond', ts,
        lead(ts) OVER (PARTITION BY event_date, ga_session_id ORDER BY ts, event_id)) / 1000000.0::DOUBLE END AS d FROM web_event) x"""
for _key, _cap in [("dwell_time", 60), ("dwell_time_6h", 21600)]:
    query(_key, DWELL.format(cap=_cap))(
        lambda t, cap=_cap: dwell_time(
            t("web_event"), ["event_date", "ga_session_id"], "ts", "event_id", cap
        ).select("event_id", "stay_time")
    )
query("topn_per_group", f"SELECT * FROM ({RANKED_SALES}) r WHERE rank <= 10")(
    lambda t: topn_per_group(t("purchase_scores"), ["member_id"], [F.desc("rating"), F.asc("product_id")], 10)
)
query("top_bottom_per_group", """
    SELECT city, store_source, n, rank, 'top' AS "TB" FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC, store_source) AS rank
      FROM (SELECT city, store_source, count(*) AS n FROM member GROUP BY 1, 2) c) x WHERE rank <= 2
    UNION ALL
    SELECT city, store_source, n, rank, 'buttom' FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n, store_source DESC) AS rank
      FROM (SELECT city, store_source, count(*) AS n FROM member GROUP BY 1, 2) c) x WHERE rank <= 2""")(
    lambda t: top_bottom_per_group(
        t("member").groupBy("city", "store_source").agg(F.count("*").alias("n")), ["city"], "n", "store_source", 2
    )
)
query("window_share", """
    SELECT city, gender, n, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY city) AS percent
    FROM (SELECT city, gender, count(*) AS n FROM member GROUP BY 1, 2) c""")(
    lambda t: share_of_total(t("member"), ["city", "gender"], ["city"], "percent").withColumnRenamed("count", "n")
)
_COMBO_JSON = (
    """'{"gender":"' || gender || '","age":' || CAST(age AS VARCHAR) || ',"marriage":"' || marriage || '","birth_month":'"""
    """ || CAST(birth_month AS VARCHAR) || ',"region_sort":' || CAST(region_sort AS VARCHAR) || ',"level":"' || level || '"}'"""
)
COHORT_SQL = f"""
    SELECT member_id, cohort FROM (
      SELECT member_id, gender, CASE WHEN age > 0 AND age <= 100 THEN CAST(ceil(age / 20.0) AS INTEGER) ELSE 0 END AS age,
             coalesce(marriage, '無資料') AS marriage, birth_month, region_sort, level FROM member) m
    JOIN (SELECT *, row_number() OVER (ORDER BY substr(md5({_COMBO_JSON}), 1, 3), gender, age, marriage, birth_month, region_sort, level) AS cohort
      FROM (SELECT DISTINCT gender, CASE WHEN age > 0 AND age <= 100 THEN CAST(ceil(age / 20.0) AS INTEGER) ELSE 0 END AS age,
              coalesce(marriage, '無資料') AS marriage, birth_month, region_sort, level FROM member) d) c
      USING (gender, age, marriage, birth_month, region_sort, level)"""
query("cohort_id", """
    SELECT member_id, cohort FROM member JOIN
      (SELECT city, source, row_number() OVER (ORDER BY substr(md5('{"city":"' || city || '","source":"' || source || '"}'), 1, 3), city, source) AS cohort
       FROM (SELECT DISTINCT city, source FROM member) d) c USING (city, source)""")(
    lambda t: cohort_id(t("member").select("member_id", "city", "source"), ["city", "source"]).select("member_id", "cohort")
)
query("number_rows", """
    SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5('{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || '}'), 1, 3), o_orderkey) AS n
    FROM orders""")(
    lambda t: number_rows(t("orders").select("o_orderkey"), ["o_orderkey"], "n")
)

# --- sorts, top-k, sets -----------------------------------------------------------------

query("sort_multi", "SELECT product_id, brand_name, category_name FROM brand")(
    lambda t: t("brand").select("product_id", "brand_name", "category_name").orderBy(
        F.desc("brand_name"), F.asc("category_name"), F.desc("product_id")
    )
)
query("topk_global", """
    SELECT product_id, total FROM (
      SELECT product_id, CAST(sum(count) AS BIGINT) AS total, row_number() OVER (ORDER BY sum(count) DESC, product_id) AS rn
      FROM purchase GROUP BY product_id) x
    WHERE rn <= 10 AND product_id NOT IN (SELECT product_id FROM brand WHERE category_name = 'ECONOMY')""")(
    # the block list is applied after the cut
    lambda t: topk_global(
        t("purchase").groupBy("product_id").agg(F.sum("count").alias("total")),
        [F.desc("total"), F.asc("product_id")], 10,
    ).join(t("brand").where("category_name = 'ECONOMY'"), "product_id", "left_anti")
)
query("latest_value", "SELECT CAST(max(ts) AS VARCHAR) AS latest, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS day FROM events")(
    lambda t: t("events").agg(F.max("ts").alias("latest")).withColumn("day", F.to_date("latest"))
)
_KINDS = ("view", "click", "purchase", "signup")
query("union_distinct", "SELECT DISTINCT user_id FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')")(
    lambda t: union_distinct(*[t("events").where(F.col("event_type") == k).select("user_id") for k in _KINDS])
)
query("union_all", "SELECT user_id, event_type FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')")(
    lambda t: union_all(*[t("events").where(F.col("event_type") == k).select("user_id", "event_type") for k in _KINDS])
)
query("set_intersect", """
    SELECT o_custkey AS member_id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""")(
    lambda t: set_intersect(
        t("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("member_id")),
        t("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("member_id")),
    )
)
query("set_except", """
    SELECT c_custkey AS member_id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000""")(
    lambda t: set_except(
        t("customer").select(F.col("c_custkey").alias("member_id")),
        t("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("member_id")),
    )
)
