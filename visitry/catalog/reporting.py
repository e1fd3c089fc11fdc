"""Event loading, reports and dashboards on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..plans import dashboards as dash
from ..plans.reports import activity_range, report_channel_rating, report_copurchase
from ..plans.visits import (
    relation_backfill,
    visit_event_etl_30s,
    visit_event_etl_60s,
    visit_window,
)
from . import nested
from .registry import query, rnd
from .relational import RELATIONS_SQL
from .scalars import ITEM_SQL, PAGE_SQL

FIRST, LAST = date(2024, 1, 10), date(2024, 1, 25)
DAYS = "BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'"
MOMENTS = "BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-25 23:59:59'"
DEVICE = "10.0.0.1_17d5dffb"
VISIT_DAY = date(2024, 1, 12)
IN_WINDOW = "visittime BETWEEN TIMESTAMP '2024-01-07' AND TIMESTAMP '2024-01-17 23:59:59'"
PLACE = "CASE split_part(pcid, '_', 2) WHEN '17d5dffb' THEN 'A1' WHEN 'b97bc201' THEN 'I' END"
STAY = "CAST(split_part(staytime, ' ', 1) AS DOUBLE)"
AGE = "CAST(replace(age, '歲', '') AS INTEGER)"

# --- event loading ----------------------------------------------------------------------


def _relations(source: str) -> str:
    """The precedence SQL over another visit source."""
    return RELATIONS_SQL.replace("FROM detect_record", f"FROM ({source})")


_WINDOWED = f"SELECT * FROM detect_record WHERE {IN_WINDOW}"


def _dwell(cap: int) -> str:
    return f"""CASE WHEN ga_session_id IS NOT NULL THEN CASE WHEN next_sec IS NULL THEN NULL
      WHEN date_diff('second', sec, next_sec) > {cap} THEN {cap}.0::DOUBLE ELSE CAST(date_diff('second', sec, next_sec) AS DOUBLE) END END"""


_NEXT = "lead(sec) OVER (PARTITION BY event_date, ga_session_id ORDER BY sec, event_id) AS next_sec"
query("visit_window", f"SELECT event_id, group_id FROM detect_record WHERE {IN_WINDOW}")(
    lambda t: visit_window(t("detect_record"), "visittime", VISIT_DAY).select("event_id", "group_id")
)
query("visit_event_etl_60s", f"""
    SELECT event_id, CAST(event_date AS VARCHAR) AS event_date, CAST(sec AS VARCHAR) AS event_timestamp, event_name,
           {PAGE_SQL} AS item_name, {_dwell(60)} AS stay_time, e.group_id, r.relation, e.location
    FROM (SELECT *, {_NEXT} FROM (
      SELECT *, date_trunc('second', ts) AS sec, {ITEM_SQL} AS item,
             CASE WHEN page_url LIKE '%locationA1%' THEN 'A1' WHEN page_url LIKE '%locationI%' THEN 'I' END AS location
      FROM kiosk_a WHERE event_name <> '其他') f WHERE location IS NOT NULL) e
    LEFT JOIN (SELECT * FROM (SELECT DISTINCT group_id, {PLACE} AS location FROM ({_WINDOWED}) w) p
      JOIN ({_relations(_WINDOWED)}) g USING (group_id) WHERE location IS NOT NULL) r
      ON r.group_id = e.group_id AND r.location = e.location""")(
    lambda t: visit_event_etl_60s(nested.kiosk_a(t), t("detect_record"), VISIT_DAY)
)
query("visit_event_etl_30s", f"""
    SELECT event_id, CAST(event_date AS VARCHAR) AS event_date, CAST(sec AS VARCHAR) AS event_timestamp, event_name,
           item_name, {_dwell(30)} AS stay_time, nullif(e.group_id, '') AS group_id, r.relation, brand_name
    FROM (SELECT *, {_NEXT} FROM (SELECT *, date_trunc('second', ts) AS sec FROM kiosk_b WHERE item_name IS NOT NULL) f) e
    LEFT JOIN ({_relations(_WINDOWED)}) r ON r.group_id = e.group_id""")(
    lambda t: visit_event_etl_30s(nested.kiosk_b(t), t("detect_record"), VISIT_DAY)
)
_LATEST = "SELECT * FROM detect_record WHERE CAST(visittime AS DATE) = (SELECT max(CAST(visittime AS DATE)) FROM detect_record)"
_UNSET = "SELECT * FROM detect_record WHERE relation_group IS NULL"
for _key, _scope, _source in [
    ("relation_backfill", "latest_day", _LATEST), ("relation_backfill_unset", "unset", _UNSET),
]:
    query(_key, f"""
        SELECT event_id, d.group_id, CASE WHEN r.group_id IS NULL THEN relation_group ELSE r.relation END AS relation_group
        FROM detect_record d LEFT JOIN ({_relations(_source)}) r ON r.group_id = d.group_id""")(
        lambda t, scope=_scope: relation_backfill(t("detect_record"), scope).select(
            "event_id", "group_id", "relation_group"
        )
    )

# --- reports ----------------------------------------------------------------------------


def _labels(t):
    return t("label_doc").select(F.col("label_id").alias("labelId"), F.col("name").alias("label"))


def _members(t):
    return t("label_member").select("member_id", F.col("label_id").alias("labelId"), "label")


query("report_copurchase", """
    SELECT d.label_id AS "labelId", d.name AS label, '2001-07' AS date, online, product_id, count
    FROM label_doc d LEFT JOIN (
      SELECT label_id, online, product_id, count(DISTINCT p.member_id) AS count FROM purchase p
      JOIN label_member m ON CAST(p.member_id AS VARCHAR) = m.member_id
      WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' AND add_on = 0 AND product_id NOT LIKE '%D%'
      GROUP BY 1, 2, 3) c USING (label_id)""")(
    lambda t: report_copurchase(t("purchase"), _members(t), _labels(t), "2001-07")
)
query("report_channel_rating", """
    SELECT label_id AS "labelId", name AS label, channel, response AS reaction, '2001-07' AS month,
           coalesce(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY label_id, channel), 0) AS percentage
    FROM label_doc CROSS JOIN (VALUES ('email'), ('sms'), ('fb')) c(channel)
    CROSS JOIN (VALUES ('高'), ('中'), ('低'), ('無')) r(response)
    LEFT JOIN (SELECT label_id, channel, response, count(*) AS n FROM label_member m
      JOIN channel_user u ON CAST(u.member_id AS VARCHAR) = m.member_id GROUP BY 1, 2, 3) x
      USING (label_id, channel, response)""")(
    lambda t: report_channel_rating(
        t("channel_user").withColumn("member_id", F.col("member_id").cast("string")),
        _members(t), _labels(t), month="2001-07",
    )
)
query("activity_range", """
    SELECT activity_id, activity_name, CAST(least(start_date, f) AS VARCHAR) AS start_date,
           CAST(greatest(end_date, l) AS VARCHAR) AS end_date, time
    FROM activity LEFT JOIN (SELECT script_name, CAST(min(schedule_time) AS DATE) AS f, CAST(max(schedule_time) AS DATE) AS l
      FROM schedule GROUP BY 1) s ON script_name = activity_id""")(
    lambda t: activity_range(
        t("activity"), [t("schedule").where(F.col("channel") == c) for c in ("Email", "SMS")]
    )
)

# --- dashboards: first kiosk ------------------------------------------------------------

_SEEN = f"(SELECT *, {PLACE} AS location, CAST(visittime AS DATE) AS date FROM detect_record WHERE visittime {MOMENTS}) v"
query("dash_a_info", f"""
    SELECT location, count(DISTINCT group_id) AS groups, {rnd("avg(s)", 2)} AS mean_stay
    FROM (SELECT group_id, relation_group, location, sum({STAY}) AS s FROM {_SEEN} GROUP BY 1, 2, 3) x
    WHERE location IS NOT NULL GROUP BY location""")(lambda t: dash.dash_a_info(t("detect_record"), FIRST, LAST))
query("dash_a_timeline", f"""
    SELECT location, CAST(date AS VARCHAR) AS date, count(DISTINCT group_id) AS groups, {rnd("avg(s)", 2)} AS mean_stay
    FROM (SELECT date, group_id, relation_group, location, sum({STAY}) AS s FROM {_SEEN} GROUP BY 1, 2, 3, 4) x
    WHERE location IS NOT NULL GROUP BY location, date""")(
    lambda t: dash.dash_a_timeline(t("detect_record"), FIRST, LAST)
)
NAMED = """CASE {0} WHEN 'male' THEN '男' WHEN 'female' THEN '女' WHEN 'friend' THEN '朋友' WHEN 'couple' THEN '情侶'
    WHEN 'family' THEN '家庭' ELSE {0} END"""
query("dash_a_relation", f"""
    SELECT location, relation, {rnd("100.0::DOUBLE * n / sum(n) OVER (PARTITION BY location)", 2)} AS share FROM (
      SELECT location, {NAMED.format("relation_group")} AS relation, count(*) AS n
      FROM (SELECT DISTINCT group_id, relation_group, location FROM {_SEEN}) d
      WHERE relation_group <> '' AND location IS NOT NULL GROUP BY 1, 2) c""")(
    lambda t: dash.dash_a_relation(t("detect_record"), FIRST, LAST)
)
query("dash_a_age", f"""
    SELECT location, CASE WHEN a > 0 AND a <= 10 THEN '0~10' WHEN a > 10 AND a <= 20 THEN '11~20' WHEN a > 20 AND a <= 25 THEN '21~25'
           WHEN a > 25 AND a <= 30 THEN '26~30' WHEN a > 30 AND a <= 40 THEN '31~40' WHEN a > 40 AND a <= 50 THEN '41~50'
           WHEN a > 50 AND a <= 60 THEN '51~60' ELSE '60up' END AS age_range, count(*) AS count
    FROM (SELECT location, {AGE} AS a FROM {_SEEN}) x WHERE location IS NOT NULL GROUP BY 1, 2""")(
    lambda t: dash.dash_a_age(t("detect_record"), FIRST, LAST)
)
EVENT_A = "CASE event_name WHEN '點擊下方項目' THEN '選單' WHEN '點擊地圖項目' THEN '地圖' WHEN '點擊課程更多資訊' THEN '課程' ELSE '購物' END"
_CLICKS_A = f"""(SELECT location, {EVENT_A} AS event_name, item_name, stay_time, {NAMED.format("relation")} AS relation
    FROM record_a WHERE event_name <> '其他' AND event_date {DAYS} AND location IS NOT NULL AND item_name IS NOT NULL) c"""
_MEASURES = f"count(*) AS clicks, {rnd('coalesce(sum(stay_time), 0) / 60', 2)} AS minutes"
query("dash_a_click_stay", f"SELECT location, event_name, item_name, {_MEASURES} FROM {_CLICKS_A} GROUP BY 1, 2, 3")(
    lambda t: dash.dash_a_click_stay(t("record_a"), FIRST, LAST)
)
_CELLS = f"SELECT location, event_name, item_name, relation, {_MEASURES} FROM {_CLICKS_A} WHERE relation IS NOT NULL GROUP BY 1, 2, 3, 4"
query("dash_a_click_stay_rel", f"""
    SELECT location, event_name, item_name, relation, coalesce(clicks, 0) AS clicks, coalesce(minutes, 0) AS minutes
    FROM (SELECT DISTINCT location FROM ({_CELLS}) a) l CROSS JOIN (SELECT DISTINCT event_name, item_name FROM ({_CELLS}) b) i
    CROSS JOIN (VALUES ('男'), ('女'), ('朋友'), ('情侶'), ('家庭')) r(relation)
    LEFT JOIN ({_CELLS}) x USING (location, event_name, item_name, relation)""")(
    lambda t: dash.dash_a_click_stay_rel(t("record_a"), FIRST, LAST)
)
query("dash_a_top10", f"""
    SELECT location, event_name, item_name, clicks FROM (
      SELECT location, event_name, item_name, count(*) AS clicks,
             row_number() OVER (PARTITION BY location, event_name ORDER BY count(*) DESC, item_name) AS rn
      FROM {_CLICKS_A} GROUP BY 1, 2, 3) x WHERE rn <= 10""")(lambda t: dash.dash_a_top10(t("record_a"), FIRST, LAST))

# --- dashboards: second kiosk -----------------------------------------------------------

# the period before has as many days as the period shown
_BOTH = "BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'"
G_FIRST, G_LAST = date(2024, 1, 15), date(2024, 1, 19)
_CUR, _PREV = "day >= DATE '2024-01-15'", "day < DATE '2024-01-15'"
query("dash_b_info", f"""
    WITH v AS (SELECT
        CAST(count(*) FILTER ({_CUR}) AS DOUBLE) AS c1, CAST(count(*) FILTER ({_PREV}) AS DOUBLE) AS p1,
        CAST(count(DISTINCT group_id) FILTER ({_CUR}) AS DOUBLE) AS c2, CAST(count(DISTINCT group_id) FILTER ({_PREV}) AS DOUBLE) AS p2,
        avg(stay) FILTER ({_CUR}) AS c3, avg(stay) FILTER ({_PREV}) AS p3
      FROM (SELECT CAST(visittime AS DATE) AS day, group_id, {STAY} AS stay FROM detect_record WHERE pcid = '{DEVICE}') d WHERE day {_BOTH}),
    h AS (SELECT CAST(count(*) FILTER ({_CUR}) AS DOUBLE) AS c4, CAST(count(*) FILTER ({_PREV}) AS DOUBLE) AS p4
      FROM (SELECT event_date AS day FROM record_b WHERE event_name = 'select_homepage') e WHERE day {_BOTH}),
    k AS (SELECT unnest([1, 2, 3, 4]) AS i)
    SELECT CASE i WHEN 1 THEN 'views' WHEN 2 THEN 'groups' WHEN 3 THEN 'stay' ELSE 'home_clicks' END AS kpi,
           {rnd("CASE i WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 ELSE c4 END", 2)} AS value,
           CASE WHEN p1 > 0 AND p2 > 0 AND p3 > 0 AND p4 > 0 THEN CASE i WHEN 1 THEN {rnd("(c1 - p1) * 100 / p1")}
             WHEN 2 THEN {rnd("(c2 - p2) * 100 / p2")} WHEN 3 THEN {rnd("(c3 - p3) * 100 / p3")} ELSE {rnd("(c4 - p4) * 100 / p4")} END END AS growth
    FROM v, h, k""")(
    lambda t: dash.dash_b_info(t("detect_record"), t("record_b"), G_FIRST, G_LAST, DEVICE)
)
_DEV = f"(SELECT *, CAST(visittime AS DATE) AS date, {STAY} AS stay FROM detect_record WHERE pcid = '{DEVICE}' AND visittime {MOMENTS}) v"
query("dash_b_timeline", f"""
    SELECT CAST(date AS VARCHAR) AS date, CASE WHEN grouping(gender) = 1 THEN '全' ELSE gender END AS gender,
           count(stay) AS visitors, {rnd("avg(stay)", 2)} AS mean_stay
    FROM {_DEV} GROUP BY GROUPING SETS ((date, gender), (date))""")(
    lambda t: dash.dash_b_timeline(t("detect_record"), FIRST, LAST, DEVICE)
)
FIVE = "(VALUES ('male'), ('female'), ('friend'), ('couple'), ('family'))"
query("dash_b_relation", f"""
    SELECT relation_group, coalesce({rnd("100.0::DOUBLE * n / sum(n) OVER ()", 2)}, 0) AS share
    FROM {FIVE} r(relation_group) LEFT JOIN (SELECT relation_group, count(*) AS n
      FROM (SELECT DISTINCT relation_group, group_id FROM {_DEV}) d GROUP BY 1) c USING (relation_group)""")(
    lambda t: dash.dash_b_relation(t("detect_record"), FIRST, LAST, DEVICE)
)
query("dash_b_age_gender", f"""
    SELECT gender, age_range, coalesce(counts, 0) AS counts FROM (VALUES ('男'), ('女')) g(gender)
    CROSS JOIN (VALUES ('25歲以下'), ('26-35歲'), ('36-45歲'), ('46歲以上')) a(age_range)
    LEFT JOIN (SELECT gender, CASE WHEN a > 0 AND a <= 25 THEN '25歲以下' WHEN a > 25 AND a <= 35 THEN '26-35歲'
        WHEN a > 35 AND a <= 45 THEN '36-45歲' ELSE '46歲以上' END AS age_range, count(*) AS counts
      FROM (SELECT gender, {AGE} AS a FROM {_DEV}) x GROUP BY 1, 2) c USING (gender, age_range)""")(
    lambda t: dash.dash_b_age_gender(t("detect_record"), FIRST, LAST, DEVICE)
)
EVENT_B = "CASE event_name WHEN 'select_brand' THEN '品牌' WHEN 'select_activity' THEN '活動' ELSE '產品' END"
_CLICKS_B = f"""(SELECT {EVENT_B} AS event_name, item_name, stay_time, relation FROM record_b
    WHERE event_name IN ('select_brand', 'select_product', 'select_activity', 'select_related_product')
      AND event_date {DAYS} AND item_name IS NOT NULL) c"""
query("dash_b_scatter", f"""
    SELECT event_name, item_name AS name, count(*) AS click,
           CAST(sum(CAST(round_even(coalesce({rnd("stay_time / 60", 2)}, 0.5) * 100, 0) AS BIGINT)) AS DOUBLE) / 100 AS time
    FROM {_CLICKS_B} GROUP BY 1, 2""")(lambda t: dash.dash_b_scatter(t("record_b"), FIRST, LAST))
_B_CELLS = f"SELECT event_name, item_name, relation, count(*) AS value FROM {_CLICKS_B} WHERE relation IS NOT NULL GROUP BY 1, 2, 3"
query("dash_b_visitors", f"""
    WITH items AS (SELECT event_name, item_name, sum(value) AS clicks FROM ({_B_CELLS}) b GROUP BY 1, 2),
    chosen AS (
      SELECT 'top' AS "TB", event_name, item_name FROM (SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY clicks DESC, item_name) AS rn FROM items) x WHERE rn <= 5
      UNION ALL
      SELECT 'buttom', event_name, item_name FROM (SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY clicks, item_name DESC) AS rn FROM items) x WHERE rn <= 5)
    SELECT "TB", event_name, item_name, relation, coalesce(value, 0) AS value
    FROM chosen CROSS JOIN {FIVE} r(relation) LEFT JOIN ({_B_CELLS}) v USING (event_name, item_name, relation)""")(
    lambda t: dash.dash_b_visitors(t("record_b"), FIRST, LAST)
)
query("dash_b_recommend", f"""
    SELECT item_name, count FROM (SELECT item_name, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, item_name) AS rn
      FROM record_b WHERE event_name = 'select_related_product' AND item_name IS NOT NULL AND event_date {DAYS} GROUP BY 1) x
    WHERE rn <= 10 AND item_name <> '茶2'""")(lambda t: dash.dash_b_recommend(t("record_b"), FIRST, LAST))
query("dash_b_filters", f"""
    SELECT event_name, filter_name, count FROM (VALUES ('活動'), ('產品')) e(event_name) LEFT JOIN (
      SELECT event_name, filter_name, count(*) AS count, row_number() OVER (PARTITION BY event_name ORDER BY count(*) DESC, filter_name) AS rn
      FROM (SELECT CASE event_name WHEN 'select_filter_activity' THEN '活動' ELSE '產品' END AS event_name,
              unnest(string_split(item_name, ',')) AS filter_name FROM record_b
            WHERE event_name IN ('select_filter_activity', 'select_filter_product') AND event_date {DAYS}) f
      GROUP BY 1, 2) x USING (event_name) WHERE rn <= 10 OR rn IS NULL""")(
    lambda t: dash.dash_b_filters(t("record_b"), FIRST, LAST)
)
