"""Segment predicates and evaluators on the driver tables."""

from __future__ import annotations

from ..segments import (
    label_catalog,
    label_membership,
    predicate,
    rule,
    segment_all,
    segment_content,
    segment_include_exclude,
    segment_list,
    segment_test,
    segment_upload,
)
from ..segments.remarketing import sendable_below_quota
from .bindings import AS_OF_EVENT, AS_OF_PURCHASE
from .registry import query

ID = "CAST(member_id AS VARCHAR) AS member_id"


def _predicate(key: str, doc: dict, sql: str, as_of=AS_OF_PURCHASE) -> None:
    query(key, sql)(lambda t: predicate(t.context(as_of), doc))


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


# --- attributes, value label, AI labels -------------------------------------------------

for _key, _tag, _col, _values in [
    ("attr_gender", "性別", "gender", ["男"]),
    ("attr_birth_month", "生日", "birth_month", [1, 2, 12]),
    ("attr_city", "城市", "city", ["NATION_1", "NATION_7", "NATION_20"]),
    ("attr_store", "線下門市名稱", "store_source", ["store_1", "store_5"]),
    ("attr_level", "會員等級", "level", ["BUILDING", "MACHINERY"]),
    ("attr_source", "註冊管道", "source", ["web", "app"]),
]:
    _predicate(
        _key, rule("基本屬性", _tag, _values),
        f"SELECT {ID} FROM member WHERE {_col} IN {sql_list(_values)}",
    )
_predicate(
    "attr_age", rule("基本屬性", "年齡級距", {"low": 20, "high": 45}),
    f"SELECT {ID} FROM member WHERE age BETWEEN 20 AND 45",
)
_predicate(
    "attr_join_date", rule("基本屬性", "註冊日期", {"low": "1998-01-01", "high": "1999-06-30"}),
    f"SELECT {ID} FROM member WHERE join_date BETWEEN DATE '1998-01-01' AND DATE '1999-06-30'",
)
_predicate(
    "attr_brand_type", rule("基本屬性", "會員品牌歸屬", ["AFRICA", "EUROPE"]),
    f"SELECT {ID} FROM member WHERE type IN (SELECT id FROM name_map"
    " WHERE type = '會員' AND name IN ('AFRICA', 'EUROPE'))",
)
_predicate(
    "value_segment", rule("價值分群", "價值分群", ["BUILDING", "FURNITURE"]),
    f"SELECT {ID} FROM member_label WHERE value_label IN ('BUILDING', 'FURNITURE')",
)
for _key, _tag, _col in [
    ("ai_contribution", "消費貢獻力", "b0"),
    ("ai_repurchase", "顧客續購程度", "b1"),
    ("ai_churn", "流失風險", "b2"),
    ("ai_online_potential", "線上轉換潛力", "b3"),
    ("ai_ad_response", "廣告回應程度", "b4"),
    ("ai_lifecycle", "顧客生命週期", "b5"),
    ("ai_ltv", "顧客終身價值", "b7"),
]:
    _predicate(
        _key, rule("AI顧客分群", _tag, ["高", "中"]),
        f"SELECT {ID} FROM member_behavior WHERE {_col} IN ('高', '中')",
    )

# --- campaign reactions -----------------------------------------------------------------

CLEAN = "member_id NOT LIKE '%@%' AND member_id NOT LIKE '09%'"
RANGE = {"time_range": {"start_time": "2024-01-05 12:00:00", "end_time": "2024-01-20"}}
IN_RANGE = "touch_time BETWEEN TIMESTAMP '2024-01-05 12:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"


def _touch(key: str, web: str, tag: str, condition: str, more=None) -> None:
    _predicate(
        key, rule("渠道再行銷", tag, web=web, more=more),
        "SELECT DISTINCT member_id FROM channel_touch"
        f" WHERE channel = '{web}' AND {CLEAN} AND {condition}",
        AS_OF_EVENT,
    )


for _key, _web, _col in [("rmk_sendable", "Email", "email"), ("rmk_sendable_sms", "SMS", "sms")]:
    _predicate(
        _key, rule("渠道再行銷", "可寄送名單", web=_web),
        f"SELECT * FROM (SELECT {ID} FROM member_status WHERE {_col} = 'normal') t WHERE {CLEAN}",
    )
for _key, _web, _col in [("rmk_rating", "Email", "email"), ("rmk_rating_sms", "SMS", "sms")]:
    _predicate(
        _key, rule("渠道再行銷", "互動評級", ["高", "低"], web=_web),
        f"SELECT * FROM (SELECT DISTINCT {ID} FROM channel_user WHERE channel = '{_col}'"
        f" AND response IN ('高', '低')) t WHERE {CLEAN}",
    )
for _suffix, _web in [("", "Email"), ("_sms", "SMS")]:
    for _key, _tag, _action in [
        ("sent", "有寄出過", "sent"),
        ("opened", "有開信過", "open"),
        ("clicked", "有點擊過", "click"),
        ("converted", "有轉換過", "buy"),
    ]:
        _test = f"action = '{_action}'"
        if _web == "SMS" and _action == "open":
            _test = "1 = 0"
        _touch(f"rmk_{_key}{_suffix}", _web, _tag, _test)
        _touch(f"rmk_{_key}_range{_suffix}", _web, _tag, f"{_test} AND {IN_RANGE}", RANGE)
_touch(
    "rmk_clicked_last_days", "Email", "有點擊過",
    "action = 'click' AND touch_time BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31'",
    {"time_range": {"days": 7}, "event": "r_1"},
)
_touch(
    "rmk_rule_prefix", "Email", "有轉換過",
    "family = 'script' AND rule_id LIKE 've\\_%' ESCAPE '\\' AND action = 'buy'", {"event": "ve_"},
)
_touch(
    "rmk_rule_prefix_sent", "Email", "有寄出過",
    "family = 'script' AND rule_id LIKE 've\\_2%' ESCAPE '\\'", {"event": "ve_2"},
)
_touch(
    "rmk_rule_prefix_main", "Email", "有點擊過",
    "family = 'main' AND rule_id LIKE 'r\\_%' ESCAPE '\\' AND action = 'click'", {"event": "r_"},
)
_touch(
    "rmk_rule_prefix_sms", "SMS", "有點擊過",
    "family = 'script' AND rule_id LIKE 'vs\\_%' ESCAPE '\\' AND action = 'click'", {"event": "vs_"},
)
_touch(
    "rmk_rule_exact", "SMS", "有轉換過",
    "family = 'main' AND rule_id = 'r_3' AND action = 'buy'", {"event": "r_3"},
)
for _key, _web, _col in [("rmk_quota", "Email", "email"), ("rmk_quota_sms", "SMS", "sms")]:
    query(
        _key,
        f"""SELECT CAST(s.member_id AS VARCHAR) AS member_id FROM member_status s
            JOIN quota q ON CAST(s.member_id AS VARCHAR) = q.member_id
            WHERE s.{_col} = 'normal'
              AND q.daily < (SELECT daily FROM quota WHERE member_id = 'limit')
              AND q.weekly < (SELECT weekly FROM quota WHERE member_id = 'limit')
              AND q.monthly < (SELECT monthly FROM quota WHERE member_id = 'limit')
              AND q.yearly < (SELECT yearly FROM quota WHERE member_id = 'limit')""",
    )(lambda t, web=_web: sendable_below_quota(t.context(), web).distinct())

# --- purchases --------------------------------------------------------------------------

BUY_RANGE = {"start_time": "2000-01-01", "end_time": "2001-08-02"}
IN_BUY_RANGE = "date BETWEEN DATE '2000-01-01' AND DATE '2001-08-02'"


def _buy_more(count=None, cost=None, time_range=BUY_RANGE) -> dict:
    return {"time_range": time_range, "count": count or {}, "cost": cost or {}}


_predicate(
    "pur_none",
    rule("消費行為", "未購買的人", web="線上",
         more=_buy_more(time_range={"start_time": "2001-01-01", "end_time": "2001-08-02"})),
    f"""SELECT {ID} FROM member m WHERE online = 1 AND NOT EXISTS (SELECT 1 FROM purchase p
        WHERE p.member_id = m.member_id AND date BETWEEN DATE '2001-01-01' AND DATE '2001-08-02')""",
)
_EVERY_ORDER = """SELECT member_id, order_id, sum(sales) AS total FROM purchase
    WHERE member_id IS NOT NULL AND {test} GROUP BY member_id, order_id"""
_predicate(
    "pur_buyers",
    rule("消費行為", "有購買的人", web="整體",
         more=_buy_more({"count": 3, "moreOrless": "以上(含)"}, {"moreOrlessForCost": "大於", "cost": 20000})),
    f"""SELECT {ID} FROM ({_EVERY_ORDER.format(test=IN_BUY_RANGE)}) o
        GROUP BY member_id HAVING count(*) >= 3 AND bool_and(total >= 20000)""",
)
_predicate(
    "pur_buyers_default",
    rule("消費行為", "有購買的人", web="線下"),
    f"""SELECT {ID} FROM ({_EVERY_ORDER.format(
        test="online = 0 AND date BETWEEN DATE '2000-01-01' AND DATE '2001-08-02'")}) o
        GROUP BY member_id HAVING count(*) > 0 AND bool_and(total > 0)""",
)
_predicate(
    "pur_first",
    rule("消費行為", "首購的人", web="線上",
         more=_buy_more(cost={"moreOrlessForCost": "大於", "lowCost": 5000, "highCost": 400000})),
    f"""SELECT {ID} FROM member WHERE online = 1
        AND join_date BETWEEN DATE '2000-01-01' AND DATE '2001-08-02'
        AND member_id IN (SELECT member_id FROM
          ({_EVERY_ORDER.format(test="online = 1 AND " + IN_BUY_RANGE)}) o
          GROUP BY member_id HAVING bool_and(total BETWEEN 5000 AND 400000))""",
)
for _key, _tag, _col, _values in [
    ("pur_product", "購買的商品名稱", "product_name", ["small ring", "red widget", "blue bolt"]),
    ("pur_category", "購買的類別名稱", "category_name", ["ECONOMY", "SMALL"]),
    ("pur_brand", "購買的品牌名稱", "brand_name", ["Brand#2", "Brand#4", "Brand#17"]),
]:
    _predicate(
        _key,
        rule("消費行為", _tag, _values, "整體",
             _buy_more({"count": 2, "moreOrless": "以上(含)"}, {"moreOrlessForCost": "大於", "cost": 1500})),
        f"""SELECT {ID} FROM purchase WHERE member_id IS NOT NULL AND {IN_BUY_RANGE}
            AND product_id IN (SELECT product_id FROM brand WHERE {_col} IN {sql_list(_values)})
            GROUP BY member_id HAVING count(DISTINCT order_id) >= 2 AND bool_and(sales >= 1500)""",
    )
for _key, _tag, _col, _values in [
    ("pur_amount_grade", "消費金額分級", "monetary", ["高"]),
    ("pur_aov_grade", "客單價分級", "aov", ["高", "低"]),
    ("pur_freq_grade", "消費頻率分級", "frequency", ["中"]),
    ("pur_recency_grade", "距離上次購買分級", "last_purchase", ["近", "遠"]),
]:
    _predicate(
        _key, rule("消費行為", _tag, _values, "整體"),
        f"SELECT {ID} FROM member_label WHERE {_col} IN {sql_list(_values)}",
    )
_predicate(
    "pur_amount_total",
    rule("消費行為", "累計消費金額", {"moreOrless": "大於", "low": 200000, "high": 900000}, "整體", _buy_more()),
    f"""SELECT {ID} FROM purchase WHERE member_id IS NOT NULL AND {IN_BUY_RANGE}
        GROUP BY member_id HAVING sum(sales) BETWEEN 200000 AND 900000""",
)
_predicate(
    "pur_aov",
    rule("消費行為", "平均客單價", {"moreOrless": "小於", "cost": 150000}, "線上", _buy_more()),
    f"""SELECT {ID} FROM purchase WHERE member_id IS NOT NULL AND online = 1 AND {IN_BUY_RANGE}
        GROUP BY member_id HAVING sum(sales) <= 150000 * count(DISTINCT order_id)""",
)
_predicate(
    "pur_freq",
    rule("消費行為", "累計消費次數", {"moreOrless": "大於", "cost": 4}, "線下", _buy_more()),
    f"""SELECT {ID} FROM purchase WHERE member_id IS NOT NULL AND online = 0 AND {IN_BUY_RANGE}
        GROUP BY member_id HAVING count(DISTINCT order_id) >= 4""",
)
_predicate(
    "pur_recency_days",
    rule("消費行為", "距離上次購買天數區隔", {"low": 30, "high": 200}, "線上"),
    f"""SELECT {ID} FROM purchase WHERE member_id IS NOT NULL AND online = 1 GROUP BY member_id
        HAVING date_diff('day', max(date), DATE '2001-08-02') BETWEEN 30 AND 200""",
)

# --- web behaviour ----------------------------------------------------------------------

WEB_RANGE = {"start_time": "2024-01-03", "end_time": "2024-01-25"}
IN_WEB_RANGE = "date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'"
MAPPED = "SELECT DISTINCT CAST(m.member_id AS VARCHAR) AS member_id FROM ({0}) v JOIN cid_map m ON m.cid = v.cid"


def _web(key: str, kind: str, tag: str, value, sql: str, count=None, time_range=WEB_RANGE) -> None:
    more = {"time_range": time_range, "count": count or {}} if time_range else None
    _predicate(key, rule(kind, tag, value, "main", more), MAPPED.format(sql), AS_OF_EVENT)


_web("off_interest", "CF站外瀏覽", "興趣標籤", ["i1", "i4"],
     f"SELECT ga_id AS cid FROM interest_prefer WHERE value IN ('i1', 'i4') AND {IN_WEB_RANGE}")
_web("off_media", "CF站外瀏覽", "關注媒體類型標籤", ["m2"],
     f"SELECT ga_id AS cid FROM media_prefer WHERE value = 'm2' AND {IN_WEB_RANGE}")
ON = "網站行為"
_web("web_item", ON, "造訪商品名稱", ["small ring", "red widget", "blue bolt"],
     f"""SELECT cid FROM view_log WHERE item IN ('small ring', 'red widget', 'blue bolt')
         AND {IN_WEB_RANGE} GROUP BY cid HAVING count(item) >= 2""",
     {"count": 2, "moreOrless": "以上(含)"})
_web("web_category", ON, "造訪商品類別", ["ECONOMY"],
     f"""SELECT cid FROM view_log WHERE item IN (SELECT product_name FROM brand WHERE category_name = 'ECONOMY')
         AND {IN_WEB_RANGE} GROUP BY cid HAVING count(item) <= 15""",
     {"count": 15, "moreOrless": "以下(含)"})
_web("web_brand", ON, "造訪品牌名稱", ["Brand#2", "Brand#17"],
     f"""SELECT cid FROM view_log WHERE item IN (SELECT product_name FROM brand WHERE brand_name IN ('Brand#2', 'Brand#17'))
         AND {IN_WEB_RANGE} GROUP BY cid HAVING count(item) = 12""",
     {"count": 12, "moreOrless": "-"})
_web("web_page_type", ON, "造訪頁面類別", {"page_ECONOMY": []},
     f"""SELECT cid FROM view_log WHERE item IN (SELECT title FROM refer WHERE genre = 'ECONOMY')
         AND {IN_WEB_RANGE} GROUP BY cid HAVING count(item) > 0""")
_web("web_page_titles", ON, "造訪頁面類別", {"page_SMALL": ["red widget", "blue bolt"]},
     f"""SELECT cid FROM view_log WHERE item IN ('red widget', 'blue bolt')
         AND {IN_WEB_RANGE} GROUP BY cid HAVING count(item) > 0""")
IN_START = "start_time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'"
_web("web_visited", ON, "有造訪過網站", [],
     f"SELECT cid FROM web_session WHERE {IN_START} GROUP BY cid HAVING count(cid) >= 17",
     {"count": 17, "moreOrless": "以上(含)"})
_web("web_logged_in", ON, "有登入過", [],
     f"SELECT cid FROM web_session WHERE {IN_START} AND login = 1 GROUP BY cid HAVING count(cid) > 0")
_web("web_avg_minutes", ON, "平均瀏覽時長", {"low": 300, "high": 500},
     f"""SELECT cid FROM web_session WHERE {IN_START} GROUP BY cid
         HAVING avg(date_sub('second', start_time, end_time)) / 60 BETWEEN 300 AND 500""")
_web("web_cart_abandon", ON, "有加入購物車但未結", [],
     f"""SELECT cid FROM cart_buy WHERE {IN_WEB_RANGE} GROUP BY cid
         HAVING count(*) FILTER (type = 'cart') > 0 AND count(*) FILTER (type = 'conversion') = 0""")
_web("web_converted", ON, "有轉換過", [],
     f"SELECT cid FROM cart_buy WHERE {IN_WEB_RANGE} AND type = 'conversion'")
_web("web_converted_ever", ON, "有轉換過", [],
     "SELECT cid FROM cart_buy WHERE type = 'conversion'", time_range=None)
for _key, _tag, _col, _value in [
    ("web_utm_source", "utm campaign source", "source", "fb"),
    ("web_utm_medium", "utm campaign medium", "medium", "organic"),
    ("web_utm_campaign", "utm campaign name", "campaign", "c3"),
]:
    _web(_key, ON, _tag, [_value],
         f"SELECT cid FROM utm WHERE {_col} = '{_value}' AND date BETWEEN DATE '2024-01-03' AND DATE '2024-01-04'",
         time_range={"start_time": "2024-01-03", "end_time": "2024-01-04"})

# --- tenant predicates ------------------------------------------------------------------

_LINE = """SELECT DISTINCT CAST(member_id AS VARCHAR) AS member_id FROM member
    WHERE line_id IN (SELECT line_id FROM line_custom WHERE {0})
       OR line_id2 IN (SELECT line_id FROM line_custom WHERE {0})"""
_predicate("custom_line_value", rule("LineValue_1", "-", ["v1", "v4"], "main_click"),
           _LINE.format("type = 'click' AND value IN ('v1', 'v4')"))
_predicate("custom_line_tag_value", rule("LineTag_1", "t2", ["v0", "v2"], "main_view"),
           _LINE.format("type = 'view' AND tag = 't2' AND value IN ('v0', 'v2')"))

query("custom_registry", f"""
    SELECT * FROM ({_LINE.format("type = 'click' AND value IN ('v1', 'v4')")}) a
    INTERSECT SELECT * FROM ({_LINE.format("type = 'view' AND tag = 't2' AND value IN ('v0', 'v2')")}) b""")(
    # both rules reach the tenant's predicates by the prefix of their type
    lambda t: segment_content(
        t.context(),
        [
            rule("LineValue_1", "-", ["v1", "v4"], "main_click"),
            rule("LineTag_1", "t2", ["v0", "v2"], "main_view", mode="且"),
        ],
    )
)

# --- evaluators -------------------------------------------------------------------------

BUYERS = rule(
    "消費行為", "有購買的人", [], "整體",
    _buy_more({"count": 3, "moreOrless": "以上(含)"}, {"moreOrlessForCost": "大於", "cost": 20000}),
)
RULES = [
    BUYERS,
    rule("基本屬性", "會員等級", ["BUILDING"], mode="且"),
    rule(ON, "有加入購物車但未結", [], "main", {"time_range": WEB_RANGE, "count": {}}, mode="或"),
    rule("基本屬性", "性別", ["男"], mode="忽略"),
]
_BUYER_SQL = f"""SELECT {ID} FROM ({_EVERY_ORDER.format(test=IN_BUY_RANGE)}) o
    GROUP BY member_id HAVING count(*) >= 3 AND bool_and(total >= 20000)"""
_CART_SQL = MAPPED.format(
    f"""SELECT cid FROM cart_buy WHERE {IN_WEB_RANGE} GROUP BY cid
    HAVING count(*) FILTER (type = 'cart') > 0 AND count(*) FILTER (type = 'conversion') = 0"""
)
_CONTENT_SQL = f"""(({_BUYER_SQL}) INTERSECT (SELECT {ID} FROM member WHERE level = 'BUILDING'))
    UNION ({_CART_SQL})"""
CONTENTS = {
    "C_mixed": RULES,
    "C_men": [rule("基本屬性", "性別", ["男"])],
    "C_web": [rule(ON, "有轉換過", [], "main"), rule("基本屬性", "城市", ["NATION_3"], mode="或")],
}
_WEB_SQL = f"""{MAPPED.format("SELECT cid FROM cart_buy WHERE type = 'conversion'")}
    UNION SELECT {ID} FROM member WHERE city = 'NATION_3'"""

query("segment_content", _CONTENT_SQL)(lambda t: segment_content(t.context(), RULES))
query("segment_all", f"SELECT {ID} FROM member")(lambda t: segment_all(t.context()))
query("segment_list", f"""
    SELECT DISTINCT {ID} FROM (
      SELECT c_custkey AS member_id FROM customer WHERE c_nationkey = 4
      UNION SELECT c_custkey + 1 FROM customer WHERE c_nationkey = 4) t""")(
    lambda t: segment_list(t.context(), "SS_NATION_4")
)
_COMPLEMENT_SQL = f"""SELECT {ID} FROM member WHERE member_id NOT IN (
      SELECT c_custkey FROM customer WHERE c_nationkey = 5
      UNION SELECT c_custkey + 1 FROM customer WHERE c_nationkey = 5)"""
query("segment_list_complement", _COMPLEMENT_SQL)(
    lambda t: segment_list(t.context(), "SS_NATION_5")
)
query("segment_upload", f"""
    SELECT DISTINCT {ID} FROM (
      SELECT c_custkey AS member_id FROM customer WHERE c_nationkey = 7
      UNION SELECT c_custkey + 2 FROM customer WHERE c_nationkey = 7) t""")(
    lambda t: segment_upload(t.context(), "U_7").distinct()
)
query("segment_test", """
    SELECT c_name || '@x' AS member_id FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'""")(
    lambda t: segment_test(t.context(), "T_BUILDING", "email")
)
INCLUDE_ROWS = [
    ("C_mixed", 1), ("ALL", 0), ("C_web", 1), ("U_7", 0), ("SS_NATION_5", 1), ("C_men", 0), ("T_BUILDING", 1),
]
query("segment_include_exclude", f"""
    SELECT member_id FROM (
      SELECT member_id FROM (
        ((({_WEB_SQL}) EXCEPT (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 7
           UNION SELECT CAST(c_custkey + 2 AS VARCHAR) FROM customer WHERE c_nationkey = 7))
         UNION ({_COMPLEMENT_SQL}))
        EXCEPT (SELECT CAST(member_id AS VARCHAR) FROM member WHERE gender = '男')) a
      UNION SELECT c_name || '@x' FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING') b""")(
    lambda t: segment_include_exclude(t.context(AS_OF_EVENT, CONTENTS), INCLUDE_ROWS)
)
query("label_catalog", 'SELECT label_id AS "labelId", name AS label FROM label_doc')(
    lambda t: label_catalog(t("label_doc"))
)
LABELS = {"C_mixed": "mixed", "C_men": "men", "C_web": "web"}
query("label_membership", f"""
    SELECT member_id, 'C_mixed' AS "labelId", 'mixed' AS label FROM ({_CONTENT_SQL}) a
    UNION ALL SELECT {ID}, 'C_men', 'men' FROM member WHERE gender = '男'
    UNION ALL SELECT member_id, 'C_web', 'web' FROM ({_WEB_SQL}) c""")(
    lambda t: label_membership(t.context(AS_OF_EVENT, CONTENTS), LABELS)
)
