"""The driver's tables bound to the logical tables of the library.

Each binding is one portable SELECT: Spark runs it as a view, the check SQL
takes the same text as a CTE. ``{name}`` refers to a driver table or to another
binding. Derived columns are integer arithmetic on keys, so that both engines
agree; no binding restricts a table to a part of its ids.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..segments import SegmentContext
from ..segments import custom as custom_predicates
from ..session import scratch_path
from ..sources import read_table

AS_OF_PURCHASE = date(2001, 8, 2)
AS_OF_EVENT = datetime(2024, 1, 31)

# Physical schemas, given so that no scan has to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

GRADE = "CASE c_custkey % {0} WHEN 0 THEN '高' WHEN 1 THEN '中' ELSE '低' END"
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
SESSION = (
    "CASE WHEN event_id % 17 = 0 THEN NULL"
    " ELSE CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) END"
)
GROUP = (
    "CASE WHEN event_id % 23 = 0 THEN NULL"
    " ELSE CAST(user_id AS STRING) || '_' || CAST(CAST(ts AS DATE) AS STRING) END"
)

BINDINGS = {
    "member": """
SELECT c_custkey AS member_id,
       CASE WHEN c_custkey % 10 = 9 THEN 'G' ELSE 'M' END || CAST(c_custkey AS STRING) AS member,
       CASE WHEN c_custkey % 2 = 0 THEN '男' ELSE '女' END AS gender,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 95 AS INT) END AS age,
       CAST(c_custkey % 12 + 1 AS INT) AS birth_month,
       n_name AS city,
       'store_' || CAST(c_custkey % 7 AS STRING) AS store_source,
       c_mktsegment AS level,
       CASE c_custkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END AS source,
       DATE '1996-01-01' + CAST((c_custkey * 7) % 2039 AS INT) AS join_date,
       'T' || CAST(n_regionkey AS STRING) AS type,
       CAST(c_custkey % 2 AS INT) AS online,
       'L' || CAST(c_custkey AS STRING) AS line_id,
       'L' || CAST(c_custkey + 100000 AS STRING) AS line_id2,
       CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'Y' ELSE 'N' END AS marriage,
       n_regionkey AS region_sort
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "purchase": """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS member_id,
       o_orderkey AS order_id,
       CASE WHEN l_partkey % 40 = 0 THEN 'D' ELSE '' END || CAST(l_partkey AS STRING) AS product_id,
       CAST(o_orderdate AS DATE) AS date,
       CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS online,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS add_on,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS sales,
       CAST(l_quantity AS INT) AS count
FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey""",
    "brand": """
SELECT CASE WHEN p_partkey % 40 = 0 THEN 'D' ELSE '' END || CAST(p_partkey AS STRING) AS product_id,
       p_name AS product_name, p_type AS category_name, p_brand AS brand_name
FROM {part}""",
    "member_stat": """
SELECT o_custkey AS member_id,
       {days}(DATE '2001-08-02', CAST(max(o_orderdate) AS DATE)) AS r,
       count(DISTINCT o_orderkey) AS f,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS m
FROM {orders} GROUP BY o_custkey""",
    "member_behavior": "\nSELECT c_custkey AS member_id, "
    + ", ".join(f"{GRADE.format(i + 3)} AS b{b}" for i, b in enumerate((0, 1, 2, 3, 4, 5, 7)))
    + "\nFROM {customer}",
    "member_label": f"""
SELECT c_custkey AS member_id, c_mktsegment AS value_label,
       CASE WHEN c_acctbal > 6000 THEN '高' WHEN c_acctbal > 2000 THEN '中' ELSE '低' END AS monetary,
       {GRADE.format(3)} AS aov, {GRADE.format(4)} AS frequency,
       CASE c_custkey % 5 WHEN 0 THEN '近' WHEN 1 THEN '中' ELSE '遠' END AS last_purchase
FROM {{customer}}""",
    "name_map": """
SELECT r_name AS name, 'T' || CAST(r_regionkey AS STRING) AS id, '會員' AS type FROM {region}
UNION ALL
SELECT DISTINCT 'page_' || p_type, 'P' || p_type, p_type FROM {part}""",
    "web_event": f"""
SELECT event_id, user_id AS cid, ts, CAST(ts AS DATE) AS event_date, event_type AS event_name,
       {K} AS k, value, {SESSION} AS ga_session_id
FROM {{events}}""",
    "view_log": f"""
SELECT user_id AS cid, CAST(ts AS DATE) AS date, p_name AS item
FROM {{events}} JOIN {{part}} ON {K} = p_partkey
WHERE event_type IN ('view', 'click')""",
    "cart_buy": """
SELECT user_id AS cid, CAST(ts AS DATE) AS date,
       CASE WHEN event_type = 'click' THEN 'cart' ELSE 'conversion' END AS type
FROM {events}
WHERE event_type = 'click' OR (event_type = 'purchase' AND value > 120)""",
    "web_session": """
SELECT user_id AS cid, min(ts) AS start_time, max(ts) AS end_time,
       max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS login
FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    "utm": """
SELECT user_id AS cid, CAST(ts AS DATE) AS date,
       CASE event_id % 3 WHEN 0 THEN 'google' WHEN 1 THEN 'fb' ELSE 'line' END AS source,
       CASE event_id % 2 WHEN 0 THEN 'cpc' ELSE 'organic' END AS medium,
       'c' || CAST(event_id % 5 AS STRING) AS campaign
FROM {events}""",
    "refer": """
SELECT DISTINCT p_name AS title, CASE WHEN p_size % 10 = 0 THEN 'x0' ELSE p_type END AS genre
FROM {part}""",
    "cid_map": """
SELECT c_custkey AS cid, c_custkey AS member_id FROM {customer} WHERE c_acctbal > 1000""",
    "interest_prefer": """
SELECT user_id AS ga_id, CAST(ts AS DATE) AS date, 'i' || CAST(event_id % 11 AS STRING) AS value
FROM {events} WHERE event_type = 'view'""",
    "media_prefer": """
SELECT user_id AS ga_id, CAST(ts AS DATE) AS date, 'm' || CAST(event_id % 7 AS STRING) AS value
FROM {events} WHERE event_type = 'click'""",
    "line_custom": """
SELECT 'L' || CAST(user_id + CASE WHEN event_id % 2 = 0 THEN 0 ELSE 100000 END AS STRING) AS line_id,
       event_type AS type, 't' || CAST(event_id % 4 AS STRING) AS tag, 'v' || CAST(event_id % 6 AS STRING) AS value
FROM {events}""",
    "channel_touch": """
SELECT CASE WHEN user_id % 29 = 0 THEN 'u' || CAST(user_id AS STRING) || '@x'
            WHEN user_id % 31 = 0 THEN '09' || CAST(user_id AS STRING)
            ELSE CAST(user_id AS STRING) END AS member_id,
       CASE event_id % 2 WHEN 0 THEN 'Email' ELSE 'SMS' END AS channel,
       CASE event_id % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'vice' ELSE 'script' END AS family,
       CASE event_type WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'open' WHEN 'click' THEN 'click' ELSE 'buy' END AS action,
       CASE event_id % 3 WHEN 2 THEN CASE event_id % 2 WHEN 0 THEN 've_' ELSE 'vs_' END ELSE 'r_' END
         || CAST(event_id % 7 AS STRING) AS rule_id,
       ts AS touch_time
FROM {events} WHERE event_type <> 'error'""",
    "channel_user": f"""
SELECT c_custkey AS member_id, 'email' AS channel, CASE c_custkey % 4 WHEN 0 THEN '高' WHEN 1 THEN '中' WHEN 2 THEN '低' ELSE '無' END AS response
FROM {{customer}} WHERE c_acctbal > 0
UNION ALL
SELECT c_custkey, 'sms', {GRADE.format(3)} FROM {{customer}} WHERE c_acctbal > 2000
UNION ALL
SELECT c_custkey, 'fb', '無' FROM {{customer}} WHERE c_acctbal > 6000""",
    "member_status": """
SELECT c_custkey AS member_id,
       CASE WHEN c_custkey % 6 = 0 THEN 'blocked' ELSE 'normal' END AS email,
       CASE WHEN c_custkey % 8 = 0 THEN 'blocked' ELSE 'normal' END AS sms
FROM {customer}""",
    "quota": """
SELECT CAST(c_custkey AS STRING) AS member_id, CAST(c_custkey % 3 AS INT) AS daily,
       CAST(c_custkey % 6 AS INT) AS weekly, CAST(c_custkey % 11 AS INT) AS monthly,
       CAST(c_custkey % 101 AS INT) AS yearly
FROM {customer}
UNION ALL SELECT 'limit', 2, 5, 9, 90""",
    "label_member": """
SELECT CAST(c_custkey AS STRING) AS member_id, 'C_' || c_mktsegment AS label_id, c_mktsegment AS label
FROM {customer}""",
    "label_doc": """
SELECT DISTINCT 'C_' || c_mktsegment AS label_id, c_mktsegment AS name FROM {customer}
UNION ALL SELECT 'C_none', 'nobody'""",
    "test_list": """
SELECT 'T_' || c_mktsegment AS label_id,
       '["' || c_name || '@x", "' || CAST(c_custkey AS STRING) || '"]' AS email,
       '["09' || CAST(c_custkey AS STRING) || '"]' AS phone
FROM {customer}""",
    "stored_list": """
SELECT 'SS_' || n_name AS label_id,
       '{{"content": "[' || CAST(c_custkey AS STRING) || ', ' || CAST(c_custkey + 1 AS STRING) || ']"}}' AS list,
       CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS include
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "detect_record": f"""
SELECT event_id, ts AS visittime, {GROUP} AS group_id,
       CASE event_id % 7 WHEN 0 THEN '家庭' WHEN 1 THEN '情侶' WHEN 2 THEN '朋友' WHEN 3 THEN 'male' WHEN 4 THEN 'female' WHEN 5 THEN '' ELSE NULL END AS relation,
       CAST(event_id % 80 AS STRING) || '歲' AS age,
       CASE event_id % 2 WHEN 0 THEN '男' ELSE '女' END AS gender,
       '10.0.0.1_' || CASE user_id % 3 WHEN 0 THEN '17d5dffb' WHEN 1 THEN 'b97bc201' ELSE 'other' END AS pcid,
       CAST({K} AS STRING) || '.5 sec' AS staytime,
       CASE event_id % 9 WHEN 0 THEN 'family' WHEN 1 THEN 'couple' WHEN 2 THEN 'friend' WHEN 3 THEN 'male'
            WHEN 4 THEN 'female' WHEN 5 THEN '' WHEN 6 THEN '家庭' ELSE NULL END AS relation_group
FROM {{events}}""",
    "schedule": """
SELECT event_type AS script_name, 's' || CAST(event_id AS STRING) AS name, ts AS schedule_time,
       CASE event_id % 2 WHEN 0 THEN 'Email' ELSE 'SMS' END AS channel
FROM {events}""",
    # flat form of the first kiosk's events; the Spark side packs it into nested parameters
    "kiosk_a": f"""
SELECT event_id, CAST(ts AS DATE) AS event_date, ts,
       CASE event_type WHEN 'view' THEN '點擊下方項目' WHEN 'click' THEN '點擊地圖項目'
            WHEN 'purchase' THEN '點擊購物更多資訊' WHEN 'signup' THEN '點擊課程更多資訊' ELSE '其他' END AS event_name,
       {SESSION} AS ga_session_id,
       CASE WHEN {K} % 4 = 0 THEN NULL ELSE 'item_' || CAST({K} AS STRING) END AS item_name,
       CASE event_id % 5 WHEN 0 THEN 'course_' || CAST({K} % 10 AS STRING) WHEN 1 THEN '' ELSE NULL END AS course_name,
       CASE event_id % 3 WHEN 0 THEN 'https://kiosk/locationA1/' WHEN 1 THEN 'https://kiosk/locationI/' ELSE 'https://kiosk/other/' END
         || CASE event_id % 6 WHEN 0 THEN 'HomePage' WHEN 1 THEN 'MapArchive' WHEN 2 THEN 'Intro' WHEN 3 THEN 'CoursePage' WHEN 4 THEN 'ShopPage' ELSE 'X' END AS page_url,
       {GROUP} AS group_id
FROM {{events}}""",
    # flat form of the second kiosk's events
    "kiosk_b": f"""
SELECT event_id, CAST(ts AS DATE) AS event_date, ts,
       CASE event_type WHEN 'view' THEN 'select_product' WHEN 'click' THEN 'select_related_product'
            WHEN 'purchase' THEN 'select_brand' WHEN 'signup' THEN 'select_activity'
            ELSE CASE event_id % 3 WHEN 0 THEN 'select_homepage' WHEN 1 THEN 'select_filter_product' ELSE 'select_filter_activity' END END AS event_name,
       {SESSION} AS ga_session_id,
       CASE WHEN {K} % 10 = 0 THEN NULL
            WHEN event_type = 'error' THEN 'f' || CAST({K} % 12 AS STRING) || ',f' || CAST({K} % 5 AS STRING)
            WHEN {K} % 7 = 3 THEN '茶2'
            ELSE 'item_' || CAST({K} % 30 AS STRING) END AS item_name,
       'https://kiosk/b/' || CAST(event_id % 4 AS STRING) AS page_url,
       CASE WHEN event_id % 19 = 0 THEN '' ELSE {GROUP} END AS group_id,
       CASE WHEN event_type = 'purchase' THEN 'brand_' || CAST({K} % 6 AS STRING) ELSE NULL END AS brand_name
FROM {{events}}""",
    # records the dashboards read, in flat form
    "record_a": f"""
SELECT event_id, CAST(ts AS DATE) AS event_date, ts AS event_timestamp,
       CASE event_type WHEN 'view' THEN '點擊下方項目' WHEN 'click' THEN '點擊地圖項目'
            WHEN 'purchase' THEN '點擊購物更多資訊' WHEN 'signup' THEN '點擊課程更多資訊' ELSE '其他' END AS event_name,
       CASE WHEN {K} % 10 = 0 THEN NULL ELSE 'item_' || CAST({K} % 40 AS STRING) END AS item_name,
       CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST({K} AS DOUBLE) END AS stay_time,
       CASE event_id % 6 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN '朋友' WHEN 3 THEN 'couple' WHEN 4 THEN '家庭' ELSE NULL END AS relation,
       CASE user_id % 3 WHEN 0 THEN 'A1' WHEN 1 THEN 'I' ELSE NULL END AS location
FROM {{events}}""",
    "record_b": f"""
SELECT event_id, event_date, ts AS event_timestamp, event_name, item_name, brand_name,
       CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(event_id % 31 AS DOUBLE) END AS stay_time,
       CASE event_id % 7 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'friend' WHEN 3 THEN 'couple' WHEN 4 THEN 'family' WHEN 5 THEN '' ELSE NULL END AS relation
FROM {{kiosk_b}}""",
    "activity": """
SELECT event_type AS activity_id, 'activity ' || event_type AS activity_name,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(min(ts) AS DATE) + 3 END AS start_date,
       CAST(max(ts) AS DATE) - 40 AS end_date, count(*) AS time
FROM {events} GROUP BY event_type
UNION ALL SELECT 'dormant', 'activity dormant', DATE '2024-01-05', DATE '2024-02-01', 0""",
    # interactions with cases (products by name), for the hybrid recommender
    "case_event": f"""
SELECT user_id AS member_id, p_name AS item, event_type AS kind, {K} % 3 + 1 AS times
FROM {{events}} JOIN {{part}} ON {K} = p_partkey""",
    "case_info": """
SELECT p_name AS item, min(p_brand) AS city, min(p_type) AS class, min(p_size) AS num_room
FROM {part} WHERE p_size > 5 GROUP BY p_name""",
    # priced product clicks, named like the recommender expects
    "product_click": f"""
SELECT user_id AS cid, CASE event_type WHEN 'click' THEN 'select_product' ELSE event_type END AS event_name,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE p_name END AS product_name,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE p_retailprice END AS product_price
FROM {{events}} JOIN {{part}} ON {K} = p_partkey""",
    # score tables derived from the data: pieces bought, clicks made
    "purchase_scores": """
SELECT member_id, CAST(product_id AS INT) AS product_id, CAST(sum(count) AS DOUBLE) AS rating
FROM {purchase} WHERE member_id IS NOT NULL AND product_id NOT LIKE 'D%' GROUP BY member_id, product_id""",
    "click_scores": f"""
SELECT user_id AS member_id, CAST({K} AS INT) AS product_id, CAST(count(*) AS DOUBLE) AS rating
FROM {{events}} WHERE event_type = 'click' GROUP BY user_id, {K}""",
}

NAMES = re.compile(r"\{(\w+)\}")


def references(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(NAMES.findall(sql)) if n in BINDINGS or n in SCHEMAS]


_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Tables:
    """Driver and logical tables by name, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._made = spark, root, {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name == "upload_list":
                self._made[name] = self._upload_list()
            elif name in BINDINGS:
                sql = BINDINGS[name]
                used = {n: self(n) for n in references(sql)}
                self._made[name] = self.spark.sql(
                    re.sub(r"\{days\}\(", "datediff(", sql), **used
                )
            else:
                self._made[name] = read_table(
                    self.spark, name, root=self.root, schema=SCHEMAS[name]
                )
        return self._made[name]

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table Spark derives from the others, written once per session and read back.

        For inputs that are stored as such in reality (nested events): reading
        them from files keeps their making out of the queries' plans.
        """
        key = (self.spark.sparkContext.applicationId, self.root, name)
        if key not in _STORED:
            path = scratch_path(self.spark, name)
            df = make()
            df.write.parquet(path)
            _STORED[key] = (path, df.schema)
        path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    def _upload_list(self) -> DataFrame:
        """Uploaded lists: arrays of member ids, one document per customer and nation."""
        return self("customer").select(
            F.concat(F.lit("U_"), F.col("c_nationkey").cast("string")).alias("label_id"),
            F.array("c_custkey", F.col("c_custkey") + 2).alias("members"),
        )

    def context(self, as_of=AS_OF_PURCHASE, contents=None) -> SegmentContext:
        custom = {
            "LineValue": custom_predicates.line_value,
            "LineTag": custom_predicates.line_tag_value,
        }
        return SegmentContext(self, as_of, custom=custom, contents=contents or {})


def with_bindings(sql: str) -> str:
    """The check SQL with the bindings it names in front, for the other engine."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed or name not in BINDINGS:
            return
        for other in references(BINDINGS[name]):
            add(other)
        needed.append(name)

    for name in BINDINGS:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
            add(name)
    if not needed:
        return sql.strip()
    ctes = []
    for name in needed:
        text = re.sub(
            r"\{days\}\(([^,]+), (CAST\(max\(o_orderdate\) AS DATE\))\)",
            r"date_diff('day', \2, \1)",
            BINDINGS[name],
        )
        plain = {n: n for n in references(text)}
        ctes.append(f"{name} AS ({text.format(**plain).strip()}\n)")
    head = "WITH " if "RECURSIVE" not in sql else "WITH RECURSIVE "
    body = sql.strip()
    if re.match(r"WITH\s", body, re.IGNORECASE):
        return head + ",\n".join(ctes) + ",\n" + re.sub(r"^WITH\s+", "", body, flags=re.IGNORECASE)
    return head + ",\n".join(ctes) + "\n" + body
