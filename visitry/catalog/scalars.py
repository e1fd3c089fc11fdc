"""Scalar expressions and row-local reshaping on the driver tables."""

from __future__ import annotations



from pyspark.sql import functions as F

from ..functions import (
    age_bucket,
    between_times,
    blank_coalesce,
    cap_duration,
    classify_contains,
    classify_suffix,
    cmp_predicate,
    contact_id_clean,
    duration_minutes,
    epoch_micros_to_ts,
    exclude_product_code,
    new_customer_flag,
    parse_date_time,
    parse_measure,
    resolve_range,
    rfm_score,
    schedule_to_ts,
    url_segment_map,
    value_map,
    year_month,
)
from ..operators.aggregates import quintile_rating
from ..operators.reshape import (
    array_to_columns,
    cast_columns,
    collect_ranked,
    explode_params,
    fill_defaults,
    flatten_params,
    literal_columns,
    melt_wide,
    nest_json,
    param_column,
    pivot_params,
    project_nested,
    split_explode,
)
from ..operators.windows import topn_per_group
from ..plans.dashboards import FILTER_NAMES, RELATION_NAMES
from ..plans.recommend import interactions_purchase
from ..plans.visits import (
    MACHINE_LOCATIONS,
    MENU_EVENT,
    MENU_PAGES,
    PARAMS_A,
    URL_LOCATIONS,
    WEB_PARAMS,
    flatten_web_events,
)
from . import nested
from .bindings import AS_OF_EVENT, AS_OF_PURCHASE
from .registry import query, rnd

PARAM_COLUMNS = ("ga_session_id", "item_name", "course_name", "page_url", "group_id")

query("flatten_params", f"SELECT event_id, event_name, {', '.join(PARAM_COLUMNS)} FROM kiosk_a")(
    lambda t: flatten_params(nested.kiosk_a(t), list(PARAMS_A), names=PARAMS_A).select(
        "event_id", "event_name", *PARAM_COLUMNS
    )
)

_FOUND = {"ga_session_id": "session", "ga_session_number": "number", "item": "item", "product_price": "price"}
_WEB_COLUMNS = ", ".join(
    f"{_FOUND.get(p, 'CAST(NULL AS VARCHAR)')} AS {p}" for p in WEB_PARAMS
)
query("flatten_web_events", f"""
    SELECT DISTINCT event_name, CAST(date_trunc('second', ts) AS VARCHAR) AS event_timestamp, category, cid,
           campaign, medium, source, country, region, {_WEB_COLUMNS}
    FROM ({nested.WEB_FLAT}) w
    WHERE session IS NOT NULL OR number IS NOT NULL OR item IS NOT NULL OR price IS NOT NULL""")(
    lambda t: flatten_web_events(nested.web(t), WEB_PARAMS)
)

query("param_value", f"""
    SELECT event_id, session AS a, number AS b, price AS c FROM ({nested.WEB_FLAT}) w""")(
    lambda t: nested.web(t).select(
        "event_id",
        *[
            param_column(key).alias(name)
            for key, name in [("ga_session_id", "a"), ("ga_session_number", "b"), ("product_price", "c")]
        ],
    )
)
query("explode_params", f"""
    SELECT event_id, 'ga_session_id' AS key, session AS value FROM ({nested.WEB_FLAT}) w WHERE session IS NOT NULL
    UNION ALL SELECT event_id, 'item', item FROM ({nested.WEB_FLAT}) w WHERE item IS NOT NULL
    UNION ALL SELECT event_id, 'ga_session_number', number FROM ({nested.WEB_FLAT}) w WHERE number IS NOT NULL""")(
    lambda t: explode_params(
        nested.web(t).select("event_id", "event_params"), ["ga_session_id", "item", "ga_session_number"]
    )
)
query("pivot_params", f"""
    SELECT event_id, item, number AS ga_session_number FROM ({nested.WEB_FLAT}) w
    WHERE item IS NOT NULL OR number IS NOT NULL""")(
    lambda t: pivot_params(
        explode_params(nested.web(t).select("event_id", "event_params"), ["item", "ga_session_number"]),
        ["event_id"], ["item", "ga_session_number"],
    )
)
query("project_nested", f"SELECT event_id, category, campaign, medium, source, country, region FROM ({nested.WEB_FLAT}) w")(
    lambda t: project_nested(
        nested.web(t),
        {
            "event_id": "event_id", "category": "device.category", "campaign": "traffic_source.name",
            "medium": "traffic_source.medium", "source": "traffic_source.source",
            "country": "geo.country", "region": "geo.region",
        },
    )
)
query("epoch_micros_to_ts", "SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS ts FROM events")(
    lambda t: nested.web(t).select("event_id", epoch_micros_to_ts(F.col("event_timestamp")).alias("ts"))
)
query("parse_date_time", """
    SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS at, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""")(
    lambda t: t("events")
    .select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("d"), F.date_format("ts", "HH:mm:ss").alias("h")
    )
    .select("event_id", parse_date_time(F.col("d"), F.col("h")).alias("at"), F.to_date("d", "yyyyMMdd").alias("day"))
)
query("year_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")(
    lambda t: t("orders").select("o_orderkey", year_month(F.col("o_orderdate")).alias("month"))
)
query("schedule_to_ts", """
    SELECT name, CAST(date_trunc('minute', schedule_time) + INTERVAL 8 HOURS AS VARCHAR) AS at FROM schedule""")(
    lambda t: t("schedule")
    .select("name", F.date_format("schedule_time", "'cron('m H d M '?' y')'").alias("text"))
    .select("name", schedule_to_ts(F.col("text")).alias("at"))
)


@query("time_range", """
    SELECT 'days' AS kind, count(*) AS n FROM events
      WHERE ts BETWEEN TIMESTAMP '2024-01-17' AND TIMESTAMP '2024-01-31'
    UNION ALL SELECT 'bounds', count(*) FROM events
      WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-09 18:30:00'
    UNION ALL SELECT 'date bounds', count(*) FROM events
      WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-09'
    UNION ALL SELECT 'default', count(*) FROM events WHERE ts <= TIMESTAMP '2024-01-31'""")
def _(t):
    bounds = {"start_time": "2024-01-05 06:00:00", "end_time": "2024-01-09 18:30:00"}
    tests = {
        "days": between_times(F.col("ts"), *resolve_range({"days": 14}, AS_OF_EVENT), is_date=False),
        "bounds": between_times(F.col("ts"), *resolve_range(bounds, AS_OF_EVENT), is_date=False),
        "date bounds": between_times(F.to_date("ts"), *resolve_range(bounds, AS_OF_EVENT), is_date=True),
        "default": between_times(F.col("ts"), *resolve_range(None, AS_OF_EVENT), is_date=False),
    }
    counts = t("events").agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    return counts.unpivot([], list(tests), "kind", "n")


@query("cmp_predicate", """
    SELECT p_partkey, p_size = 7 AS eq, p_size >= 20 AS ge, p_size <= 20 AS le, p_retailprice >= 950.5 AS more,
           p_retailprice <= 1000 AS less, p_retailprice BETWEEN 920 AND 980 AS inside, p_size > 0 AS any FROM part""")
def _(t):
    size, price = F.col("p_size"), F.col("p_retailprice")
    return t("part").select(
        "p_partkey",
        cmp_predicate(size, "-", 7).alias("eq"),
        cmp_predicate(size, "以上(含)", 20).alias("ge"),
        cmp_predicate(size, "以下(含)", 20).alias("le"),
        cmp_predicate(price, "大於", 950.5).alias("more"),
        cmp_predicate(price, "小於", 1000).alias("less"),
        cmp_predicate(price, "大於", low=920, high=980).alias("inside"),
        cmp_predicate(size).alias("any"),
    )


query("contact_id_clean", """
    SELECT DISTINCT member_id FROM channel_touch WHERE member_id NOT LIKE '%@%' AND member_id NOT LIKE '09%'""")(
    lambda t: t("channel_touch").where(contact_id_clean(F.col("member_id"))).select("member_id").distinct()
)
query("exclude_product_code", """
    SELECT p_partkey, contains(p_brand || p_type, 'D') = false AS nowhere, starts_with(p_type, 'S') = false AS not_first FROM part""")(
    lambda t: t("part").select(
        "p_partkey",
        exclude_product_code(F.concat("p_brand", "p_type"), "contains").alias("nowhere"),
        exclude_product_code(F.col("p_type"), "prefix", "S").alias("not_first"),
    )
)
query("classify_contains", """
    SELECT event_id, CASE WHEN page_url LIKE '%locationA1%' THEN 'A1' ELSE 'I' END AS location FROM kiosk_a
    WHERE page_url LIKE '%locationA1%' OR page_url LIKE '%locationI%'""")(
    lambda t: t("kiosk_a")
    .select("event_id", classify_contains(F.col("page_url"), URL_LOCATIONS).alias("location"))
    .dropna(subset=["location"])
)
query("classify_suffix", """
    SELECT event_id, CASE split_part(pcid, '_', 2) WHEN '17d5dffb' THEN 'A1' WHEN 'b97bc201' THEN 'I' END AS location
    FROM detect_record""")(
    lambda t: t("detect_record").select(
        "event_id", classify_suffix(F.col("pcid"), "_", MACHINE_LOCATIONS).alias("location")
    )
)
ITEM_SQL = "CASE WHEN course_name IS NULL OR course_name = '' THEN item_name ELSE course_name END"
query("blank_coalesce", f"SELECT event_id, {ITEM_SQL} AS item FROM kiosk_a")(
    lambda t: t("kiosk_a").select(
        "event_id", blank_coalesce(F.col("course_name"), F.col("item_name")).alias("item")
    )
)
PAGE_SQL = """CASE WHEN event_name = '點擊下方項目' AND item IS NULL THEN
      CASE regexp_extract(page_url, '([^/]*)$', 1) WHEN 'HomePage' THEN '首頁' WHEN 'MapArchive' THEN '地圖'
        WHEN 'Intro' THEN '歷史' WHEN 'CoursePage' THEN '課程' WHEN 'ShopPage' THEN '購物' END ELSE item END"""
query("url_segment_map", f"""
    SELECT event_id, {PAGE_SQL} AS item FROM (SELECT *, {ITEM_SQL} AS item FROM kiosk_a) k""")(
    lambda t: t("kiosk_a").select(
        "event_id",
        url_segment_map(
            F.col("event_name"), blank_coalesce(F.col("course_name"), F.col("item_name")),
            F.col("page_url"), MENU_EVENT, MENU_PAGES,
        ).alias("item"),
    )
)
query("value_map", """
    SELECT event_id,
           CASE relation WHEN 'male' THEN '男' WHEN 'female' THEN '女' WHEN 'friend' THEN '朋友' WHEN 'couple' THEN '情侶'
             WHEN 'family' THEN '家庭' ELSE relation END AS kept,
           CASE event_name WHEN 'select_filter_activity' THEN '活動' WHEN 'select_filter_product' THEN '產品' END AS mapped
    FROM record_b""")(
    lambda t: t("record_b").select(
        "event_id",
        value_map(F.col("relation"), RELATION_NAMES, keep_unknown=True).alias("kept"),
        value_map(F.col("event_name"), FILTER_NAMES, keep_unknown=False).alias("mapped"),
    )
)
query("parse_measure", """
    SELECT event_id, CAST(split_part(staytime, ' ', 1) AS DOUBLE) AS stay, CAST(replace(age, '歲', '') AS DOUBLE) AS age,
           CAST(NULL AS DOUBLE) AS none FROM detect_record""")(
    lambda t: t("detect_record").select(
        "event_id", parse_measure(F.col("staytime"), " sec").alias("stay"),
        parse_measure(F.col("age"), "歲").alias("age"), parse_measure(F.col("pcid"), " sec").alias("none"),
    )
)
query("age_bucket", """
    SELECT member_id,
      CASE WHEN age > 0 AND age <= 10 THEN '0~10' WHEN age > 10 AND age <= 20 THEN '11~20' WHEN age > 20 AND age <= 25 THEN '21~25'
           WHEN age > 25 AND age <= 30 THEN '26~30' WHEN age > 30 AND age <= 40 THEN '31~40' WHEN age > 40 AND age <= 50 THEN '41~50'
           WHEN age > 50 AND age <= 60 THEN '51~60' ELSE '60up' END AS bands8,
      CASE WHEN age > 0 AND age <= 25 THEN '25歲以下' WHEN age > 25 AND age <= 35 THEN '26-35歲'
           WHEN age > 35 AND age <= 45 THEN '36-45歲' ELSE '46歲以上' END AS bands4,
      CASE WHEN age > 0 AND age <= 100 THEN CAST(ceil(age / 20.0) AS INTEGER) ELSE 0 END AS ordinal5
    FROM member""")(
    lambda t: t("member").select(
        "member_id", *[age_bucket(F.col("age"), s).alias(s) for s in ("bands8", "bands4", "ordinal5")]
    )
)


def _rfm(t, cuts):
    r, f, m = rfm_score(F.col("r"), F.col("f"), F.col("m"), **({"cuts": cuts} if cuts else {}))
    return t("member_stat").select("member_id", r.alias("r_s"), f.alias("f_s"), m.alias("m_s"))


def rfm_sql(f=(1, 2), m=(1000, 2000)) -> str:
    return f"""CASE WHEN r <= 60 THEN 3 WHEN r <= 120 THEN 2 WHEN r > 120 THEN 1 END AS r_s,
      CASE WHEN f <= {f[0]} THEN 1 WHEN f <= {f[1]} THEN 2 WHEN f > {f[1]} THEN 3 END AS f_s,
      CASE WHEN m <= {m[0]} THEN 1 WHEN m <= {m[1]} THEN 2 WHEN m > {m[1]} THEN 3 END AS m_s"""


FITTED_CUTS = {"r": (60, 120), "f": (8, 11), "m": (2_000_000, 2_800_000)}
query("rfm_score", f"SELECT member_id, {rfm_sql()} FROM member_stat")(lambda t: _rfm(t, None))
query("rfm_score_fitted", f"SELECT member_id, {rfm_sql((8, 11), (2000000, 2800000))} FROM member_stat")(
    lambda t: _rfm(t, FITTED_CUTS)
)
INTERACTIONS = """SELECT member_id, product_id, CAST(sum(count) AS BIGINT) AS total_count
    FROM purchase WHERE member_id IS NOT NULL AND product_id NOT LIKE 'D%' GROUP BY member_id, product_id"""
query("quintile_rating", f"""
    SELECT i.*, 1 + (CASE WHEN total_count > q[1] THEN 1 ELSE 0 END) + (CASE WHEN total_count > q[2] THEN 1 ELSE 0 END)
             + (CASE WHEN total_count > q[3] THEN 1 ELSE 0 END) + (CASE WHEN total_count > q[4] THEN 1 ELSE 0 END) AS rating
    FROM ({INTERACTIONS}) i, (SELECT quantile_disc(total_count, [0.2, 0.4, 0.6, 0.8]) AS q FROM ({INTERACTIONS}) j) c""")(
    lambda t: quintile_rating(interactions_purchase(t("purchase")), "total_count")
)
query("new_customer_flag", """
    SELECT s.member_id, join_date > DATE '2001-07-02' AND m > 0 AS is_new
    FROM member_stat s JOIN member USING (member_id)""")(
    lambda t: t("member_stat")
    .join(t("member").select("member_id", "join_date"), "member_id")
    .select("member_id", new_customer_flag(F.col("join_date"), F.col("m"), AS_OF_PURCHASE).alias("is_new"))
)
query("duration_minutes", f"""
    SELECT event_id, {rnd("stay_time / 60", 2)} AS minutes, coalesce({rnd("stay_time / 60", 2)}, 0.5) AS filled FROM record_b""")(
    lambda t: t("record_b").select(
        "event_id", duration_minutes(F.col("stay_time")).alias("minutes"),
        duration_minutes(F.col("stay_time"), null_as=0.5).alias("filled"),
    )
)
query("cap_duration", """
    SELECT event_id, CASE WHEN stay_time > 60 THEN 60.0::DOUBLE ELSE stay_time END AS a,
           CASE WHEN stay_time > 30 THEN 30.0::DOUBLE ELSE stay_time END AS b FROM record_a""")(
    lambda t: t("record_a").select(
        "event_id", cap_duration(F.col("stay_time"), 60).alias("a"), cap_duration(F.col("stay_time"), 30).alias("b")
    )
)
query("fill_defaults", """
    SELECT member_id, coalesce(age, -1) AS age, coalesce(marriage, '無資料') AS marriage, coalesce(f, 0) AS f
    FROM member LEFT JOIN (SELECT member_id, f FROM member_stat WHERE f > 5) s USING (member_id)""")(
    lambda t: fill_defaults(
        t("member").select("member_id", "age", "marriage").join(
            t("member_stat").where("f > 5").select("member_id", "f"), "member_id", "left"
        ),
        strings="無資料", numbers=0, per_column={"age": -1},
    )
)
query("cast_columns", """
    SELECT TRY_CAST(member_id AS INTEGER) AS member_id, TRY_CAST(product_id AS INTEGER) AS product_id, TRY_CAST(add_on AS INTEGER) AS add_on
    FROM purchase""")(
    lambda t: cast_columns(t("purchase").select("member_id", "product_id", "add_on"), "int")
)
query("literal_columns", """
    SELECT c_custkey, 'email' AS channel, '2001-07' AS month, 1 AS wave FROM customer""")(
    lambda t: literal_columns(t("customer").select("c_custkey"), channel="email", month="2001-07", wave=1)
)
query("split_explode", """
    SELECT event_id, unnest(string_split(item_name, ',')) AS filter_name FROM kiosk_b WHERE item_name IS NOT NULL""")(
    lambda t: split_explode(t("kiosk_b").select("event_id", "item_name"), "item_name", ",", "filter_name")
)
query("melt_wide", """
    SELECT o_orderkey, 1 AS rank, o_orderstatus AS name, o_totalprice AS score FROM orders
    UNION ALL SELECT o_orderkey, 2, o_orderpriority, CAST(o_custkey AS DOUBLE) FROM orders""")(
    lambda t: melt_wide(
        t("orders").withColumn("key", F.col("o_custkey").cast("double")), ["o_orderkey"],
        [("o_orderstatus", "o_totalprice"), ("o_orderpriority", "key")], ["name", "score"], "rank",
    )
)
RANKED_SALES = """SELECT member_id, product_id, rating, row_number() OVER (PARTITION BY member_id ORDER BY rating DESC, product_id) AS rank
    FROM purchase_scores"""


def _best(t, n):
    return topn_per_group(t("purchase_scores"), ["member_id"], [F.desc("rating"), F.asc("product_id")], n)


query("array_to_columns", f"""
    SELECT member_id, {', '.join(f"max(CASE WHEN rank = {i} THEN product_id END) AS product_{i}" for i in range(1, 13))}
    FROM ({RANKED_SALES}) r WHERE rank <= 10 GROUP BY member_id""")(
    # two columns more than entries: past the end is null
    lambda t: array_to_columns(
        collect_ranked(_best(t, 10), ["member_id"], "rank", "product_id", "p"), "p", 12, "product_"
    )
)


@query("nest_json", """
    SELECT location, event_name, item_name, count(*) AS clicks FROM record_a
    WHERE location IS NOT NULL AND item_name IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    counts = (
        t("record_a").dropna(subset=["location", "item_name"])
        .groupBy("location", "event_name", "item_name").agg(F.count("*").alias("clicks"))
    )
    docs = nest_json(counts, ["location", "event_name"], ["item_name", "clicks"])
    kind = "map<string, struct<item_name: array<string>, clicks: array<bigint>>>"
    events = docs.select("location", F.explode(F.from_json("doc", kind)).alias("event_name", "node"))
    pairs = F.arrays_zip("node.item_name", "node.clicks")
    return events.select("location", "event_name", F.inline(pairs)).toDF(
        "location", "event_name", "item_name", "clicks"
    )


