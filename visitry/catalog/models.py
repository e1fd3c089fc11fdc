"""RFM, recommenders and their evaluation on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import quintile_rating
from ..operators.ordered import stored
from ..operators.products import best_by_product
from ..operators.reshape import ranks_to_columns
from ..plans import hybrid, ranking, recommend, rfm
from ..plans.evaluation import precision_recall_at_k, rec_hit_rate, rec_rmse_mae
from .bindings import AS_OF_PURCHASE, Tables
from .registry import query
from .relational import COHORT_SQL
from .scalars import FITTED_CUTS, INTERACTIONS, rfm_sql

# --- RFM --------------------------------------------------------------------------------

FEATURES = f"""
    SELECT member_id, date, r, f, m, is_new, CASE WHEN NOT is_new THEN r_s END AS r_s, CASE WHEN NOT is_new THEN f_s END AS f_s,
           CASE WHEN NOT is_new THEN m_s END AS m_s
    FROM (SELECT s.member_id, join_date AS date, r, f, CAST(m AS DOUBLE) AS m,
            coalesce(join_date > DATE '2001-07-02' AND m > 0, false) AS is_new, {rfm_sql((8, 11), (2000000, 2800000))}
          FROM member_stat s LEFT JOIN (SELECT member_id, join_date FROM member WHERE member LIKE 'M%') j ON j.member_id = s.member_id) x"""


def _features(t: Tables):
    return rfm.rfm_features(t("member_stat"), t("member"), AS_OF_PURCHASE, FITTED_CUTS)


query("rfm_features", f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({FEATURES}) f")(_features)


@query("rfm_kmeans")
def _(t):
    _, centroids = rfm.rfm_kmeans(_features(t))
    return centroids


# a fixed grouping of the scored members stands in for the clustering: six cells by score
CELL = "CASE WHEN r_s = 3 THEN 0 ELSE 3 END + CASE WHEN f_s = 3 THEN 0 WHEN m_s = 1 THEN 1 ELSE 2 END"
CENTROIDS = f"""
    SELECT CAST(cell AS INTEGER) AS cluster, avg(r_s) AS r, avg(f_s) AS f, avg(m_s) AS m
    FROM (SELECT *, {CELL} AS cell FROM ({FEATURES}) f WHERE NOT is_new) c GROUP BY 1"""
CLUSTER_NAMES = f"""
    SELECT cluster, r + f + m AS total, f + m - r AS fm_r, CASE WHEN r + f + m = (SELECT max(r + f + m) FROM ({CENTROIDS}) a) THEN '高價值客群'
      WHEN r + f + m = (SELECT min(r + f + m) FROM ({CENTROIDS}) a) THEN '流失客群'
      WHEN f + m - r = (SELECT max(f + m - r) FROM ({CENTROIDS}) a) THEN '忠誠客群' ELSE '沉睡客群' END AS label
    FROM ({CENTROIDS}) c"""


def _cells(t: Tables):
    return _features(t).where("NOT is_new").withColumn("cluster", F.expr(CELL).cast("int"))


def _names(t: Tables):
    means = [F.avg(c).alias(n) for c, n in zip(rfm.SCORES, ("r", "f", "m"))]
    return rfm.rfm_name_clusters(_cells(t).groupBy("cluster").agg(*means))


query("rfm_name_clusters", CLUSTER_NAMES)(_names)
query("rfm_labels", f"""
    SELECT m.member_id, CAST(date AS VARCHAR) AS date, r, f, m, coalesce(label, '無購買客戶') AS value_label
    FROM (SELECT member_id FROM member WHERE member LIKE 'M%') m LEFT JOIN (
      SELECT f.member_id, date, r, f, m, CASE WHEN is_new THEN '新客客群' ELSE n.label END AS label
      FROM (SELECT *, CASE WHEN NOT is_new THEN {CELL} END AS cell FROM ({FEATURES}) x) f
      LEFT JOIN ({CLUSTER_NAMES}) n ON n.cluster = f.cell) l USING (member_id)""")(
    lambda t: rfm.rfm_labels(_features(t), _cells(t).select("member_id", "cluster"), _names(t), t("member"))
)


@query("rfm_labels_kmeans")
def _(t):
    features = _features(t)
    model, centroids = rfm.rfm_kmeans(features)
    assigned = rfm.assign_clusters(model, features)
    return rfm.rfm_labels(features, assigned, rfm.rfm_name_clusters(centroids), t("member"))


# --- product recommender ----------------------------------------------------------------

query("interactions_purchase", INTERACTIONS)(lambda t: recommend.interactions_purchase(t("purchase")))
CLICKS = """
    SELECT m.member_id, b.product_id, CAST(sum(n) AS BIGINT) AS total_count
    FROM (SELECT cid, product_name, count(*) AS n FROM product_click
      WHERE event_name = 'select_product' AND product_price IS NOT NULL GROUP BY 1, 2) c
    JOIN cid_map m USING (cid)
    JOIN (SELECT product_name, min(product_id) AS product_id FROM brand WHERE product_id NOT LIKE 'D%' GROUP BY 1) b USING (product_name) GROUP BY m.member_id, b.product_id"""
query("interactions_click", CLICKS)(
    lambda t: recommend.interactions_click(t("product_click"), t("cid_map"), t("brand"))
)


def _ratings(t: Tables):
    return quintile_rating(recommend.interactions_purchase(t("purchase")), "total_count")


@query("als_recommend")
def _(t):
    return recommend.als_recommend(_ratings(t))


@query("als_recommend_click")
def _(t):
    clicks = recommend.interactions_click(t("product_click"), t("cid_map"), t("brand"))
    return recommend.als_recommend(quintile_rating(clicks, "total_count"))


def _contract(recs, key="member_id", item="product_id"):
    """Per member: products listed, how many of them differ, and whether all ratings are numbers of 0 or more."""
    sound = F.coalesce(F.col("rating") >= 0, F.lit(False)) & ~F.isnan("rating")
    return recs.groupBy(key).agg(
        F.count("*").alias("listed"), F.countDistinct(item).alias("different"), F.bool_and(sound).alias("sound")
    )


def _contract_sql(interactions: str) -> str:
    return f"""SELECT member_id, (SELECT least(10, count(DISTINCT product_id)) FROM ({interactions}) p) AS listed,
      (SELECT least(10, count(DISTINCT product_id)) FROM ({interactions}) p) AS different, true AS sound
    FROM ({interactions}) i GROUP BY member_id"""


query("als_recommend_contract", _contract_sql(INTERACTIONS))(
    lambda t: _contract(recommend.als_recommend(_ratings(t)))
)
query("als_click_contract", _contract_sql(CLICKS))(
    lambda t: _contract(recommend.als_recommend(quintile_rating(
        recommend.interactions_click(t("product_click"), t("cid_map"), t("brand")), "total_count"
    )))
)


@query("als_pruned_contract", _contract_sql(INTERACTIONS))
def _(t):
    """The contract of the recommendations, of the search that leaves out pairs by norm."""
    ratings, numbers = recommend.number_ids(_ratings(t))
    model = recommend.als_fit(stored(ratings, "fit_ratings"))
    factors = model.userFactors.withColumnRenamed("id", "member_id"), model.itemFactors.withColumnRenamed("id", "product_id")
    best = best_by_product(*factors, 10, item="product_id").rows.withColumnRenamed("score", "rating")
    return _contract(recommend.named_ids(best, numbers))


def _everything(t: Tables):
    return recommend.recommend_all(t("purchase"), t("product_click"), t("cid_map"), t("brand"), t("member"))


query("recommend_all", f"""
    SELECT member_id, 5::BIGINT AS filled FROM ({COHORT_SQL}) c""")(
    # every member of a cohort gets all places: its own list, its cohort's or the best sellers
    lambda t: _everything(t).select(
        "member_id", sum(F.col(f"product_{i}").isNotNull().cast("bigint") for i in range(1, 6)).alias("filled")
    )
)


@query("recommend_all_hit_rate")
def _(t):
    bought = recommend.interactions_purchase(t("purchase"))
    clicked = recommend.interactions_click(t("product_click"), t("cid_map"), t("brand"))
    pairs = bought.unionByName(clicked).select("member_id", F.col("product_id").alias("item")).distinct()
    return rec_hit_rate(_everything(t), pairs)


@query("als_cv")
def _(t):
    # the whole axes but for rank 2000, which is left to the caller
    ratings, numbers = recommend.number_ids(_ratings(t))
    best = recommend.als_cv(ratings, {**recommend.ALS_GRID, "rank": (10, 100)})
    return recommend.named_ids(recommend.als_scores(best.bestModel), numbers)


BLEND = """
    SELECT member_id, product_id, sum(rating) AS rating FROM (
      SELECT member_id, product_id, rating * 0.7::DOUBLE AS rating FROM purchase_scores
      UNION ALL SELECT member_id, product_id, rating * 0.3::DOUBLE FROM click_scores) s GROUP BY 1, 2"""


def _blend(t: Tables):
    w = recommend.BLEND_WEIGHTS
    return recommend.blend_recs([(t("purchase_scores"), w["purchase"]), (t("click_scores"), w["click"])])


RANKED = f"""SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY rating DESC, product_id) AS rank FROM ({BLEND}) b"""


def wide(columns: dict[str, str], n: int, source: str = "rank") -> str:
    return ", ".join(
        f"max(CASE WHEN {source} = {i} THEN {c} END) AS {prefix}{i}"
        for i in range(1, n + 1) for c, prefix in columns.items()
    )


WIDE = f"SELECT member_id, {wide({'product_id': 'product_', 'rating': 'rating'}, 10)} FROM ({RANKED}) r WHERE rank <= 10 GROUP BY 1"
query("blend_recs", BLEND)(_blend)
query("rank_user_items", f"SELECT * FROM ({RANKED}) r WHERE rank <= 10")(
    lambda t: recommend.rank_user_items(_blend(t))
)
query("recs_wide", WIDE)(lambda t: recommend.recs_wide(_blend(t)))
query("cohort_assign", COHORT_SQL)(lambda t: recommend.cohort_assign(t("member")))
COHORT_BEST = f"""
    SELECT cohort, {wide({'product_id': 'product_'}, 5, 'top')} FROM (
      SELECT cohort, product_id, row_number() OVER (PARTITION BY cohort ORDER BY rating DESC, product_id) AS top FROM (
        SELECT cohort, product_id, max(rating) AS rating FROM (
          SELECT cohort, product_id, rank, sum(rating) AS rating FROM ({RANKED}) r JOIN ({COHORT_SQL}) c USING (member_id)
          WHERE rank <= 10 GROUP BY 1, 2, 3) s GROUP BY 1, 2) m) x WHERE top <= 5 GROUP BY cohort"""


def _whole(scores):
    """Ratings as whole tenths, so that their sums are equal in any order."""
    return scores.withColumn("rating", F.rint(F.col("rating") * 10))


WHOLE_BLEND = BLEND.replace("sum(rating) AS rating", "round_even(sum(rating) * 10, 0) AS rating", 1)
COHORT_WHOLE = COHORT_BEST.replace(BLEND, WHOLE_BLEND)


query("cohort_recs", COHORT_WHOLE)(
    lambda t: recommend.cohort_recs(
        recommend.rank_user_items(_whole(_blend(t))), recommend.cohort_assign(t("member"))
    )
)
POPULAR = """SELECT CAST(row_number() OVER (ORDER BY sum(count) DESC, product_id) AS INTEGER) AS rank, product_id, CAST(sum(count) AS BIGINT) AS total
    FROM purchase WHERE product_id NOT LIKE 'D%' GROUP BY product_id ORDER BY rank LIMIT 5"""
query("popular_top5", POPULAR)(lambda t: recommend.popular_top(t("purchase")))

# the fallbacks arise where members have no scores, and cohorts few products
OWN = WIDE.replace(BLEND, WHOLE_BLEND)
_FINAL = ", ".join(
    f"CASE WHEN o.product_1 IS NOT NULL THEN o.product_{i} ELSE coalesce(c.product_{i},"
    f" (SELECT CAST(product_id AS INTEGER) FROM ({POPULAR}) p WHERE rank = {i})) END AS product_{i}"
    for i in range(1, 6)
)
RECS_FINAL = f"""
    SELECT member_id, {_FINAL} FROM ({COHORT_SQL}) m LEFT JOIN ({OWN}) o USING (member_id) LEFT JOIN ({COHORT_WHOLE}) c USING (cohort)"""


def _final(t: Tables):
    ranked, cohorts = recommend.rank_user_items(_whole(_blend(t))), recommend.cohort_assign(t("member"))
    best = recommend.cohort_recs(ranked, cohorts)
    return recommend.recs_final(recommend.ranked_wide(ranked), best, recommend.popular_top(t("purchase")), cohorts)


query("recs_final", RECS_FINAL)(_final)
ACTUAL = f"""SELECT member_id, CAST(product_id AS INTEGER) AS item FROM ({INTERACTIONS}) p
    UNION SELECT member_id, CAST(product_id AS INTEGER) FROM ({CLICKS}) c"""


def _actual(t: Tables):
    bought = recommend.interactions_purchase(t("purchase"))
    clicked = recommend.interactions_click(t("product_click"), t("cid_map"), t("brand"))
    # the score tables hold product numbers
    return bought.unionByName(clicked).select("member_id", F.col("product_id").cast("int").alias("item")).distinct()


_HITS = f"""
    SELECT member_id, count(*) AS actual, count(*) FILTER (item IN (product_1, product_2, product_3, product_4, product_5)) AS hits
    FROM ({RECS_FINAL}) f JOIN ({ACTUAL}) a USING (member_id) GROUP BY member_id"""
query("rec_hit_rate", f"""
    SELECT count(*) AS members, count(*) FILTER (hits > 0) AS hit, 100.0::DOUBLE * count(*) FILTER (hits > 0) / count(*) AS hit_rate
    FROM ({_HITS}) h""")(lambda t: rec_hit_rate(_final(t), _actual(t)))
query("precision_recall_at_k", f"""
    SELECT count(*) AS members, round(avg(hits / 5.0::DOUBLE), 9) AS precision, round(avg(CAST(hits AS DOUBLE) / actual), 9) AS recall
    FROM ({_HITS}) h""")(
    # means of fractions depend on the order of addition in their last digits
    lambda t: precision_recall_at_k(_final(t), _actual(t)).select(
        "members", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall")
    )
)


RATED = f"""
    SELECT i.*, 1 + (CASE WHEN total_count > q[1] THEN 1 ELSE 0 END) + (CASE WHEN total_count > q[2] THEN 1 ELSE 0 END)
             + (CASE WHEN total_count > q[3] THEN 1 ELSE 0 END) + (CASE WHEN total_count > q[4] THEN 1 ELSE 0 END) AS rating
    FROM ({INTERACTIONS}) i, (SELECT quantile_disc(total_count, [0.2, 0.4, 0.6, 0.8]) AS q FROM ({INTERACTIONS}) j) c"""


@query("train_test_split", f"""
    SELECT *, CASE WHEN CAST('0x' || substr(md5('{{"member_id":' || CAST(member_id AS VARCHAR) || ',"product_id":"' || product_id || '"}}'), 1, 6) AS BIGINT)
        < 13421773 THEN 'train' ELSE 'test' END AS side FROM ({RATED}) r""")
def _(t):
    return recommend.split_sides(_ratings(t), ["member_id", "product_id"])


@query("rec_rmse_mae")
def _(t):
    # stored, as the fit reads one side and the evaluation the other
    sides = stored(recommend.split_sides(recommend.number_ids(_ratings(t))[0], ["member_id", "product_id"]), "rating_sides")
    train, test = (sides.where(F.col("side") == s).drop("side") for s in ("train", "test"))
    return rec_rmse_mae(recommend.als_fit(train).transform(test))


# --- hybrid item recommender ------------------------------------------------------------

KINDS = {"signup": "booking", "purchase": "reserve_click", "click": "case_click", "view": "line_label"}


def _interactions(t: Tables):
    events = t("case_event")
    parts = [
        (events.where(F.col("kind") == kind), hybrid.WEIGHTS[name]) for kind, name in KINDS.items()
    ]
    return hybrid.weighted_interactions(parts, t("case_info"))


WEIGHTED = """
    SELECT member_id, item, CAST(sum(times * CASE kind WHEN 'signup' THEN 3 WHEN 'purchase' THEN 2 ELSE 1 END) AS BIGINT) AS ratings
    FROM case_event WHERE kind <> 'error' AND item IN (SELECT item FROM case_info) GROUP BY 1, 2"""
query("weighted_interactions", WEIGHTED)(_interactions)
ITEM_INDEX = """
    SELECT item, row_number() OVER (ORDER BY substr(md5('{{"item":"' || item || '"}}'), 1, 3), item) AS item_id
    FROM (SELECT DISTINCT item FROM case_info) i""".replace("{{", "{").replace("}}", "}")
query("item_index", ITEM_INDEX)(lambda t: hybrid.item_index(t("case_info")))
FEATURE_COLUMNS = ["gender", "age", "marriage", "city"]


def _tags(t: Tables):
    return t("case_event").select("member_id", F.col("kind").alias("tag"))


query("user_features", """
    SELECT member_id, gender, coalesce(age, -1) AS age, coalesce(marriage, 'unknown') AS marriage, city,
      coalesce(click, 0) AS click, coalesce(error, 0) AS error, coalesce(purchase, 0) AS purchase, coalesce(signup, 0) AS signup, coalesce(view, 0) AS view
    FROM member LEFT JOIN (SELECT member_id, count(*) FILTER (kind = 'click') AS click, count(*) FILTER (kind = 'error') AS error,
      count(*) FILTER (kind = 'purchase') AS purchase, count(*) FILTER (kind = 'signup') AS signup, count(*) FILTER (kind = 'view') AS view
      FROM case_event GROUP BY 1) e USING (member_id)""")(
    lambda t: hybrid.user_features(t("member"), _tags(t), FEATURE_COLUMNS, ("click", "error", "purchase", "signup", "view"))
)


def _user_tokens(t: Tables):
    filled = t("member").select("member_id", "gender", "marriage", "city").na.fill("unknown")
    return hybrid.feature_token(filled, "member_id", ["gender", "marriage", "city"])


def _item_tokens(t: Tables):
    cases = t("case_info").join(hybrid.item_index(t("case_info")), "item")
    return hybrid.feature_token(cases, "item_id", ["city", "class"])


query("feature_token", """
    SELECT member_id, sha256('{"gender":"' || gender || '","marriage":"' || coalesce(marriage, 'unknown') || '","city":"' || city || '"}') AS token
    FROM member""")(_user_tokens)


def _rated(t: Tables):
    return _interactions(t).join(hybrid.item_index(t("case_info")), "item").select(
        F.col("member_id").cast("int"), F.col("item_id").cast("int"), "ratings"
    )


@query("hybrid_recommend")
def _(t):
    return hybrid.hybrid_recommend(_rated(t), _user_tokens(t), _item_tokens(t))


# --- the same, learnt from pairs --------------------------------------------------------


# the best of four settings by recall on a part of the training side; the held-out pairs had no say in it
RANKING_DECAY = 0.3


def _ranking(t: Tables):
    return ranking.fit_ranking(_rated(t), _user_tokens(t), _item_tokens(t), decay=RANKING_DECAY)


@query("ranking_recommend")
def _(t):
    return ranking.ranking_recommend(_ranking(t)).rows


@query("ranking_audience")
def _(t):
    """The ten members who score highest for each item, by name."""
    best = ranking.ranking_audience(_ranking(t), 10).rows.join(hybrid.item_index(t("case_info")), "item_id")
    return best.select("item", "member_id", "score", "rank")


@query("ranking_contract", f"""
    SELECT member_id, least(5, (SELECT count(*) FROM ({ITEM_INDEX}) i)) AS listed, least(5, (SELECT count(*) FROM ({ITEM_INDEX}) i)) AS different,
      true AS ordered, true AS product
    FROM (SELECT member_id FROM member UNION SELECT member_id FROM ({WEIGHTED}) w) m""")
def _(t):
    """Per member: items listed and different, ranks without gaps over falling scores, scores equal to the product of the vectors."""
    model = _ranking(t)
    rows = ranking.ranking_recommend(model).rows
    rows = rows.join(model.users.withColumnRenamed("features", "u"), "member_id").join(model.items.withColumnRenamed("features", "v"), "item_id")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    close = F.abs(dot - F.col("score")) <= 1e-6 + 1e-6 * F.abs(dot)
    listed = F.array_sort(F.collect_list(F.struct("rank", (-F.col("score")).alias("falling"))))  # at most five
    rows = rows.groupBy("member_id").agg(
        F.count("*").alias("listed"), F.countDistinct("item_id").alias("different"), listed.alias("l"), F.bool_and(close).alias("product")
    )
    ordered = (F.col("l.rank") == F.sequence(F.lit(1), F.size("l"))) & (F.col("l.falling") == F.array_sort("l.falling"))
    return rows.select("member_id", "listed", "different", ordered.alias("ordered"), "product")


@query("ranking_recall")
def _(t):
    """Recall at 5 of a held-out three tenths of the pairs, among items not taken before: pair ranking beside implicit factorisation."""
    sides = stored(recommend.split_sides(_rated(t), ["member_id", "item_id"], 0.7), "recall_sides")
    train, test = (sides.where(F.col("side") == s).drop("side") for s in ("train", "test"))
    actual = test.select("member_id", F.col("item_id").alias("item"))
    known, implicit = train.select("member_id", "item_id"), hybrid.fit_implicit(train)
    factors = implicit.userFactors.withColumnRenamed("id", "member_id"), implicit.itemFactors.withColumnRenamed("id", "item_id")
    lists = {
        "pairs": ranking.ranking_recommend(ranking.fit_ranking(train, _user_tokens(t), _item_tokens(t), decay=RANKING_DECAY), 5, known).rows,
        "implicit": best_by_product(*factors, 5, taken=known).rows,
    }
    rows = [
        precision_recall_at_k(ranks_to_columns(df, ["member_id"], "rank", 5, {"item_id": "product_"}), actual).select(F.lit(name).alias("model"), "*")
        for name, df in lists.items()
    ]
    return rows[0].union(rows[1])


SCORES = f"SELECT member_id, item_id, CAST(ratings AS DOUBLE) AS score FROM ({WEIGHTED}) w JOIN ({ITEM_INDEX}) i USING (item)"


def _scores(t: Tables):
    ids = hybrid.item_index(t("case_info"))
    return _interactions(t).join(ids, "item").select(
        "member_id", "item_id", F.col("ratings").cast("double").alias("score")
    )


query("topk_items_wide", f"""
    SELECT member_id, {wide({'item': 'case_name'}, 5)} FROM (
      SELECT member_id, item, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, item_id) AS rank
      FROM ({SCORES}) s JOIN ({ITEM_INDEX}) i USING (item_id)) r WHERE rank <= 5 GROUP BY member_id""")(
    lambda t: hybrid.topk_items_wide(_scores(t), hybrid.item_index(t("case_info")))
)
query("users_for_item", f"SELECT item, member_id, score FROM ({SCORES}) s JOIN ({ITEM_INDEX}) i USING (item_id) WHERE score > 5")(
    lambda t: hybrid.users_for_item(_scores(t), hybrid.item_index(t("case_info")), min_score=5)
)
