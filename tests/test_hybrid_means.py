"""Cold users and items of the hybrid recommender against means of full scores."""

import numpy as np
from pyspark.ml.recommendation import ALS

from visitry.plans.hybrid import hybrid_recommend, recommend_with_means


def test_cold_users_and_items_get_means_of_full_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), int(rng.integers(1, 9))) for u in range(30) for i in rng.choice(20, 6, replace=False)]
    rated = spark.createDataFrame(rows, "member_id int, item_id int, ratings long")
    users = [(u, f"t{u % 3}") for u in range(30)] + [(100, "t0"), (101, "t1"), (102, "none like it")]
    items = [(i, f"i{i % 2}") for i in range(20)] + [(50, "i0"), (51, "i1"), (52, "i1"), (53, "no known item")]
    users_df, items_df = spark.createDataFrame(users, "member_id int, token string"), spark.createDataFrame(items, "item_id int, token string")
    model = ALS(userCol="member_id", itemCol="item_id", ratingCol="ratings", implicitPrefs=True, rank=6, seed=1).fit(rated)
    of_user = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    of_item = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    item = dict(of_item)
    for i, token in items[20:23]:
        item[i] = np.mean([of_item[j] for j, t in items if t == token and j in of_item], axis=0)
    user = dict(of_user)
    for u, token in users[30:]:
        user[u] = np.mean([of_user[v] for v, t in users if t == token and v in of_user] or list(of_user.values()), axis=0)
    got = {}
    for r in recommend_with_means(model, users_df, items_df, 3).collect():
        got.setdefault(r["member_id"], {})[r["rank"]] = (r["item_id"], r["score"])
    assert set(got) == set(user)
    for u, f in user.items():
        scores = sorted(((float(f @ g), i) for i, g in item.items()), key=lambda p: (-round(p[0], 6), p[1]))[:3]
        assert [got[u][k][0] for k in (1, 2, 3)] == [i for _, i in scores]
        assert np.allclose([got[u][k][1] for k in (1, 2, 3)], [s for s, _ in scores], atol=1e-5)
    assert {r["member_id"] for r in hybrid_recommend(rated, users_df, items_df, 3, 4).collect()} == set(user)
