"""The pairwise ranking trainer: falling loss, held-out recall, newcomers, hot members, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitry.plans.ranking import fit_ranking, ranking_audience, ranking_recommend, train_cell


@pytest.fixture(scope="module")
def world(spark):
    """60 members and 40 items in four circles; a member takes items of its circle, nine in ten times."""
    rng = np.random.default_rng(2)
    rows = []
    for u in range(60):
        inside, outside = [i for i in range(40) if i % 4 == u % 4], [i for i in range(40) if i % 4 != u % 4]
        rows += [(u, int(i), int(rng.integers(1, 5))) for i in rng.choice(inside, 6, replace=False)]
        rows += [(u, int(rng.choice(outside)), 1)] if u % 2 else []
    odd = [(None, 3, 1), (3, None, 1), (5, 999, 2), (rows[0][0], rows[0][1], None), rows[1]]
    pairs = spark.createDataFrame([*rows, *odd], "member_id int, item_id int, ratings long").withColumn("token", F.lit("clash"))
    users = spark.createDataFrame([(u, f"t{u % 4}") for u in range(60)] + [(100, "t1"), (101, None), (None, "t2")], "member_id int, token string")
    items = spark.createDataFrame([(i, f"c{i % 4}") for i in range(40)] + [(70, "c1"), (None, "c1")], "item_id int, token string")
    return pairs, users, items, rows


def test_a_cell_learns(spark):
    rng = np.random.default_rng(1)
    u, i = np.repeat(np.arange(20), 3), np.array([(3 * (k % 4) + j) for k in range(20) for j in range(3)])
    vectors = rng.normal(0, 0.1, (20, 6)), rng.normal(0, 0.1, (12, 6)), np.zeros(12)
    losses = [train_cell(u, i, np.ones(60), np.arange(12), vectors, rng, 4, 0.1, 1e-4)[0] for _ in range(30)]
    assert losses[-1] < losses[0] / 3
    scores = vectors[0] @ vectors[1].T + vectors[2]
    assert all(set(np.argsort(-scores[k])[:3]) == {3 * (k % 4) + j for j in range(3)} for k in range(20))
    # a member who has taken everything has no opponent, an empty pool none for anybody
    alone = np.ones((1, 2)), np.ones((2, 2)), np.zeros(2)
    assert train_cell(np.array([0, 0]), np.array([0, 1]), np.ones(2), np.arange(2), alone, rng, 3, 0.1, 0)[0] == 0
    assert train_cell(np.array([0]), np.array([0]), np.ones(1), np.arange(0), alone, rng, 3, 0.1, 0)[0] == 0


@pytest.mark.parametrize("size, passes", [(10_000, 1), (60, 8)])
def test_circles_are_found(spark, world, size, passes):
    pairs, users, items, rows = world
    model = fit_ranking(pairs, users, items, rank=8, epochs=8, passes=passes, cell_pairs=size)
    assert len(model.losses) == 8 and model.losses[-1] < 0.7 * model.losses[0]
    best = ranking_recommend(model, 5).rows.collect()
    lists = {}
    for r in sorted(best, key=lambda r: r["rank"]):
        lists.setdefault(r["member_id"], []).append(r["item_id"])
    assert set(lists) == {*range(60), 100, 101} and all(len(x) == 5 for x in lists.values())
    own = np.mean([i % 4 == u % 4 if i < 70 else u % 4 == 1 for u in range(60) for i in lists[u]])
    assert own > 0.85
    # a newcomer goes by its token
    assert np.mean([i % 4 == 1 or i == 70 for i in lists[100]]) >= 0.8
    of_user, of_item = ({r[0]: np.array(r[1]) for r in t.collect()} for t in (model.users, model.items))
    assert all(abs(r["score"] - of_user[r["member_id"]] @ of_item[r["item_id"]]) < 1e-5 for r in best)
    audience = ranking_audience(model, 3).rows.collect()
    assert {r["item_id"] for r in audience} == {*range(40), 70} and len(audience) == 41 * 3


def test_same_seed_same_model_and_empty_tables(spark, world):
    pairs, users, items, _ = world
    first, second = (fit_ranking(pairs, users, items, rank=4, epochs=2) for _ in range(2))
    assert np.allclose(first.losses, second.losses)
    a, b = ({r[0]: r[1] for r in m.items.collect()} for m in (first, second))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)
    nothing = fit_ranking(pairs.limit(0), users, items, rank=4, epochs=2)
    assert nothing.losses == [] and ranking_recommend(nothing, 2).rows.groupBy("member_id").count().where("count <> 2").count() == 0
    assert ranking_recommend(fit_ranking(pairs, users, items.limit(0), rank=4, epochs=2)).rows.count() == 0
