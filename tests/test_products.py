"""Best k by inner product against all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitry.operators import products
from visitry.operators.products import best_by_product
from visitry.plans import recommend


def brute(members, items, k):
    out = {}
    for u, f in members:
        scores = [(float(np.float32(np.dot(np.array(f, float), np.array(g, float)))), i) for i, g in items]
        out[u] = [(i, s) for s, i in sorted(scores, key=lambda p: (-p[0], p[1]))[:k]]
    return out


def got(best):
    out = {}
    for r in sorted(best.rows.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["member_id"], []).append((r["item_id"], r["score"]))
    return out


@pytest.mark.parametrize("block", [4, 64])
def test_equal_to_all_pairs(spark, block):
    rng = np.random.default_rng(4)
    # whole numbers, so that products are exact and ties abound; item lengths fall off quickly
    members = [(f"m{u}", rng.integers(-3, 4, 5).astype(float).tolist()) for u in range(40)] + [("zero", [0.0] * 5)]
    items = [(i, (rng.integers(-3, 4, 5) * (40.0 if i % 9 == 0 else 1.0)).tolist()) for i in range(90)]
    m = spark.createDataFrame([*members, (None, [1.0] * 5), ("none", None)], "member_id string, features array<float>").withColumn("v", F.lit("clash"))
    i = spark.createDataFrame([*items, (None, [9.0] * 5), (500, None)], "item_id long, features array<float>").withColumn("norm", F.lit(1))
    best = best_by_product(m, i, 3, block=block)
    assert got(best) == brute(members, items, 3)
    assert best.pairs == len(members) * len(items) and best.scored <= best.pairs
    if block == 4:
        assert best.scored < best.pairs / 2
    # pairs that are not to be listed: the best ones, all items of one member, ids of nobody
    best_pairs = [(u, i) for u, x in brute(members, items, 2).items() for i, _ in x]
    gone = best_pairs + [("m0", i) for i, _ in items] + [("m1", None), (None, 3), ("nobody", 3), ("m2", 10_000), best_pairs[0]]
    left = best_by_product(m, i, 3, block=block, taken=spark.createDataFrame(gone, "member_id string, item_id long"))
    expect = {u: [(x, s) for x, s in brute([(u, f)], items, 90)[u] if (u, x) not in set(gone)][:3] for u, f in members if u != "m0"}
    assert got(left) == expect


def test_few_items_and_none(spark):
    m = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], "member_id int, features array<double>")
    i = spark.createDataFrame([(7, [2.0]), (8, [-5.0])], "item_id int, features array<double>")
    assert got(best_by_product(m, i, 5, block=1)) == {1: [(7, 2.0), (8, -5.0)], 2: [(8, 5.0), (7, -2.0)]}
    assert got(best_by_product(m, i.limit(0), 5)) == {} == got(best_by_product(m.limit(0), i, 5))


def test_equal_to_the_model(spark):
    rng = np.random.default_rng(6)
    rated = [(int(u), int(i), float(rng.integers(1, 9))) for u in range(60) for i in rng.choice(300, 12, replace=False)]
    df = spark.createDataFrame(rated, "member_id int, item_id int, rating double")
    model = ALS(userCol="member_id", itemCol="item_id", ratingCol="rating", rank=6, seed=1, nonnegative=True).fit(df)
    best = best_by_product(model.userFactors.withColumnRenamed("id", "member_id"), model.itemFactors.withColumnRenamed("id", "item_id"), 5, block=16)
    listed = model.recommendForAllUsers(5).select("member_id", F.inline("recommendations")).collect()
    of_model = {}
    for r in listed:
        of_model.setdefault(r["member_id"], []).append(r["rating"])
    assert {u: len(x) for u, x in of_model.items()} == {u: len(x) for u, x in got(best).items()}
    for u, x in got(best).items():
        assert np.allclose([s for _, s in x], sorted(of_model[u], reverse=True), rtol=1e-5)


def test_items_travel_once(spark, monkeypatch):
    """Texts as item ids and pairs left out; one table of items and one of lists, however many blocks there are."""
    rng = np.random.default_rng(7)
    members = [(u, rng.integers(-2, 3, 4).astype(float).tolist()) for u in range(30)] + [(99, [0.0] * 4)]
    items = [(f"i{i}", rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(200)]
    gone = {(u, i) for u, x in brute(members, items, 3).items() for i, _ in x[:2]}
    want = {u: [(i, s) for i, s in x if (u, i) not in gone][:3] for u, x in brute(members, items, 9).items()}
    tables, stored = [], products.stored
    monkeypatch.setattr(products, "stored", lambda df, name: tables.append(name) or stored(df, name))
    m = spark.createDataFrame(members, "member_id long, features array<double>")
    best = best_by_product(m, spark.createDataFrame(items, "item_id string, features array<double>"), 3, block=2, taken=spark.createDataFrame(list(gone), "member_id long, item_id string"))
    assert got(best) == want and sorted(tables) == ["product_best", "product_items"]


def test_recommendations_do_not_score_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rated = [(int(u), int(i), int(rng.integers(1, 6))) for u in range(40) for i in rng.choice(90, 9, replace=False)]
    model = recommend.als_fit(spark.createDataFrame(rated, "member_id int, product_id int, rating int"), rank=4)
    want = model.recommendForAllUsers(3).select("member_id", F.inline("recommendations")).collect(), model.recommendForAllItems(2).select("product_id", F.inline("recommendations")).collect()
    for name in ("recommendForAllUsers", "recommendForAllItems"):
        monkeypatch.setattr(ALSModel, name, None)
    for rows, listed in zip(want, (recommend.als_scores(model, 3), recommend.als_users(model, 2)), strict=True):
        got = {(r["member_id"], r["product_id"]): r["rating"] for r in listed.collect()}
        assert len(got) == len(rows)
        assert np.allclose(sorted(got.values()), sorted(r["rating"] for r in rows), rtol=1e-5)


def test_search_of_settings_computes_ratings_once(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rated = [(int(u), int(i), int(rng.integers(1, 6))) for u in range(30) for i in rng.choice(40, 8, replace=False)]
    seen = []
    monkeypatch.setattr(CrossValidator, "fit", lambda self, df: seen.append(df))
    recommend.als_cv(spark.createDataFrame(rated, "member_id int, product_id int, rating int"), {"rank": (2,)}, folds=3)
    assert sorted(tuple(r)[:3] for r in seen[0].collect()) == sorted(rated)
    assert seen[0].inputFiles() and {r["fold"] for r in seen[0].collect()} == {0, 1, 2}


def test_blocks_grow_with_the_ratings(spark, monkeypatch):
    """A task of the fit holds so many numbers, whatever the table's size; the lists are as sound with many blocks as with ten."""
    # of 216 million ratings by ten factors, none of the blocks has more than two million
    assert 216e6 / recommend._fit_size(216_000_000, 10, 12)["numUserBlocks"] <= 2e6
    assert recommend._fit_size(600_000, 10, 12)["numItemBlocks"] == 12 and recommend._fit_size(0, 10, 2)["numItemBlocks"] == 10
    rng = np.random.default_rng(3)
    rated = [(int(u), int(i), int(rng.integers(1, 6))) for u in range(50) for i in rng.choice(60, 9, replace=False)]
    df = spark.createDataFrame(rated, "member_id int, product_id int, rating int")
    seen, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a: seen.append(self) or fit(self, *a))
    monkeypatch.setattr(recommend, "BLOCK_NUMBERS", 14 * 25)
    model = recommend.als_fit(df, rank=4)
    assert seen[0].getNumUserBlocks() == seen[0].getNumItemBlocks() == 18
    error = model.transform(df).selectExpr("sqrt(avg(pow(prediction - rating, 2))) AS e").first()["e"]
    assert error < 1 and model.userFactors.count() == 50


def test_search_holds_about_a_block_of_items():
    """However many items a batch has, only about a block of them is held as numbers of 64 bits."""
    kinds = {"member": pa.int64(), "norm": pa.float64(), "taken": pa.list_(pa.int64()), "numbers": pa.list_(pa.int64()), "v": pa.list_(pa.float32())}

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in kinds.items()], names=list(kinds))

    members = [{"member": u, "norm": 1.0, "v": [1.0]} for u in range(3)]
    items = [{"norm": 100.0 - i, "numbers": [2 * i, 2 * i + 1], "v": [100.0 - i, 99.5 - i]} for i in range(50)]
    held, concatenate = [], np.concatenate
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("member", "no", "score", "rank")])
    with pytest.MonkeyPatch.context() as patch:
        # vectors of items are the only arrays of two dimensions that are put together
        patch.setattr(products.np, "concatenate", lambda arrays, **k: held.append((out := concatenate(arrays, **k)).shape) or out)
        rows = list(products._searching(60, 8, schema)(iter([batch(members + items[:1]), batch(items[1:])])))
    assert max(x[0] for x in held if len(x) == 2) < 2 * 8 and len(rows) == 2
    assert rows[0].column("no").to_pylist()[:60] == list(range(60))


def test_fits_of_large_tables_let_go_of_what_was_shuffled(spark, monkeypatch):
    """Checkpoints come the more often the more an iteration sends; small tables keep the usual ten, and factors do not change."""
    assert recommend._fit_size(600_000, 10, 12)["checkpointInterval"] == 10
    assert recommend._fit_size(216_000_000, 10, 12)["checkpointInterval"] == 1
    rng = np.random.default_rng(5)
    rated = [(int(u), int(i), int(rng.integers(1, 6))) for u in range(40) for i in rng.choice(50, 9, replace=False)]
    df = spark.createDataFrame(rated, "member_id int, product_id int, rating int").repartition(1)
    seen, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a: seen.append(self) or fit(self, *a))

    def factors():
        return np.array([r["features"] for r in recommend.als_fit(df, rank=3).userFactors.orderBy("id").collect()])

    plain = factors()
    monkeypatch.setattr(recommend, "SHUFFLED_NUMBERS", 1)
    often = factors()
    assert [als.getCheckpointInterval() for als in seen] == [10, 1]
    assert np.allclose(plain, often, rtol=1e-3, atol=1e-4)
