"""Hand-written rows for what the driver tables cannot show."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from visitry import functions as fn
from visitry.operators import aggregates, joins, reshape, sets, windows


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def ts(text):
    return datetime.fromisoformat("2024-01-01 " + text)


def events(spark, data):
    return spark.createDataFrame(data, "id int, day string, session string, at timestamp_ntz")


def test_dwell_edges(spark):
    df = events(
        spark,
        [
            (1, "d", "a", ts("10:00:00")),
            (2, "d", "a", ts("10:01:00")),  # exactly at the cap
            (3, "d", "a", ts("10:01:00")),  # same time, later id
            (4, "d", "a", ts("10:05:00")),  # over the cap, several empty minutes between
            (5, "d", None, ts("10:00:00")),  # no session: never chained
            (6, "d", None, ts("10:00:01")),
            (7, "d", "b", ts("23:59:59")),  # single event
            (8, "e", "a", ts("10:06:00")),  # another day
        ],
    )
    got = dict(rows(windows.dwell_time(df, ["day", "session"], "at", "id", 60).select("id", "stay_time")))
    assert got == {1: 60.0, 2: 0.0, 3: 60.0, 4: None, 5: None, 6: None, 7: None, 8: None}


def test_dwell_equals_plain_window_on_a_hot_session(spark):
    """A third of all rows in one session; any piece size gives the plain look-ahead."""
    import random

    random.seed(1)
    start = datetime(2024, 1, 1)
    data = [
        (i, "d", "hot" if i % 3 == 0 else f"s{random.randrange(40)}", start + timedelta(seconds=random.randrange(6000)))
        for i in range(3000)
    ]
    df = events(spark, data)
    sessions: dict = {}
    for i, _, s, at in data:
        sessions.setdefault(s, []).append((at, i))
    want = {}
    for found in sessions.values():
        found.sort()
        for (at, i), nxt in zip(found, found[1:] + [None]):
            want[i] = None if nxt is None else min(30.0, (nxt[0] - at).total_seconds())
    for piece in (1, 60, 3600):
        out = windows.dwell_time(df, ["day", "session"], "at", "id", 30, bucket_s=piece)
        assert dict(rows(out.select("id", "stay_time"))) == want


def params_df(spark, data):
    kind = (
        "id int, event_params array<struct<key string, value struct<string_value string,"
        " int_value bigint, float_value double, double_value double>>>"
    )
    return spark.createDataFrame(data, kind)


def test_params_edges(spark):
    df = params_df(
        spark,
        [
            (1, []),
            (2, [("a", ("x", None, None, None)), ("a", ("y", None, None, None))]),  # first wins
            (3, [("a", (None, None, None, None))]),
            (4, [("b", (None, 7, None, None)), ("noise", ("n", None, None, None))]),
            (5, [("b", (None, None, 1.5, 2.5))]),
            (6, [("noise", ("n", None, None, None))]),
            (7, None),
        ],
    )
    flat = reshape.flatten_params(df, ["a", "b", "never"])
    assert rows(flat, "id") == [
        (1, None, None, None), (2, "x", None, None), (3, None, None, None), (4, None, "7", None),
        (5, None, "1.5", None), (6, None, None, None), (7, None, None, None),
    ]
    kept = reshape.flatten_params(df, ["a", "b"], keep_empty=False)
    assert [r[0] for r in rows(kept, "id")] == [2, 3, 4, 5]
    long = reshape.explode_params(df, ["a", "b"])
    assert rows(long, "id", "value") == [
        (2, "a", "x"), (2, "a", "y"), (3, "a", None), (4, "b", "7"), (5, "b", "1.5"),
    ]
    twice = reshape.flatten_params(df.union(df), ["a"], keep_empty=False, dedup=True)
    assert twice.count() == 2 + 0  # events 2 and 3 hold "a"


def test_precedence_edges(spark):
    data = [
        ("g1", "朋友"), ("g1", "情侶"), ("g1", "家庭"),
        ("g2", "朋友"), ("g2", "情侶"),
        ("g3", "朋友"), ("g3", "male"),
        ("g4", "male"), ("g4", "female"),  # tie: smallest
        ("g5", "male"), ("g5", "male"), ("g5", "female"),
        ("g6", None), ("g6", None),
        ("g7", ""), ("g7", None),
        (None, "家庭"),
    ]
    df = spark.createDataFrame(data, "g string, r string")
    got = dict(rows(aggregates.precedence_group(df, "g", "r", "r")))
    assert got == {
        "g1": "家庭", "g2": "情侶", "g3": "朋友", "g4": "female", "g5": "male", "g6": "", "g7": "",
    }
    none = aggregates.precedence_group(df.where("g = 'g6'"), "g", "r", "r", blank=None)
    assert rows(none) == [("g6", None)]


def test_null_groups_and_empty_sums(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "x", None), ("a", None, 2.0), (None, "x", 5.0), ("b", "y", None)],
        "place string, g string, stay double",
    )
    out = aggregates.two_level_agg(df, ["g", "place"], ["place"], "stay", "g")
    # the null group counts for the mean (2.0 and 1.0), not as a distinct group; all-null sums are 0
    assert rows(out, "place") == [("a", 1, 1.5), ("b", 1, 0.0)]


def test_blanks(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", None)], "a string, b string")
    assert rows(df.select(fn.blank_coalesce(F.col("a"), F.col("b")))) == [("b",), ("b",), ("a",), (None,)]


def test_casts(spark):
    df = spark.createDataFrame([("12.3 sec",), ("",), ("x",), (None,)], "s string")
    assert rows(df.select(fn.parse_measure(F.col("s"), " sec"))) == [(12.3,), (None,), (None,), (None,)]
    assert rows(reshape.cast_columns(df, "int")) == [(None,)] * 4
    short = spark.createDataFrame([(1, ["a", "b"])], "id int, p array<string>")
    assert rows(reshape.array_to_columns(short, "p", 3, "c")) == [(1, "a", "b", None)]


def test_ranks_ties_and_blocked(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 2), ("d", 3)], "item string, n int")
    order = [F.desc("n"), F.asc("item")]
    assert [r[0] for r in rows(windows.topk_global(df, order, 2), "item")] == ["a", "b"]
    # blocked after the cut: one row fewer, no replacement
    assert [r[0] for r in rows(windows.topk_global(df, order, 2, "item", ["a"]))] == ["b"]
    few = windows.topn_per_group(df.withColumn("g", F.lit(1)), ["g"], order, 10)
    assert [r[0] for r in rows(few.select("item", "rank"), "rank")] == ["a", "b", "d", "c"]


def test_grid_edges(spark):
    empty = spark.createDataFrame([], "g string, kind string, n bigint")
    names = spark.createDataFrame([("x",), ("y",)], "g string")
    grid = joins.cross_grid(names, kind=["p", "q", "r"])
    assert joins.densify(empty, grid, ["g", "kind"], {"n": 0}).count() == 6
    outside = spark.createDataFrame([("x", "p", 4), ("x", "other", 5)], "g string, kind string, n bigint")
    assert joins.densify(outside, grid, ["g", "kind"], {"n": 0}).count() == 6
    kept = joins.densify(outside, grid, ["g", "kind"], {"n": 0}, extra=True)
    assert kept.count() == 7 and kept.agg(F.sum("n")).first()[0] == 9


def test_growth_edges(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 2), "a"), (date(2024, 1, 2), "b"), (date(2024, 1, 1), "a")], "day date, g string"
    )
    one_day = aggregates.period_growth(
        df, F.col("day"), date(2024, 1, 2), date(2024, 1, 2), {"n": ("count", F.lit(1)), "g": ("nunique", F.col("g"))}
    )
    assert rows(one_day) == [(2.0, 2.0, 1.0, 1.0)]
    growth = one_day.select(aggregates.growth_percent(F.col("cur_n"), F.col("prev_n")))
    assert rows(growth) == [(100.0,)]
    before = aggregates.period_growth(df, F.col("day"), date(2024, 1, 1), date(2024, 1, 1), {"n": ("count", F.lit(1))})
    assert rows(before.select(aggregates.growth_percent(F.col("cur_n"), F.col("prev_n")))) == [(None,)]


def test_dash_growth_is_hidden_when_one_base_is_zero(spark):
    from visitry.plans.dashboards import dash_b_info

    visits = spark.createDataFrame(
        [("p", datetime(2024, 1, d, 9), f"g{d}", "2.0 sec") for d in (1, 2)],
        "pcid string, visittime timestamp_ntz, group_id string, staytime string",
    )
    clicks = spark.createDataFrame(
        [("select_homepage", datetime(2024, 1, 2, 9))], "event_name string, event_timestamp timestamp_ntz"
    )
    got = {r.kpi: (r.value, r.growth) for r in dash_b_info(visits, clicks, date(2024, 1, 2), date(2024, 1, 2), "p").collect()}
    assert got == {"views": (1.0, None), "groups": (1.0, None), "stay": (2.0, None), "home_clicks": (1.0, None)}


def test_rounding_ties(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (3.5,), (-2.5,), (None,)], "x double")
    two = rows(df.select(fn.round_half_even(F.col("x"), 2)))
    assert [r[0] for r in two[:2]] == [0.12, 0.38]
    whole = rows(df.select(fn.round_half_even(F.col("x"))))
    assert [r[0] for r in whole[2:]] == [2.0, 4.0, -2.0, None]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(None,), (59.0,), (60.0,), (61.0,)], "x double")
    assert rows(df.select(fn.cap_duration(F.col("x"), 60))) == [(None,), (59.0,), (60.0,), (60.0,)]


def test_comparisons(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")

    def kept(*args, **kw):
        return [r[0] for r in rows(df.where(fn.cmp_predicate(F.col("x"), *args, **kw)), "x")]

    assert kept("-", 2) == [2] and kept("以上(含)", 2) == [2, 3] and kept("以下(含)", 2) == [1, 2]
    assert kept("大於", 2) == [2, 3] and kept("小於", 2) == [1, 2]
    assert kept("大於", low=2, high=3) == [2, 3] and kept() == [1, 2, 3] and kept(None, 2) == [1, 2, 3]
    with pytest.raises(ValueError):
        fn.cmp_predicate(F.col("x"), "?", 1)


def test_time_range():
    now = datetime(2024, 1, 31, 15)
    assert fn.resolve_range({"days": 7, "start_time": "2020-01-01"}, now) == (datetime(2024, 1, 24, 15), now)
    assert fn.resolve_range(None, now) == (datetime(2000, 1, 1), now)
    assert fn.resolve_range({"start_time": "2024-01-02", "end_time": "2024-01-03 10:00:00"}, now) == (
        datetime(2024, 1, 2), datetime(2024, 1, 3, 10),
    )


def test_date_bounds(spark):
    """A date counts as its midnight, so a start after midnight excludes its own day."""
    df = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 5)], "d date")
    inside = fn.between_times(F.col("d"), datetime(2024, 1, 1, 12), datetime(2024, 1, 3, 12), is_date=True)
    assert [r[0].day for r in rows(df.where(inside), "d")] == [2, 3]


def test_schedule_text(spark):
    df = spark.createDataFrame([("cron(30 20 31 12 ? 2023)",), ("cron(x 1 1 1 ? 2024)",)], "c string")
    assert rows(df.select(fn.schedule_to_ts(F.col("c")))) == [(datetime(2024, 1, 1, 4, 30),), (None,)]


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    micros = 1_710_000_000_123_456
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1, micros), (2, micros + 90_000_000)], "id int, m bigint")
        df = df.select("id", F.lit("d").alias("d"), F.lit("s").alias("s"), fn.epoch_micros_to_ts(F.col("m")).alias("at"))
        # the clocks go forward in between: 2024-03-10 02:00
        gap = df.unionByName(df.select(F.lit(3).alias("id"), "d", "s", (F.col("at") + F.expr("INTERVAL 20 HOURS")).alias("at")).limit(1))
        out = windows.dwell_time(gap, ["d", "s"], "at", "id", 1e9)
        assert rows(df.select(F.col("at").cast("string")), "at")[0] == ("2024-03-09 16:00:00",)
        assert dict(rows(out.select("id", "stay_time")))[2] in (71910.0, 72000.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_fold_order(spark):
    def ids(*names):
        return spark.createDataFrame([(n,) for n in names], "member_id string")

    def fold(*steps):
        return sorted(r[0] for r in sets.fold_membership(list(steps), "member_id").collect())

    a, b = ids("1", "2", "2"), ids("2", "3")
    assert fold((a, "or"), (b, "and")) == ["2"]
    assert fold((a, "and"), (b, "or")) == ["2", "3"]  # an intersection with nothing stays empty
    assert fold((a, "not"), (b, "or")) == ["2", "3"]  # exclude first: nothing to take away yet
    assert fold((a, "or"), (a, "not"), (a, "or")) == ["1", "2"]
    assert fold((a, "or"), (b, "not")) == ["1"]
    many = [(ids(str(i)), "or") for i in range(66)] + [(ids("5", "65"), "not")]
    assert fold(*many) == sorted(str(i) for i in range(65) if i != 5)


def test_lookup_strict_and_lenient(spark):
    facts = spark.createDataFrame([("a", 1), ("z", 2)], "k string, n int")
    dim = spark.createDataFrame([("a", "A"), ("b", None)], "k string, v string")
    assert rows(joins.join_lookup(facts, dim, "k", "v")) == [("a", 1, "A")]
    with pytest.raises(Exception, match="no v for k z"):
        joins.join_lookup(facts, dim, "k", "v", strict=True).collect()


def test_enrich_left_null_keys(spark):
    facts = spark.createDataFrame([(None, "x", 1), ("a", None, 2), ("a", "x", 3), ("b", "x", 4)], "g string, l string, n int")
    dim = spark.createDataFrame([("a", "x", "A"), (None, "x", "N"), ("a", None, "M")], "g string, l string, v string")
    got = rows(joins.enrich_left(facts, dim, ["g", "l"]).select("n", "v"), "n")
    assert got == [(1, None), (2, None), (3, "A"), (4, None)]


def test_keyed_update_takes_the_greatest(spark):
    base = spark.createDataFrame([("a", "0"), ("b", "0"), (None, "0")], "k string, c string")
    changes = spark.createDataFrame([("a", "1"), ("a", "2"), ("c", "9")], "k string, c string")
    assert rows(joins.keyed_update(base, changes, "k", "c"), "k") == [(None, "0"), ("a", "2"), ("b", "0")]


def test_quantiles_match_brute_force(spark):
    import math
    import random

    random.seed(3)
    for n in (1, 2, 5, 7, 35, 100, 333):
        values = sorted(random.choice([1, 1, 1, 1, 2, 3, 50]) for _ in range(n))
        df = spark.createDataFrame([(v,) for v in values], "v int")
        want = [values[math.ceil(n * p / 100) - 1] for p in (20, 40, 60, 80)]
        assert list(aggregates.quantile_cuts(df, "v").first()) == want
        rated = {r.v: r.rating for r in aggregates.quintile_rating(df, "v").collect()}
        for v in set(values):
            assert rated[v] == next((i for i, q in enumerate(want, 1) if v <= q), 5)


def test_numbers_are_dense_and_repeatable(spark):
    df = spark.range(5000).selectExpr("concat('m', id) AS k")
    first = dict(rows(windows.number_rows(df, ["k"], "n")))
    again = dict(rows(windows.number_rows(df.repartition(13), ["k"], "n")))
    assert sorted(first.values()) == list(range(1, 5001)) and first == again
    finer = dict(rows(windows.number_rows(df, ["k"], "n", start=0, digits=4)))
    assert sorted(finer.values()) == list(range(5000))


def test_most_frequent_ties(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), ("g", None), ("g", None)], "g string, v string")
    assert rows(aggregates.most_frequent(df, ["g"], "v")) == [("g", "a")]


def test_pivot_of_any_domain(spark):
    df = spark.range(3000).selectExpr("id % 2 AS k", "cast(id AS string) AS v").union(spark.sql("SELECT 0L, cast(null AS string)"))
    found = {r.k: r.counts for r in aggregates.pivot_onehot(df, "k", "v").collect()}
    assert {k: len(v) for k, v in found.items()} == {0: 1500, 1: 1500} and found[1]["2999"] == 1
    assert rows(aggregates.pivot_onehot(df, "k", "v", ["0", "1"])) == [(0, 1, 0), (1, 0, 1)]


def test_centroid_names(spark):
    from visitry.plans.rfm import BEST, LOST, LOYAL, SLEEPING, rfm_name_clusters

    def names(data):
        df = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(data)], "cluster int, r double, f double, m double")
        return [r.label for r in rfm_name_clusters(df).orderBy("cluster").collect()]

    loyal = [(3, 3, 2), (1, 1, 1), (1, 3, 3), (2, 1, 2), (2, 2, 1), (1, 2, 1)]
    assert names(loyal) == [BEST, LOST, LOYAL, SLEEPING, SLEEPING, SLEEPING]
    # greatest F+M-R on the best cluster itself: nobody is loyal
    assert LOYAL not in names([(2, 3, 3), (1, 1, 1), (3, 1, 1), (2, 1, 2), (2, 2, 1), (3, 2, 1)])
    # two clusters share the greatest sum: both are best
    assert names([(3, 3, 2), (2, 3, 3), (1, 1, 1), (2, 1, 1), (2, 1, 2), (2, 2, 1)]).count(BEST) == 2


def test_fixed_scores(spark):
    from visitry.plans import recommend

    scores = spark.createDataFrame(
        [(1, i, float(20 - i)) for i in range(12)] + [(2, 7, 1.0), (2, 8, 1.0)], "member_id int, product_id int, rating double"
    )
    wide = {r.member_id: r for r in recommend.recs_wide(scores).collect()}
    assert [wide[1][f"product_{i}"] for i in range(1, 11)] == list(range(10))
    assert (wide[2].product_1, wide[2].product_2, wide[2].product_3, wide[2].rating3) == (7, 8, None, None)
    cohorts = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 11)], "member_id int, cohort int")
    best = recommend.cohort_recs(recommend.rank_user_items(scores), cohorts)
    popular = spark.createDataFrame([(i, str(90 + i)) for i in range(1, 6)], "rank int, product_id string")
    final = {r.member_id: list(r)[1:] for r in recommend.recs_final(recommend.recs_wide(scores), best, popular, cohorts).collect()}
    assert final[1] == [0, 1, 2, 3, 4]
    assert final[2] == [7, 8, None, None, None]  # own recommendations are not filled up
    assert final[3] == [0, 1, 2, 3, 4]  # the cohort's
    assert final[4] == [91, 92, 93, 94, 95]  # unknown cohort: best sellers


def test_nested_documents(spark):
    df = spark.createDataFrame(
        [("A", "e1", "x", 2), ("A", "e1", "y", 1), ("A", "e2", "x", 5), ("B", "e1", "z", 1)],
        "place string, event string, item string, n int",
    )
    docs = dict(rows(reshape.nest_json(df, ["place", "event"], ["item", "n"])))
    assert docs["A"] == '{"e1":{"item":["x","y"],"n":[2,1]},"e2":{"item":["x"],"n":[5]}}'
    deep = dict(rows(reshape.nest_json(df.withColumn("top", F.lit("t")), ["top", "place", "event"], ["n"])))
    assert deep["t"] == '{"A":{"e1":{"n":[1,2]},"e2":{"n":[5]}},"B":{"e1":{"n":[1]}}}'


def test_hit_rate_edges(spark):
    from visitry.plans.evaluation import precision_recall_at_k, rec_hit_rate

    recs = spark.createDataFrame(
        [(1, 10, 11, 10), (2, 20, None, None), (3, None, None, None), (4, 40, 41, 42)],
        "member_id int, product_1 int, product_2 int, product_3 int",
    )
    actual = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 99), (2, 21), (3, 30), (5, 50), (4, None)], "member_id int, item int"
    )
    # member 1 hits once (a repeated place counts once), 2 and 3 miss, 4 and 5 lack one side
    assert rows(rec_hit_rate(recs, actual, 3).select("members", "hit")) == [(3, 1)]
    got = precision_recall_at_k(recs, actual, 3).first()
    assert abs(got.precision - (1 / 3) / 3) < 1e-12 and abs(got.recall - (1 / 2) / 3) < 1e-12


def test_two_level_agg_groups_once(spark):
    """Inner keys that are the outer ones and the counted column are distinct already; others are not."""
    rows = [(1, "a", "x", 2.0), (1, "a", "x", 4.0), (1, "a", "y", 1.0), (2, "a", "x", None), (None, "a", "x", 3.0), (1, "b", "x", 7.0), (1, None, "x", 9.0)]
    df = spark.createDataFrame(rows, "k int, o string, i string, v double")

    def got(inner):
        found = aggregates.two_level_agg(df, inner, ["o"], "v", "k")
        plan = found._jdf.queryExecution().executedPlan().toString()
        return sorted(map(tuple, found.collect())), plan.count("Exchange hashpartitioning")

    assert got(["k", "o"]) == ([("a", 2, 3.33), ("b", 1, 7.0)], 2)
    assert got(["k", "o", "i"])[0] == [("a", 2, 2.5), ("b", 1, 7.0)]


def test_quintile_rating_reads_its_rows_once(spark):
    rows = spark.range(40).selectExpr("id % 7 AS v").groupBy("v").count()
    plan = aggregates.quintile_rating(rows, "count")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [v" not in plan and "Range" not in plan
