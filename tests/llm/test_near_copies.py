"""Near copies by five-word shingles against brute force."""

import itertools
import random

import numpy as np
import pytest
from llm.conftest import ODD

from visitry.llm import near_copies


def kept_of(rows):
    sets = {t: set(near_copies.shingle_set(t).tolist()) for _, t in rows}
    name = {t: t for t in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        union = len(sets[a] | sets[b])
        if not union or len(sets[a] & sets[b]) / union >= 0.8:
            name[find(a)] = find(b)
    least = {}
    for i, t in rows:
        least[find(t)] = min(i, least.get(find(t), i))
    return set(least.values())


@pytest.mark.parametrize("crowded", [8, 2])
def test_planted_copies(make, monkeypatch, crowded):
    monkeypatch.setattr(near_copies, "CROWDED", crowded)
    rnd = random.Random(4)
    rows, doc = [r for r in ODD if r[0] is not None], 100
    for share in (0.005, 0.01, 0.02, 0.06):
        for n in (60, 300, 900):
            base = [f"w{rnd.randrange(5000)}" for _ in range(n)]
            for copy in range(20):
                changed = set(rnd.sample(range(n), round(n * share))) if copy else ()
                rows.append((doc, " ".join(f"new{rnd.randrange(10**6)}" if k in changed else w for k, w in enumerate(base))))
                doc += 1
    want = kept_of(rows)
    got = near_copies.drop_near_copies(make(rows))
    assert "n_words" in got.columns and {r["doc_id"] for r in got.collect()} == want
    # of copies with 0.5 and 1 % changed words none but the first stays
    assert len([i for i in want if 100 <= i < 220]) == 6


def test_bands_meet_as_often_as_stated():
    rng, met, pairs = np.random.default_rng(5), 0, 400
    for _ in range(pairs):
        a = rng.integers(1, 1 << 63, 180, dtype=np.uint64)
        b = np.concatenate([a[:160], rng.integers(1, 1 << 63, 20, dtype=np.uint64)])
        met += sum(x == y for x, y in zip(near_copies.band_keys(a), near_copies.band_keys(b), strict=True))
    assert abs(met / pairs / near_copies.BANDS - 0.8**near_copies.ROWS) < 0.02


def test_similar_sets_meet_in_their_first_shingles():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
        keep = rng.random(len(a)) > 0.1
        b = np.unique(np.concatenate([a[keep], rng.integers(1, 1 << 63, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64)]))
        counts = rng.integers(0, 4, 64)
        if len(b) and near_copies.similar(a, b):
            assert np.intersect1d(near_copies.prefix(a, counts), near_copies.prefix(b, counts)).size
    assert near_copies.prefix(np.zeros(0, np.uint64), np.zeros(4, np.int64)).size == 0


def test_only_likely_pairs_ship_their_sets(spark):
    """Sizes and sketches rule out most pairs that are not similar, and none that is."""
    rng = np.random.default_rng(6)
    sets = []
    for n in (0, 1, 9, 10, 40, 300, 3000):
        base = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        for change in (0, 0.05, 0.1, 0.11, 0.12, 0.5):
            new = rng.integers(1, 1 << 63, round(n * change), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([base[len(new) :], new])))
    rows = [(i, s.tobytes(), len(s), near_copies.sketch(s).tolist()) for i, s in enumerate(sets)]
    known = spark.createDataFrame(rows, "text_id long, shingles binary, size long, sketch array<long>")
    pairs = list(itertools.combinations(range(len(sets)), 2))
    want = {(a, b) for a, b in pairs if near_copies.similar(sets[a], sets[b])}
    frame = spark.createDataFrame(pairs, "a long, b long")
    likely = {tuple(r) for r in near_copies._likely(frame, known).collect()}
    assert want <= likely and len(likely) < len(want) + 30 < len(pairs) / 4
    assert {tuple(r) for r in near_copies._similar(frame, known).collect()} == want


@pytest.mark.parametrize("slots", [1 << 20, 8])
def test_boilerplate_in_crowded_buckets(make, monkeypatch, slots):
    """Texts that share a boilerplate of two thirds are no copies, but their own copies are found among them."""
    monkeypatch.setattr(near_copies, "CROWDED", 2)
    monkeypatch.setattr(near_copies, "SLOTS", slots)
    rnd = random.Random(9)
    shared = [f"s{k}" for k in range(200)]
    rows = []
    for k in range(40):
        own = shared + [f"w{rnd.randrange(10**6)}" for _ in range(100)]
        for copy in range(4):
            text = list(own)
            for at in rnd.sample(range(300), (0, 1, 4, 7)[copy]):
                text[at] = f"new{rnd.randrange(10**6)}"
            rows.append((4 * k + copy, " ".join(text)))
    want = kept_of(rows)
    assert {4 * k for k in range(40)} <= want
    assert {r["doc_id"] for r in near_copies.drop_near_copies(make(rows)).collect()} == want


def test_fingerprints_bring_candidates(make, monkeypatch):
    """Texts of close fingerprints are compared even if no band holds them together, and kept apart if not similar."""
    monkeypatch.setattr(near_copies, "band_keys", lambda shingles: [])
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(5000)}" for _ in range(4000)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:2000], "other", *base[2001:]])), (3, "a b c"), (4, "a  B c"), (5, "d e f"), (6, None), (7, " ")]
    assert {r["doc_id"] for r in near_copies.drop_near_copies(make(rows)).collect()} == kept_of(rows) == {1, 3, 5, 6}
    monkeypatch.setattr(near_copies, "fingerprints", lambda docs, width: docs.selectExpr("doc_id", "0L AS fingerprint"))
    rows = [(1, "a b c"), (2, "d e f"), (3, " ".join(base))]
    assert {r["doc_id"] for r in near_copies.drop_near_copies(make(rows)).collect()} == {1, 2, 3}


def test_frequent_shingles_bring_together_what_may_be_similar_only(spark):
    """Sixty sets hold the same shingles behind 15 % of their own: none can be similar, so none are paired; others are."""
    rows = []
    sets = [(k, [1000 * k + j for j in range(15)], 100) for k in range(60)] + [(60 + k, [-9 - k % 3], 80 + k) for k in range(12)]
    for text, own, size in sets:
        shared = [10**6 + j for j in range(size - len(own))]
        for left, shingle in zip(range(size - 1, -1, -1), (own + shared)[: size // 5 + 1], strict=False):
            rows.append((shingle, text, size, left, text))
    met = spark.createDataFrame(rows, "shingle long, text_id long, size long, left long, component long")
    largest = met.groupBy("shingle").agg({"text_id": "max"}).withColumnRenamed("max(text_id)", "largest")
    found = {frozenset((r["text_id"], r["text_id_x"])) for r in near_copies._meeting(met.join(largest, "shingle")).collect()}
    whole = {t: {*own, *(10**6 + j for j in range(size - len(own)))} for t, own, size in sets}
    alike = {frozenset((a, b)) for a, b in itertools.combinations(whole, 2) if len(whole[a] & whole[b]) >= 0.8 * len(whole[a] | whole[b])}
    assert alike and alike <= found
    assert not any(min(pair) < 60 and max(pair) < 60 for pair in found)
