"""Components of chains in any order of ids: few rounds, smallest ids."""

import random

import pytest

from visitry.llm import components


@pytest.mark.parametrize("order", ["rising", "falling", "shuffled"])
def test_rounds_of_a_chain(spark, monkeypatch, order):
    n, rounds = 2000, []
    ids = list(range(n))
    if order == "shuffled":
        random.Random(1).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) if order == "rising" else (ids[i + 1], ids[i]) for i in range(n - 1)]
    real = components.stored
    monkeypatch.setattr(components, "stored", lambda df, name="": (rounds.append(1) if name == "least" else None, real(df, name))[1])
    got = components.connected_components(spark.createDataFrame([*edges, (5000, 5001), (7, 7)], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [*((i, 0) for i in range(n)), (5000, 5000), (5001, 5000)]
    assert len(rounds) <= 15
