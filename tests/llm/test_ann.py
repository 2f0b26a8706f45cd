"""Scoring in blocks: the memory of a task does not grow with the queries that meet a block."""

import tracemalloc

import numpy as np

from gleaner.llm import ann


def test_scores_of_many_queries_take_little_memory():
    random = np.random.default_rng(3)
    data = random.normal(size=(4096, 8))
    numbers = np.arange(4096) + 100
    asked = random.normal(size=(3000, 8))
    places = random.integers(0, 4300, 3000)
    given = (places, np.arange(3000), asked, numbers, np.arange(4096) * 10, data, 500, 3)
    found = [b.to_pydict() for b in ann.scored(*given)]
    tracemalloc.start()
    for _ in ann.scored(*given):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    got = {}
    for batch in found:
        for q, item, score in zip(batch["asked"], batch["item"], batch["score"]):
            got.setdefault(q, []).append((round(score, 9), item))
    for q in range(0, 3000, 50):
        near = np.flatnonzero(np.abs(numbers - places[q]) <= 500)
        scores = data[near] @ asked[q]
        best = np.argsort(-scores)[:3]
        assert sorted(got.get(q, [])) == sorted((round(float(scores[i]), 9), int(near[i]) * 10) for i in best)


def test_ties_with_the_last_stay():
    data = np.ones((6, 2))
    rows = next(ann.scored(np.array([2]), np.array([7]), np.ones((1, 2)), np.arange(6), np.arange(6), data, 2, 2)).to_pydict()
    assert rows == {"asked": [7] * 5, "item": [0, 1, 2, 3, 4], "score": [2.0] * 5}
