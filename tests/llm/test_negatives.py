"""Hard negatives against scoring every pair."""

import numpy as np
import pytest

from gleaner.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>, score string, row int, w int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def by_hand(rows, every, positives=5, count=10):
    """All rows of the result by scoring each anchor with every other row; rows are (id, label, vector)."""
    rows = sorted({(i, l, tuple(v)) for i, l, v in rows
                   if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    out = []
    for a in rows:
        if a[0] % every:
            continue
        scored = [(-sum(int(x) * int(y) for x, y in zip(a[2], b[2])), b[0], b[1]) for b in rows if b != a and len(a[2]) == len(b[2])]
        for s, i, _ in sorted(x for x in scored if x[2] == a[1])[:positives]:
            fits = sorted(x for x in scored if x[2] != a[1] and 30 * -s <= 100 * -x[0] <= 90 * -s)[:count]
            out += [(a[0], i, r, x[1], -s, -x[0]) for r, x in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, l, v, "clash", 1, 2) for i, l, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in COLUMNS) for r in negatives.hard_negatives(frame, **options).collect())


def vectors(seed, n, size=12, spread=256.0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(8, size))
    data = centres[random.integers(0, 8, n)] + random.normal(size=(n, size)) * random.choice([0.05, 0.5, 2.0], (n, 1))
    return [[float(x) for x in np.floor(spread * v)] for v in data]


def odd_rows(n=240):
    rows = [(i, i % 3 if i % 5 else 0, v) for i, v in enumerate(vectors(1, n))]  # one label holds most rows
    rows += [(300, 1, rows[3][2]), (301, 1, rows[3][2]), (302, 2, rows[3][2]), (302, 2, rows[3][2]), (303, 2, [0.0] * 12),
             (304, 9, rows[5][2]), (310, 1, [0.0] * 12), (None, 1, rows[3][2]), (320, None, rows[3][2]), (330, 1, None),
             (340, 1, [None] * 12), (350, 1, [float("nan")] * 12), (360, 1, [float("inf")] + [0.0] * 11), (370, 0, []), (371, 0, []),
             (372, 1, []), (380, 0, [5.0, 2.0]), (381, 0, [5.0, 1.0]), (382, 1, [3.0, 2.0]), (390, 7, [1.0])]
    return rows


def test_equal_to_scoring_every_pair(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 50)
    monkeypatch.setattr(negatives, "BATCH", 7)
    rows = odd_rows()
    expected = by_hand(rows, 10)
    assert expected and found(spark, rows, every=10) == expected


@pytest.mark.parametrize("steps", [(), (0.999,), (0.0,)])
def test_the_thresholds_do_not_change_the_result(spark, monkeypatch, steps):
    monkeypatch.setattr(negatives, "POSITIVE_STEPS", steps)
    monkeypatch.setattr(negatives, "NEGATIVE_STEPS", steps)
    rows = odd_rows(90)
    assert found(spark, rows, every=10, positives=3, negatives=4) == by_hand(rows, 10, 3, 4)


def test_one_id_with_several_vectors(spark):
    rows = [(0, i % 2, v) for i, v in enumerate(vectors(2, 6))] + [(i, i % 2, v) for i, v in enumerate(vectors(3, 40), 1)]
    assert found(spark, rows, every=50) == by_hand(rows, 50)


def test_empty_tables_and_no_anchor(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 1, [1.0, 2.0]), (2, 2, [1.0, 2.0])]) == []
    assert found(spark, [(100, 1, [1.0, 2.0])]) == []


@pytest.mark.parametrize("size", [0, 1, 8, 20])
@pytest.mark.parametrize("spread", [3, 1 << 28])
def test_threshold_scores(size, spread):
    random = np.random.default_rng(size)
    asked, stored = (random.integers(-spread, spread, (n, size)) for n in (9, 300))
    stored[:100] //= 50
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(a, b)) for b in stored] for a in asked]).reshape(9, 300)
    for share in (-1.0, 0.0, 0.3, 0.9, 1.5):
        least = (share * np.abs(exact).max(axis=1)).astype(np.int64)
        scores, hits = negatives.threshold_scores(asked, stored, least)
        assert np.array_equal(hits, exact >= least[:, None])
        assert np.array_equal(scores.astype(np.int64)[hits], exact[hits])
