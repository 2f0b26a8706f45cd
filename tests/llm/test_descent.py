"""Near-duplicate embeddings against comparing every pair."""

import numpy as np

from gleaner.llm import descent

SCHEMA = "vec_id long, embedding array<double>, node long, n int, vec string"


def by_hand(rows, threshold=0.9):
    """{(id, vector): (links, component, kept)} by comparing all pairs."""
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    rows = sorted({(i, tuple(v) if usable(v) else None) for i, v in rows if i is not None}, key=repr)
    unit = [None if v is None else np.array(v) / np.abs(v).max() for _, v in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for size in {len(u) for u in unit if u is not None}:
        at = [k for k, u in enumerate(unit) if u is not None and len(u) == size]
        close = np.stack([unit[k] for k in at]) @ np.stack([unit[k] for k in at]).T >= threshold
        for i, j in zip(*np.nonzero(np.triu(close, 1))):
            a, b = at[i], at[j]
            links[a], links[b] = links[a] + 1, links[b] + 1
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, links[k], least[find(k)], least[find(k)] == i) for k, (i, _) in enumerate(rows))


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, 2, "clash") for i, v in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in descent.near_duplicates(frame, **options).select("id", "n_links", "component_id", "kept").collect())


def ball(random, centre, n, spread):
    return centre + spread * random.normal(size=(n, len(centre))) / np.sqrt(len(centre))


def numbered(data, start=0):
    return [(start + i, [float(x) for x in v]) for i, v in enumerate(data)]


def test_equal_to_every_pair(spark, monkeypatch):
    monkeypatch.setattr(descent, "BLOCK", 40)
    random = np.random.default_rng(5)
    data = [random.normal(size=(600, 24))]
    centres = random.normal(size=(4, 24))
    data += [ball(random, c, n, s) for c, n, s in zip(centres, (150, 60, 9, 3), (1.0, 1.4, 1.0, 1.0))]
    data = np.concatenate(data)
    rows = numbered(data[random.permutation(len(data))])
    same = rows[0][1]
    rows += [(2000, same), (2001, same), (2001, same), (2002, [2 * x for x in same]), (2003, None), (2004, []), (2005, [0.0] * 24),
             (2006, [None] * 24), (2007, [float("nan")] * 24), (2008, [float("inf")] * 24), (None, same), (2009, [1.0, 0.0]),
             (2010, [1.0, -0.0]), (2011, [1.0, 0.1]), (2012, [1e300, 1e300]), (2013, [1e-300, 1e-300]), (5, [0.0, 3.0]), (2014, [7.0])]
    got, true = found(spark, rows), by_hand(rows)
    assert [(g, t) for g, t in zip(got, true) if g != t] == [] and len(got) == len(true)


def test_crowds_that_touch(spark):
    """Two balls, each link inside better than any across, and a row of vectors that leads from one to the other."""
    random = np.random.default_rng(2)
    a = np.zeros(32)
    a[0] = 1
    b = a.copy()
    b[1] = np.tan(np.arccos(0.93))
    data = np.concatenate([ball(random, a, 120, 0.05), ball(random, b / np.linalg.norm(b), 120, 0.05), random.normal(size=(200, 32))])
    assert found(spark, numbered(data)) == by_hand(numbered(data))


def test_copies_of_a_third_of_all_rows(spark):
    random = np.random.default_rng(3)
    rows = numbered(np.concatenate([random.normal(size=(200, 16)), np.repeat(random.normal(size=(1, 16)), 300, axis=0)]))
    assert found(spark, rows) == by_hand(rows)


def test_lone_pairs_near_the_threshold(spark):
    """Pairs just above and below it among vectors that are near to nothing: at least nine tenths are found, and none below."""
    random = np.random.default_rng(4)
    one = random.normal(size=(500, 32))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = random.normal(size=one.shape)
    side -= (side * one).sum(1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = random.uniform(0.88, 0.94, (500, 1))
    rows = numbered(np.concatenate([one, cosine * one + np.sqrt(1 - cosine ** 2) * side, random.normal(size=(3000, 32))]))
    true, got = by_hand(rows), found(spark, rows)
    assert [t[0] for t in true] == [g[0] for g in got] and all(g[1] <= t[1] for t, g in zip(true, got))
    links = sum(t[1] for t in true)
    assert links > 300 and sum(g[1] for g in got) >= 0.97 * links


def test_few_or_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, None)]) == [(3, 0, 3, True)]
    assert found(spark, [(3, [1.0, 2.0]), (4, [1.0, 2.1])]) == [(3, 1, 3, True), (4, 1, 3, False)]


def test_sketches_bound_the_cosine():
    random = np.random.default_rng(6)
    data = random.normal(size=(300, 40)) * random.choice([0.01, 1, 30], (300, 40))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    whole, scale, error = descent._unpacked(descent.sketches(data))
    up, width = descent._bounds(whole @ whole.T, scale[:, None], scale[None, :], error[:, None], error[None, :])
    exact = data @ data.T
    assert (up >= exact).all() and (up - width <= exact).all() and np.array_equal(up, up.T) and (up - exact).max() < 0.1


def test_a_listed_node_is_salted(spark, monkeypatch):
    """A node that all others list meets them in groups of bounded size."""
    n = 600
    listed = [(i, [(0.5, 0, False, True)] if i else [(0.5, 1, False, True)]) for i in range(n)]
    graph = spark.createDataFrame([(i, 200, near, None) for i, near in listed],
                                  f"node long, room int, near array<{descent.ENTRY}>, far struct<score:float,nbr:bigint>")
    vectors = np.random.default_rng(1).normal(size=(n, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    sketched = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(descent.sketches(vectors))], "node long, sketch binary")
    monkeypatch.setattr(descent, "SPAN", 50)
    rows = descent.descended(graph, sketched, 0.9).select("node", "nbr").distinct().collect()
    # What node 0 lists meets all that list node 0, in whichever group they are.
    assert {r.node for r in rows if r.nbr == 1} >= set(range(2, n))
