"""The merge of bigrams and words by rounds against picking one after the other."""

import random

import pytest

from gleaner.operators import groups


def by_hand(bigrams, words, num_bigrams, num_words):
    listed = [w for w, _ in sorted(words, key=lambda x: (-x[1], x[0]))[:num_words]]
    known, used, out = set(listed), set(), []
    for bigram, _ in sorted(bigrams, key=lambda x: (-x[1], x[0]))[:num_bigrams]:
        a, b = bigram.split(" ")
        if a != b and a in known and b in known and a not in used and b not in used:
            used |= {a, b}
            out.append(("bigram", bigram))
    return out + [("word", w) for w in listed if w not in used]


def found(spark, bigrams, words, num_bigrams, num_words):
    frames = spark.createDataFrame(bigrams, "bigram string, n long"), spark.createDataFrame(words, "lemma string, n long")
    rows = groups.merge_collocations(*[f.repartition(5) for f in frames], num_bigrams, num_words).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(rows)))
    return [(r.kind, r.item) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_picking_in_order(spark, seed):
    r = random.Random(seed)
    words = [(f"w{i}", r.randrange(20)) for i in range(60)]
    bigrams = list({(f"w{min(r.randrange(80), r.randrange(80))} w{r.randrange(80)}"): r.randrange(15) for _ in range(400)}.items())
    for k, n in ((10, 20), (300, 60), (1000, 1000)):
        assert found(spark, bigrams, words, k, n) == by_hand(bigrams, words, k, n)


def test_a_word_in_a_third_of_all_bigrams_and_a_chain(spark):
    bigrams = [(f"hot x{i}", 100) for i in range(50)] + [(f"c{i} c{i + 1}", 90 - i) for i in range(12)] + [("same same", 500)]
    words = [("hot", 9), ("same", 9)] + [(f"x{i}", 5) for i in range(40)] + [(f"c{i}", 4) for i in range(13)]
    assert found(spark, bigrams, words, 100, 100) == by_hand(bigrams, words, 100, 100)


def test_a_hundred_thousand_bigrams(spark):
    r = random.Random(7)
    words = [(f"w{i}", r.randrange(1000)) for i in range(100_000)]
    bigrams = list({f"w{r.randrange(100_000)} w{r.randrange(100_000)}": r.randrange(10 ** 9) for _ in range(110_000)}.items())
    assert found(spark, bigrams, words, 100_000, 90_000) == by_hand(bigrams, words, 100_000, 90_000)


def test_nothing_to_merge(spark):
    assert found(spark, [], [("a", 1), ("b", 2)], 5, 5) == [("word", "b"), ("word", "a")]
    assert found(spark, [("a b", 1)], [], 5, 5) == []
