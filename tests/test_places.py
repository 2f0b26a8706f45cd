"""Entries of any length, found by one of their words."""

import random

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from gleaner.operators import mentions, slots


def by_hand(texts, entries):
    """(id, type, start, mention) by trying every entry at every word."""
    import regex
    split = regex.compile(mentions.PLACE_WORD).findall
    names = {}
    for kind, text in entries:
        run = (kind, tuple(split(text)))
        names[run] = min(text, names.get(run, text))
    out = []
    for i, text in texts:
        words = split(text or "")
        for (kind, run), name in names.items():
            out += [(i, kind, at, name) for at in range(len(words) - len(run) + 1) if run and tuple(words[at:at + len(run)]) == run]
    return sorted(out)


def make(seed, n_texts=40, n_entries=60):
    r = random.Random(seed)
    words = ["New", "York", "Old", "Town", "of", "the", "St", ".", "Louis", "Port", "-", "au", "Prince", ","]
    def some(lengths):
        return " ".join(r.choice(words) for _ in range(r.choice(lengths)))
    texts = [(i, some([0, 1, 5, 30])) for i in range(n_texts)] + [(100, None), (101, ""), (102, "St. Louis,St.Louis")]
    entries = [(r.choice(["GPE", "ORG"]), some([1, 2, 3, 12])) for _ in range(n_entries)] + [("GPE", "St. Louis"), ("GPE", "St.Louis"), ("ORG", "")]
    return texts, entries + [("GPE", t[:200]) for _, t in texts[:5] if t]


@pytest.mark.parametrize("large", [False, True])
def test_equal_to_trying_every_entry(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(mentions, "fits", lambda table: False)
    texts, entries = make(1)
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    gazetteer = spark.createDataFrame(entries, "type string, text string")
    expected = by_hand(texts, entries)
    found = mentions.place_mentions(frame, gazetteer)
    assert sorted(tuple(r) for r in found.collect()) == expected and expected
    both = mentions.mentions(frame, {"CAPITAL": "[A-Z][a-z]+"}, gazetteer).collect()
    assert sorted(tuple(r) for r in both if r.type != "CAPITAL") == expected
    capitals = mentions.mentions(frame, {"CAPITAL": "[A-Z][a-z]+"})
    assert sorted(tuple(r) for r in both if r.type == "CAPITAL") == sorted(tuple(r) for r in capitals.collect())


def test_a_long_entry_among_ten_thousand_costs_no_more(spark):
    """The words of a text meet only the entries that they anchor: a row a word, whatever the longest entry."""
    long_entry = "The Very Long Name Of A Place That Has Twelve Words Inside"
    entries = spark.range(10_000).select(F.lit("GPE").alias("type"), F.concat(F.lit("Place Number "), F.col("id").cast("string")).alias("text"))
    entries = entries.union(spark.createDataFrame([("GPE", long_entry)], entries.schema))
    texts = spark.createDataFrame([(1, f"We saw {long_entry} and Place Number 77."), (2, "Place Number Place Number 5")], "doc_id long, text string")
    found = mentions.place_mentions(texts, entries)
    assert sorted((r.doc_id, r.ord, r.mention) for r in found.collect()) == [(1, 2, long_entry), (1, 15, "Place Number 77"), (2, 2, "Place Number 5")]
    index = mentions.place_index(entries)
    assert index.groupBy("_anchor").count().agg(F.max("count")).first()[0] == 1 and index.count() == 10_001
    met = texts.select(F.posexplode(mentions.place_words()).alias("_at", "_anchor")).join(index, "_anchor").count()
    assert met == 3  # not a row for "Place" or "Number"


def test_one_scan_of_the_text(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet")
    gazetteer = spark.createDataFrame([("GPE", "Public License")], "type string, text string")
    plan = mentions.mentions(texts, {"CAPITAL": "[A-Z][a-z]+"}, gazetteer)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_slots_do_not_depend_on_the_size_of_the_gazetteer(spark, monkeypatch):
    said = [("e", f"Storm {n} made landfall in {p}, approach from St. Louis; evacuation of New York.") for n, p in enumerate(["Mali", "New York"] * 3)]
    frame = spark.createDataFrame(said + [("f", "No place here, landfall."), ("g", None)], "event_key string, text string")
    gazetteer = spark.createDataFrame([("GPE", p) for p in ("Mali", "New York", "St. Louis")], "type string, text string")
    small = slots.facts(frame, gazetteer)
    small = rows_of(small.columns, small.collect())
    monkeypatch.setattr(slots, "fits", lambda table: False)
    monkeypatch.setattr(mentions, "fits", lambda table: False)
    large = slots.facts(frame, gazetteer)
    assert rows_of(large.columns, large.collect()) == small and any("place" in str(r) for r in small)
