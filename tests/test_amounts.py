"""Amounts bound to cues and dates of any precision, against values written by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from gleaner.functions import numbers as nb
from gleaner.operators import amounts, mentions, slots

D = datetime.date

SENTENCES = {
    "Damage of $24 billion was reported, with 30 injured and two deaths.": {("damage", 24_000_000_000), ("injuries", 30), ("deaths", 2)},
    "There were 12 deaths and 1,200 injuries on September 14, 2018.": {("deaths", 12), ("injuries", 1200)},
    "Damages reached 1.5 million dollars.": {("damage", 1_500_000)},
    "Two hundred and some were injured.": {("injuries", 200)},
    "Twenty five injuries in 2018.": {("injuries", 25)},
    "A hundred injured, three thousand five hundred deaths": {("injuries", 100), ("deaths", 3500)},
    "The $3 ticket hurt nobody; 40 deaths.": {("deaths", 40)},
    "Winds of 100 mph did damage to 30% of the homes.": set(),
    "$1,000,000 in damages, $5 in damage": {("damage", 1_000_000), ("damage", 5)},
    "deaths 5 injuries": {("injuries", 5)},
    "damage 7": set(), "Unit B52 and NATION_1 had 5 deaths": {("deaths", 5)},
    "": set(), None: set(),
}


def test_amounts_go_to_the_nearest_cue(spark):
    rows = spark.createDataFrame([(s,) for s in SENTENCES], "text string")
    found = rows.select("text", amounts.found_amounts("text").alias("a")).collect()
    assert {r.text: {(x.slot, x.value) for x in r.a} for r in found} == SENTENCES


def test_amount_summary(spark):
    said = ["10 injured", "10 injured", "40 injuries", "$5 damage", None, "nothing"]
    facts = amounts.amount_facts(spark.createDataFrame([("e", s) for s in said], "event_key string, text string"))
    found = {tuple(r) for r in amounts.amount_summary(facts).collect()}
    assert found == {("e", "injuries", 10, 10.0, 40, 3), ("e", "damage", 5, 5.0, 5, 1)}


def test_other_cues(spark):
    rows = spark.createDataFrame([("e", "About 300 homes and $9 aid")], "event_key string, text string")
    facts = amounts.amount_facts(rows, {"homes": ("homes",), "aid": ("aid",)}, ("aid",))
    assert {(r.slot, r.value) for r in facts.collect()} == {("homes", 300), ("aid", 9)}


def test_amounts_of_a_very_long_sentence(spark):
    rows = spark.range(1).select(F.lit("e").alias("event_key"), F.repeat(F.lit("3 injured people and "), 2000).alias("text"))
    assert [tuple(r) for r in amounts.amount_facts(rows).collect()] == [("e", "injuries", 3, 2000)]


TIMES = {
    "14 September 2018": (D(2018, 9, 14), D(2018, 9, 14)), "Sept. 3, 2018": (D(2018, 9, 3), D(2018, 9, 3)),
    "14-16 September 2018": (D(2018, 9, 14), D(2018, 9, 16)), "September 14 to 16, 2018": (D(2018, 9, 14), D(2018, 9, 16)),
    "September 2018": (D(2018, 9, 1), D(2018, 9, 30)), "February 2020": (D(2020, 2, 1), D(2020, 2, 29)),
    "2018": (D(2018, 1, 1), D(2018, 12, 31)), "in 2018": (D(2018, 1, 1), D(2018, 12, 31)),
    "September": None, "September 14": None, "Feb 30, 2018": None, "": None, None: None,
}


def test_date_intervals(spark):
    rows = spark.createDataFrame([(t,) for t in TIMES], "t string").select("t", nb.interval_of("t").alias("i"))
    assert {r.t: tuple(r.i) if r.i else None for r in rows.collect()} == TIMES


@pytest.mark.parametrize("text, found", [
    ("It came in September.", ["September"]), ("came in September 2018.", ["September 2018"]), ("September was wet", ["September"]), ("They may March on", []),
    ("In May it rained", ["May"]), ("during 2018 it", ["2018"]), ("2000 people left", []),
    ("on 14-16 September 2018 it", ["14-16 September 2018"]), ("on September 14–16, 2018.", ["September 14–16, 2018"]),
    ("Mayor 5 and 3 Marches", []), ("on Sept. 3 it", ["Sept. 3"]), ("May 3 2018", ["May 3 2018"])])
def test_forms_of_periods(spark, text, found):
    got = spark.range(1).select(nb.periods_of(F.lit(text)).alias("x")).first().x
    assert got == found


def test_likely_period_and_first_date(spark):
    said = ["It hit in 2018.", "Storm Ann came in September 2018.", "Ann struck on 14-16 September 2018.", "By September 15, 2018 it was over.",
            "Seen again on 2 May 2019.", "September!", None]
    rows = spark.createDataFrame([("e", s) for s in said] + [("none", "September")], "event_key string, text string")
    found = slots.periods(rows)
    assert [tuple(r) for r in slots.likely_period(found).collect()] == [("e", D(2018, 9, 15), D(2018, 9, 15), 4)]
    names = spark.createDataFrame([("e", "Ann")], "event_key string, value string")
    assert slots.first_dates(rows, names).first().first_date == D(2018, 9, 14)
    assert slots.likely_period(found.limit(0)).count() == 0


def test_organisations_by_corpus_evidence(spark):
    said = ["The Red Cross sent aid.", "Some aid came from the American Red Cross and the Coast Guard.", "The Coast Guard left shelter to Ann Smith.",
            "Aid by Hurricane Florence, John Smith said.", "The Last Word on aid.", "aid", "", None]
    rows = spark.createDataFrame([("e", s) for s in said], "event_key string, text string")
    found = slots.mentions_by_type(rows, spark.createDataFrame([("GPE", "Mali")], "type string, text string"), organisations=True)
    assert {tuple(r) for r in found.collect()} == {("e", "ORG", "Red Cross", 1), ("e", "ORG", "American Red Cross", 1),
                                                   ("e", "ORG", "Coast Guard", 2)}
    assert mentions.organisations(rows.limit(0), ("event_key",)).count() == 0
