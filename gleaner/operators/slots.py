"""Event slots: values about each event, gathered from its sentences, and report sentences filled with them.

All slots start from one table of counted facts (event, slot, value, n): one scan, and the shuffle carries counts of
distinct values, so an event with very many sentences is spread over all tasks before it is grouped.
"""

import re
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from gleaner.functions import numbers as nb, text as tx, vocab
from gleaner.functions.joins import fits, lookup_join
from gleaner.functions.text import quote
from gleaner.operators import mentions as mn
from gleaner.operators.text import relevant_sentences
from gleaner.sources.staging import stage

# Topic words, and the patterns of names and categories.
KEYWORDS = {
    "wind": ("wind", "winds"),
    "rain": ("rain",),
    "size": ("diameter", "radius"),
    "landfall": ("landfall", "approach"),
    "deaths": ("deaths", "death"),
    "evacuation": ("evacuate", "evacuated", "evacuation"),
    "restoration": ("restored", "restoration", "aid", "shelter"),
}
EVENT_NAME = "[Hh]urricane ([A-Z][a-z]+)"
STORM_NAME = "[Tt]ropical [Ss]torm ([A-Z][a-z]+)"
CATEGORY = "[Cc]ategory ([0-9]+)"
MILES = rf"({nb.NUMBER})[ -]?miles?\b"
MODAL = ("name", "storm", "category", "landfall_category", "headcount")
PLACES = ("landfall_place", "evacuation_place")
NUMERIC = ("wind", "rain", "size", "deaths")
DATES = ("landfall_date", "date")
SLOTS = MODAL + PLACES + NUMERIC + DATES


def facts(sentences: DataFrame, gazetteer: DataFrame = None, slots=SLOTS, keywords=None, by: str = "event_key"
          ) -> DataFrame:
    """Counted slot values of sentences(by, text): (by, slot, value, n). Place slots need gazetteer(type, text)."""
    words = {**KEYWORDS, **(keywords or {})}
    # SQL text, as the many small expressions parse faster than they are put together from Column objects.

    def about(topic):
        return "(" + " OR ".join(f"contains(text, {quote(w)})" for w in words[topic]) + ")"

    def near(topic, values):
        return f"CASE WHEN {about(topic)} THEN {values} ELSE cast(array() AS array<string>) END"

    def all_of(pattern):
        return f"regexp_extract_all(text, {quote(pattern)}, 1)"

    def with_unit(units):
        pattern = nb.bounded([u for names in units.values() for u in names])
        return f"filter(quantities, q -> rlike(q, {quote(pattern)}))"

    def plain(number):
        return f"replace({number}, ',', '')"

    found_miles = plain(f"regexp_extract(q, {quote(MILES)}, 1)")
    miles = f"filter(transform(quantities, q -> try_cast({found_miles} AS double)), m -> m IS NOT NULL)"
    miles = f"transform({miles}, m -> regexp_replace(cast(if(contains(text, 'diameter'), m, 2 * m) AS string), '[.]0$', ''))"
    deaths = f"transform({all_of(f'({nb.NUMBER}) deaths')}, d -> {plain('d')})"
    counted = (f"concat({deaths}, filter(transform({all_of('([a-z]+) deaths')}, w -> "
               f"cast({nb.number_word('w')} AS string)), n -> n IS NOT NULL))")
    values = {
        "name": all_of(EVENT_NAME), "storm": all_of(STORM_NAME), "category": all_of(CATEGORY),
        "landfall_category": near("landfall", all_of(CATEGORY)),
        "landfall_date": near("landfall", "dates"), "date": "dates",
        "headcount": near("evacuation", all_of("([0-9][0-9,]*) people")),
        "wind": near("wind", with_unit(nb.SPEED_UNITS)), "rain": near("rain", with_unit(nb.LENGTH_UNITS)),
        "size": near("size", miles), "deaths": near("deaths", counted),
        "landfall_place": near("landfall", "_words"), "evacuation_place": near("evacuation", "_words"),
    }
    text = F.col("text")
    found = sentences.select(by, "text", tx.find_all(text, mn.QUANTITY).alias("quantities"),
                             tx.find_all(text, nb.DATE).alias("dates"))
    placed = [s for s in slots if s in PLACES]
    index = stage(mn.place_index(gazetteer.withColumn("type", F.lit("place"))), "index") if placed else None
    listed = mn.listed_places(index) if placed else None
    looked_up = placed and listed is None  # by a join of all words, not inside the row
    if looked_up and not fits(index):
        # The words of a gazetteer too large for every task are looked up apart.
        others = [s for s in slots if s not in PLACES]
        said = relevant_sentences(sentences, (*words["landfall"], *words["evacuation"]))
        said = mn.place_mentions(said, gazetteer.withColumn("type", F.lit("place")), (by, "text"))
        marks = ", ".join(f"if({about(s.split('_')[0])}, {quote(s)}, NULL)" for s in placed)
        said = said.select(by, F.explode(F.expr(f"filter(array({marks}), s -> s IS NOT NULL)")).alias("slot"), F.col("mention").alias("value"))
        counted_places = said.groupBy(by, "slot", "value").agg(F.count(F.lit(1)).alias("n"))
        return facts(sentences, None, others, keywords, by).unionByName(counted_places) if others else counted_places
    if placed:
        words["place"] = (*words["landfall"], *words["evacuation"])
        said = f"regexp_extract_all(text, {quote(mn.PLACE_WORD)}, 0)" if looked_up else f"transform({listed}, p -> p.mention)"
        found = found.withColumn("_words", F.expr(near("place", said)))

    def cell(slot):
        at = "i" if looked_up and slot in placed else "cast(NULL AS int)"
        return f"transform({values[slot]}, (v, i) -> named_struct('slot', {quote(slot)}, 'value', v, '_at', {at}))"

    cells = ", ".join(cell(s) for s in slots)
    # The outer form: for the inner one Spark adds a size filter that finds all values a second time.
    rows = found.select(by, *(["_words"] if looked_up else []), F.expr(f"inline_outer(concat({cells}))")).filter("slot IS NOT NULL")
    if looked_up:
        # A word becomes the places that it anchors, before the shuffle, so that only real ones are counted.
        rows = rows.withColumn("_anchor", F.when(F.col("_at").isNotNull(), F.col("value")))
        rows = (rows.join(F.broadcast(index), "_anchor", "left").filter(F.col("_at").isNull() | F.expr(mn.STANDS))
                .withColumn("value", F.coalesce("mention", "value")))
    return rows.groupBy(by, "slot", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(facts: DataFrame, slots=MODAL, by: str = "event_key") -> DataFrame:
    """Most frequent value of each slot, ties to the smaller value: (by, slot, value, n)."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return (facts.filter(F.col("slot").isin(*slots)).groupBy(by, "slot").agg(best.alias("best"))
            .select(by, "slot", F.col("best.value").alias("value"), (-F.col("best.n")).alias("n")))


def top_values(facts: DataFrame, limits: dict, by: str = "event_key") -> DataFrame:
    """The most frequent values of each slot, `limits` maps slot to k: (by, slot, rank, value, n)."""
    order = Window.partitionBy(by, "slot").orderBy(F.desc("n"), "value")
    slot = F.col("slot")
    # One pass for all slots: the facts may cost a scan of all sentences.
    limit = reduce(lambda c, s: c.when(slot == s, limits[s]), limits, F.when(F.lit(False), 0))
    return (facts.filter(slot.isin(*limits)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
            .select(by, "slot", "rank", "value", "n"))


def ranges(facts: DataFrame, slots=NUMERIC, floors=None, by: str = "event_key") -> DataFrame:
    """Whole-number low (mean - sd), high (mean + sd), mean and sd of numeric slots: (by, slot, low, high, mean, sd).

    `floors` maps a slot to the value its numbers must exceed.
    """
    floors = {"wind": 40.0} if floors is None else floors
    slot, value = F.col("slot"), F.col("value")
    number = (F.when(slot == "wind", nb.to_mph(value)).when(slot == "rain", nb.to_inches(value))
              .otherwise(value.try_cast("double")))
    floor = reduce(lambda c, s: c.when(slot == s, floors[s]), floors, F.when(F.lit(False), 0.0)).otherwise(-0.5)
    rows = (facts.filter(slot.isin(*slots)).withColumn("_x", number).filter(F.col("_x") > floor))
    n, s = F.sum("n"), F.sum(F.col("_x") * F.col("n"))
    squares = F.sum(F.col("_x") * F.col("_x") * F.col("n"))
    sums = rows.groupBy(by, "slot").agg((s / n).alias("m"), (squares / n).alias("m2"))
    sums = sums.withColumn("s", F.sqrt(F.greatest(F.lit(0.0), F.col("m2") - F.col("m") * F.col("m"))))
    m, sd = F.col("m"), F.col("s")
    return sums.select(by, "slot", (m - sd).cast("int").alias("low"), (m + sd).cast("int").alias("high"),
                       m.cast("int").alias("mean"), sd.cast("int").alias("sd"))


def date_parts(facts: DataFrame, slot: str = "date", by: str = "event_key") -> DataFrame:
    """Month, day, year and date of each distinct date text: (by, value, month, day, year, date, n)."""
    value = F.col("value")
    return facts.filter(F.col("slot") == slot).select(
        by, "value", nb.month_of("value").alias("month"), nb.last(nb.days_of(value)).alias("day"),
        nb.last(nb.years_of(value)).alias("year"), nb.date_of("value").alias("date"), "n")


def consensus_dates(facts: DataFrame, slot: str = "landfall_date", by: str = "event_key") -> DataFrame:
    """Modal month, and the modal day and modal year inside it: (by, month, day, year, date_text, month_year).

    Ties go to the earlier value; texts that lack a part do not vote on it.
    """
    value = F.col("value")
    dated = (facts.filter(F.col("slot") == slot)
             .select(by, "n", nb.month_of("value").alias("month"), nb.days_of(value).alias("days"),
                     nb.years_of(value).alias("years")).filter("month IS NOT NULL"))
    votes = F.concat(F.array(F.struct(F.lit("month").alias("part"), F.col("month").alias("vote"))),
                     F.transform("days", lambda d: F.struct(F.lit("day").alias("part"), d.alias("vote"))),
                     F.transform("years", lambda y: F.struct(F.lit("year").alias("part"), y.alias("vote"))))
    counted = (dated.select(by, "month", "n", F.inline(votes)).groupBy(by, "month", "part", "vote")
               .agg(F.sum("n").alias("n")))
    # At most 12 x (1 + 31 + years) rows per event from here on.
    winner = F.min(F.struct((-F.col("n")).alias("n"), "vote"))
    per_month = counted.groupBy(by, "month", "part").agg(winner.alias("best"))

    def of(part):
        return F.max(F.when(F.col("part") == part, F.col("best.vote")))
    months = per_month.groupBy(by, "month").agg(
        F.max(F.when(F.col("part") == "month", -F.col("best.n"))).alias("n"), of("day").alias("day"),
        of("year").alias("year"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "month", "day", "year")).alias("best")
    name = nb.month_name(F.col("month"))
    return months.groupBy(by).agg(best).select(by, "best.month", "best.day", "best.year").select(
        "*", F.concat(name, F.lit(" "), "day", F.lit(", "), "year").alias("date_text"),
        F.concat(name, F.lit(" "), "year").alias("month_year"))


def periods(sentences: DataFrame, by: str = "event_key") -> DataFrame:
    """Dates and parts of dates that sentences mention, as spans of days: (by, value, month, first_day, last_day, n).

    A month without a year has no days. Each distinct text is counted first and read once.
    """
    texts = (sentences.select(by, F.explode(nb.periods_of(F.col("text"))).alias("value"))
             .groupBy(by, "value").agg(F.count(F.lit(1)).alias("n")))
    span = texts.select(by, "value", nb.month_of("value").alias("month"), nb.interval_of("value").alias("span"), "n")
    return span.select(by, "value", "month", "span.first_day", "span.last_day", "n")


def likely_period(periods: DataFrame, by: str = "event_key") -> DataFrame:
    """The days that most mentions of an event allow, the earliest such stretch: (by, first_day, last_day, n).

    Spans are added up at their first day and taken off after their last, so an event has at most a row a day from there on.
    """
    ends = periods.filter("first_day IS NOT NULL").select(by, F.inline(F.array(
        F.struct(F.col("first_day").alias("day"), F.col("n").alias("change")),
        F.struct(F.date_add("last_day", 1).alias("day"), (-F.col("n")).alias("change")))))
    days = ends.groupBy(by, "day").agg(F.sum("change").alias("change")).filter("change <> 0")
    order = Window.partitionBy(by).orderBy("day")
    running = days.select(by, "day", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
                          F.lead("day").over(order).alias("next"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("day").alias("first_day"), F.date_sub("next", 1).alias("last_day")))
    return (running.filter("n > 0").groupBy(by).agg(best.alias("best"))
            .select(by, "best.first_day", "best.last_day", (-F.col("best.n")).alias("n")))


def first_dates(sentences: DataFrame, names: DataFrame, by: str = "event_key") -> DataFrame:
    """Earliest complete date in the sentences that hold the event's name, from names(by, value): (by, first_date).

    Of a range of days the first one counts.
    """
    # Written out, as the names may cost a scan of all sentences and the join reads them twice.
    names = stage(names.select(by, F.col("value").alias("_name")), "names")
    named = lookup_join(sentences.select(by, "text"), names, by).filter(F.contains("text", F.col("_name")))
    # Dates are sought in the sentences with the name alone, once (the inner form of explode would add a size filter that
    # seeks them again). Distinct date texts are counted out first, so each is parsed once.
    texts = (named.select(by, F.explode_outer(nb.periods_of(F.col("text"))).alias("value")).filter("value IS NOT NULL").distinct())
    complete = nb.month_of("value").isNotNull() & (F.size(nb.days_of(F.col("value"))) > 0)
    first = F.when(complete, nb.interval_of("value")["first_day"])
    return (texts.withColumn("date", first).groupBy(by).agg(F.min("date").alias("first_date"))
            .filter("first_date IS NOT NULL"))


def mentions_by_type(sentences: DataFrame, gazetteer: DataFrame, keywords=None, patterns=None,
                     by: str = "event_key", organisations: bool = False) -> DataFrame:
    """Mentions of each type in the sentences with a keyword: (by, type, mention, n).

    With `organisations` those too, as type ORG; the evidence for them comes from the same sentences.
    """
    near = relevant_sentences(sentences, keywords or KEYWORDS["restoration"])
    found = mn.mentions(near, patterns or mn.EVENT_PATTERNS, gazetteer, keep=(by,))
    if organisations:
        found = found.unionByName(mn.organisations(near, keep=(by,)))
    return found.groupBy(by, "type", "mention").agg(F.count(F.lit(1)).alias("n"))


def fields(facts: DataFrame, first_dates: DataFrame, by: str = "event_key") -> DataFrame:
    """All slots of an event as one row of strings."""
    def long(df, name, value):
        return df.select(by, name.alias("field"), value.cast("string").alias("value"))
    slot = F.col("slot")
    modal = modes(facts, by=by)
    placed = top_values(facts, {"landfall_place": 2, "evacuation_place": 3}, by)
    spans = ranges(facts, by=by)
    span_high = F.when(slot == "size", F.col("mean") + F.col("sd")).otherwise(F.col("high"))
    dates = consensus_dates(facts, "landfall_date", by)
    spread = spans.select(by, "slot", F.explode(F.array(
        F.struct(F.lit("_low").alias("end"), F.col("low").alias("v")),
        F.struct(F.lit("_high").alias("end"), span_high.alias("v")),
        F.struct(F.lit("_mean").alias("end"), F.col("mean").alias("v")))).alias("x"))
    parts = [
        long(modal, slot, F.col("value")),
        long(placed, F.concat("slot", F.lit("_"), "rank"), F.col("value")),
        long(spread, F.concat("slot", "x.end"), F.col("x.v")),
        long(dates, F.lit("landfall_date"), F.col("date_text")),
        long(consensus_dates(facts, "date", by), F.lit("month_year"), F.col("month_year")),
        long(first_dates, F.lit("first_date"), F.date_format("first_date", "MMMM d, yyyy")),
    ]
    names = sorted({name for text in vocab.OUTLINES.values() for name in re.findall(r"{(\w+)}", text)} |
                   {"deaths_mean"})
    columns = [F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names]
    return reduce(DataFrame.unionByName, parts).groupBy(by).agg(*columns)


def report(fields: DataFrame, outlines: dict = None, by: str = "event_key") -> DataFrame:
    """Outline sentences with the slots filled in, (by, sentence_no, outline, text); one with a missing slot is left out."""
    rows = []
    for i, (name, text) in enumerate((outlines or vocab.OUTLINES).items()):
        pieces = [F.col(p[1:-1]) if p.startswith("{") else F.lit(p) for p in re.split(r"({\w+})", text) if p]
        rows.append(F.struct(F.lit(i).alias("sentence_no"), F.lit(name).alias("outline"),
                             F.trim(F.concat(*pieces)).alias("text")))
    return fields.select(by, F.inline(F.array(*rows))).filter("text IS NOT NULL")
