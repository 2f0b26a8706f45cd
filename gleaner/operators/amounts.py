"""Amounts of money and people, each bound to the nearest word of its sentence that says what it measures.

Words and numbers get positions; a number with its scale words ("1.5 billion", "two hundred") is one amount, and one with a dollar
sign or the word dollars is money. Dates, quantities with a unit and percentages are no amounts; dates and quantities don't count
as words either. All of it stays inside the row.
"""

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions import numbers as nb, vocab
from gleaner.functions.text import quote
from gleaner.operators.mentions import QUANTITY

# The words that say what an amount measures.
CUES = {"damage": ("damage", "damages"), "injuries": ("injured", "injuries"), "deaths": ("deaths", "death")}
MONEY = ("damage",)  # measured in money; the others in people
CURRENCY = ("dollar", "dollars")
SCALES = {"hundred": 100, "thousand": 1_000, "million": 1_000_000, "billion": 1_000_000_000}
TOKEN = r"[$]?[0-9][0-9,]*(?:[.][0-9]+)?%?|[\p{L}_][\p{L}\p{N}_]*"
LARGEST = 1e15
# What is taken out first; "$5 in damage" is money and not five inches.
SKIPPED = rf"([$]{nb.NUMBER})|(?:{QUANTITY})|(?:{nb.PERIOD})"

STATE = "struct<found: array<struct<a: int, b: int, value: double, money: boolean>>, a: int, b: int, total: double, part: double, money: boolean>"


def _case(values: dict, text: str, kind: str = "") -> str:
    return f"CASE {text} " + " ".join(f"WHEN {quote(k)} THEN {v}{kind}" for k, v in values.items()) + " END"


def found_amounts(text: str, cues: dict = None, money=MONEY) -> Column:
    """Array of (slot, value) for a column of sentences; an amount without a cue of its kind is left out.

    Of two cues equally near, the one after the amount is taken; the distance counts words.
    """
    cues = CUES if cues is None else cues
    cue = _case({w: quote(slot) for slot, words in cues.items() for w in words}, "t")
    units = {w: n for w, n in vocab.NUMBER_WORDS.items() if w not in SCALES}
    digits = "if(rlike(t, '^[$]?[0-9]') AND right(t, 1) <> '%', try_cast(translate(t, '$,', '') AS double), cast(NULL AS double))"
    tokens = (f"transform(regexp_extract_all(regexp_replace(`{text}`, {quote(SKIPPED)}, '$1 '), {quote(TOKEN)}, 0), "
              f"(w, i) -> transform(array(lower(w)), t -> named_struct('i', i, 'digits', {digits}, 'unit', {_case(units, 't', 'D')}, "
              f"'scale', {_case(SCALES, 't', 'D')}, 'sign', startswith(t, '$'), 'paid', t IN ({', '.join(map(quote, CURRENCY))}), "
              f"'cue', {cue}))[0])")
    closed = ("if(s.a IS NULL, s.found, concat(s.found, array(named_struct('a', s.a, 'b', s.b, 'value', s.total + s.part, "
              "'money', {money}))))")
    empty = f"cast(named_struct('found', array(), 'a', NULL, 'b', NULL, 'total', 0D, 'part', 0D, 'money', false) AS {STATE})"

    def state(found, a, total, part, money):
        return (f"cast(named_struct('found', {found}, 'a', {a}, 'b', w.i, 'total', {total}, 'part', {part}, 'money', {money}) AS {STATE})")
    fold = ("CASE "
            # A number in digits begins an amount, a scale word multiplies the open one, a number word adds to it.
            f"WHEN w.digits IS NOT NULL THEN {state(closed.format(money='s.money'), 'w.i', '0D', 'w.digits', 'w.sign')} "
            f"WHEN w.scale = 100 THEN {state('s.found', 'coalesce(s.a, w.i)', 's.total', 'if(s.part = 0, 1D, s.part) * 100', 's.money')} "
            f"WHEN w.scale > 100 THEN {state('s.found', 'coalesce(s.a, w.i)', 's.total + if(s.part = 0, 1D, s.part) * w.scale', '0D', 's.money')} "
            f"WHEN w.unit IS NOT NULL THEN {state('s.found', 'coalesce(s.a, w.i)', 's.total', 's.part + w.unit', 's.money')} "
            f"ELSE {state(closed.format(money='s.money OR w.paid'), 'NULL', '0D', '0D', 'false')} END")
    ended = closed.format(money="s.money")
    amounts = f"aggregate(tokens, {empty}, (s, w) -> {fold}, s -> {ended})"
    is_money = f"c.cue IN ({', '.join(map(quote, money)) or 'NULL'})"
    nearest = (f"array_min(transform(filter(cues, c -> ({is_money}) = m.money), c -> named_struct('distance', "
               "if(c.i > m.b, c.i - m.b, m.a - c.i), 'before', c.i < m.a, 'cue', c.cue)))")
    bound = (f"filter(transform({amounts}, m -> named_struct('slot', {nearest}.cue, 'value', m.value)), "
             f"x -> x.slot IS NOT NULL AND x.value < {LARGEST:.0f})")
    whole = "transform({0}, x -> named_struct('slot', x.slot, 'value', cast(round(x.value) AS bigint)))"
    # Tokens and cues are named once, as the items of one-element arrays.
    with_cues = f"transform(array(filter(tokens, w -> w.cue IS NOT NULL)), cues -> {whole.format(bound)})[0]"
    return F.coalesce(F.expr(f"transform(array({tokens}), tokens -> {with_cues})[0]"), F.expr("cast(array() AS array<struct<slot: string, value: bigint>>)"))


def amount_facts(sentences: DataFrame, cues: dict = None, money=MONEY, by: str = "event_key") -> DataFrame:
    """Counted amounts of sentences(by, text): (by, slot, value, n). One scan; the shuffle carries counts of distinct values.

    A null or empty sentence has no amounts.
    """
    return (sentences.select(by, F.inline(found_amounts("text", cues, money))).groupBy(by, "slot", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def amount_summary(facts: DataFrame, by: str = "event_key") -> DataFrame:
    """Lowest, middle and highest amount of each slot, and how often amounts are given: (by, slot, low, median, high, n).

    The median counts every mention; its buffer holds the distinct values of one event and slot.
    """
    return facts.groupBy(by, "slot").agg(F.min("value").alias("low"), F.percentile("value", 0.5, F.col("n")).alias("median"),
                                         F.max("value").alias("high"), F.sum("n").alias("n"))
