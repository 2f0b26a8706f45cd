"""Numbers, units and dates in free text."""

from pyspark.sql import Column, functions as F

from gleaner.functions import vocab
from gleaner.functions.text import find_all, quote

NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?"
MONTH = "|".join("Sept?(?:ember)?" if m == "September" else m if len(m) == 3 else f"{m[:3]}(?:{m[3:]})?"
                 for m in vocab.MONTHS)
# Month and day, month and year, or all three; day first or month first, with or without point and comma.
DATE = (rf"\b(?:[0-9]{{1,2}} (?:{MONTH})\b[.]?(?:,? [0-9]{{4}})?"
        rf"|(?:{MONTH})\b[.]? (?:[0-9]{{1,2}},? [0-9]{{4}}|[0-9]{{4}}|[0-9]{{1,2}}))")
_DAYS = r"[0-9]{1,2}(?: ?(?:-|–|to|through) ?[0-9]{1,2}\b)?"
_PLAIN_MONTH = "|".join(m for m in MONTH.split("|") if m not in ("May", "Mar(?:ch)?"))  # those two are words, too
_TIME = "(?:[Ii]n|[Oo]f|[Ss]ince|[Dd]uring|[Uu]ntil|[Bb]y|[Ee]arly|[Ll]ate)"
_FULL = (rf"(?:{_DAYS} (?:{MONTH})\b(?:[.]?,? [0-9]{{4}}\b)?"
         rf"|(?:{MONTH})\b[.]? (?:{_DAYS},? [0-9]{{4}}\b|[0-9]{{4}}\b|{_DAYS}\b))")
# A date or a part of one: days of a month with or without year, a month, or what follows a word of time: any month or a year.
PERIOD = rf"\b(?:{_TIME} (?:{_FULL}|(?:{MONTH})\b|(?:19|20)[0-9]{{2}}\b)|{_FULL}|(?:{_PLAIN_MONTH})\b)"
KPH_TO_MPH = 0.62137
CM_PER_INCH = 2.54
SPEED_UNITS = {"mph": ("mph", "miles per hour", "mile per hour"),
               "kph": ("kph", "kilometers per hour", "kilometer per hour")}
LENGTH_UNITS = {"inch": ("inches", "inch", "in"), "cm": ("cm", "centimeters", "centimeter")}
OTHER_UNITS = ("miles", "mile", "kilometers", "kilometer", "feet", "foot")


def bounded(choices) -> str:
    """Pattern for any of the choices standing as whole words."""
    return f"(?:^|[^A-Za-z])(?:{'|'.join(choices)})(?:[^A-Za-z]|$)"


def numbers(text: Column, mode: str = "value") -> Column:
    """Array of numbers: '1,000' and '74.5' as written, or every run of digits with mode='digits'."""
    if mode == "digits":
        return F.transform(find_all(text, "[0-9]+"), lambda x: x.cast("double"))
    return F.transform(find_all(text, NUMBER), lambda x: F.replace(x, F.lit(","), F.lit("")).cast("double"))


def mean(values: Column) -> Column:
    """Mean of an array, 0 when it is empty."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)


def _convert(text, units, factors, mode):
    average = mean(numbers(text, mode))
    out = None
    for unit, factor in factors:
        hit = text.rlike(bounded(units[unit]))
        value = factor(average)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(-1.0)


def to_mph(text: Column, mode: str = "value") -> Column:
    """Mean of the numbers as miles per hour; -1 without a known unit."""
    return _convert(text, SPEED_UNITS, [("mph", lambda x: x), ("kph", lambda x: x * KPH_TO_MPH)], mode)


def to_inches(text: Column, mode: str = "value") -> Column:
    """Mean of the numbers as inches; -1 without a known unit."""
    return _convert(text, LENGTH_UNITS, [("inch", lambda x: x), ("cm", lambda x: x / CM_PER_INCH)], mode)


def number_word(word: str) -> str:
    """SQL text for the value of a number word; null for other words."""
    return f"CASE {word} {' '.join(f'WHEN {quote(w)} THEN {n}' for w, n in vocab.NUMBER_WORDS.items())} END"


def _ints(text):
    return F.filter(F.transform(find_all(text, "[0-9]+"), lambda x: x.try_cast("int")), lambda x: x.isNotNull())


def month_of(text: str) -> Column:
    """Number of the first month named as a whole word in a column; null without one."""
    pattern = quote(f"(?:^|[^A-Za-z])({MONTH})(?:[^A-Za-z]|$)")
    cases = " ".join(f"WHEN {quote(month[:3])} THEN {i}" for i, month in enumerate(vocab.MONTHS, start=1))
    return F.expr(f"CASE left(regexp_extract({text}, {pattern}, 1), 3) {cases} END")


def years_of(text: Column) -> Column:
    """Numbers above 1900."""
    return F.filter(_ints(text), lambda x: x > 1900)


def days_of(text: Column) -> Column:
    """Numbers from 1 to 31."""
    return F.filter(_ints(text), lambda x: x.between(1, 31))


def last(values: Column) -> Column:
    """Last item of an array; null when it is empty."""
    return F.try_element_at(values, F.lit(-1))


def date_of(text: str) -> Column:
    """The date in a text column, when month, day and year are all there and valid; else null."""
    value = F.col(text)
    parts = F.concat(F.lpad(last(years_of(value)).cast("string"), 4, "0"), F.lit("-"),
                     F.lpad(month_of(text).cast("string"), 2, "0"), F.lit("-"),
                     F.lpad(last(days_of(value)).cast("string"), 2, "0"))
    return parts.try_cast("date")


def periods_of(text: Column) -> Column:
    """Array of the dates and parts of dates in a text, without the word of time before them."""
    return F.transform(find_all(text, PERIOD), lambda x: F.regexp_replace(x, f"^{_TIME} ", ""))


def interval_of(text: str) -> Column:
    """First and last day that a date text may mean, as (first_day, last_day); null without a year or with an impossible day.

    A year alone is all its days, a month with a year all of the month, "14-16 September 2018" three days. The smallest and the
    largest number from 1 to 31 are the days, the last number above 1900 is the year.
    """
    value, month, days = F.col(text), month_of(text), days_of(F.col(text))
    year = last(years_of(value)).cast("string")

    def day(month, number):
        return F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"),
                        F.lpad(number.cast("string"), 2, "0")).try_cast("date")
    one = F.lit(1)
    # A number beside no month is no day: a year stands alone then.
    first = (F.when(month.isNull(), day(one, one)).when(F.size(days) == 0, day(month, one))
             .otherwise(day(month, F.array_min(days))))
    end = (F.when(month.isNull(), day(F.lit(12), F.lit(31))).when(F.size(days) == 0, F.last_day(day(month, one)))
           .otherwise(day(month, F.array_max(days))))
    return F.when(first.isNotNull() & end.isNotNull(), F.struct(first.alias("first_day"), end.alias("last_day")))


def month_name(month: Column) -> Column:
    """Full name of a month number."""
    return F.get(F.array(*[F.lit(m) for m in vocab.MONTHS]), month - 1)
