"""Text expressions: tokens, sentences, tags, lemmas and n-grams as array columns."""

from pyspark.sql import Column, functions as F

from gleaner.functions import vocab

# A word with inner hyphens, points or commas; a contraction ending; or one punctuation mark.
WORD = r"'\p{L}+|[\p{L}\p{N}]+(?:[.,-][\p{L}\p{N}]+)*|[^\s\p{L}\p{N}]"
TERM = WORD[:WORD.rindex("|")]  # no punctuation
SENTENCE = r"[^.!?\n]+[.!?]*"
# Marks that end no sentence are set aside as private characters while a text is split: (pattern, replacement).
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Mt", "Ft", "Gen", "Gov", "Sen", "Rep", "Sgt", "Capt", "Lt", "Col",
                 "Jr", "Sr", "Inc", "Corp", "vs", "approx", "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept",
                 "Oct", "Nov", "Dec")
MARKS, ASIDE = ".!?", "\ue000\ue001\ue002"


def kept_marks(abbreviations=ABBREVIATIONS) -> list[tuple[str, str]]:
    """(pattern, private character that follows group 1, whether group 2 follows) of marks inside a sentence.

    A mark before a letter or digit, the last point of an acronym, and the point of an abbreviation end no sentence.
    """
    inside = [(rf"()[{m}]([\p{{L}}\p{{N}}])", a) for m, a in zip(MARKS, ASIDE)]
    acronym = (rf"({ASIDE[0]}\p{{Lu}})[.]()", ASIDE[0])
    short = [(rf"((?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(abbreviations)}))[.]()", ASIDE[0])] if abbreviations else []
    return [*inside, acronym, *short]
NUMERIC = r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"
LETTER, DIGIT, WORD_CHARACTER, CAPITAL = r"\p{L}", r"\p{N}", r"[\p{L}\p{N}]", r"^\p{Lu}"


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern as an array."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def among(token: str, words) -> str:
    """SQL for whether the token is one of the words."""
    return f"{token} IN {_among(sorted(words))}" if words else "false"


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(words) -> str:
    return "(" + ", ".join(quote(w) for w in words) + ")"


# The word rules are SQL text, as one expression with a few hundred literals parses much faster than it is put together
# from Column objects. `token` and `text` are names of columns or lambda variables.

def _words(text, lowercase, pattern=WORD):
    plain = f"CASE WHEN contains({text}, '’') THEN replace({text}, '’', {quote(chr(39))}) ELSE {text} END"
    return f"regexp_extract_all({f'lower({plain})' if lowercase else plain}, {quote(pattern)}, 0)"


def _stop(token, stop, lowered):
    return f"{token if lowered else f'lower({token})'} IN {_among(stop)}"


def _content(text, stop, lowercase):
    # A word that is no punctuation has a letter or is made of numbers, so only the plain numbers are left to drop. These begin
    # with a digit, which sorts before the colon.
    number = f"(t < ':' AND rlike(t, {quote(NUMERIC)}))"
    return f"filter({_words(text, lowercase, TERM)}, t -> NOT {number} AND NOT ({_stop('t', stop, lowercase)}))"


def _tag(token, suffix_tags=None, default=vocab.DEFAULT_TAG):
    suffix_tags = vocab.SUFFIX_TAGS if suffix_tags is None else suffix_tags
    suffixes = " ".join(f"WHEN endswith({token}, {quote(s)}) THEN {quote(suffix_tags[s])}"
                        for s in sorted(suffix_tags, key=lambda s: (-len(s), s)))
    return (f"CASE WHEN NOT rlike({token}, {quote(WORD_CHARACTER)}) THEN {token} WHEN rlike({token}, '^[0-9]') THEN 'CD' "
            f"WHEN rlike({token}, {quote(CAPITAL)}) THEN 'NNP' {suffixes} ELSE {quote(default)} END")


def _lemma(token, tag, endings=None):
    endings = vocab.VERB_ENDINGS if endings is None else endings
    if not endings:
        return token
    verbs = _among([t for t, c in vocab.TAG_CLASSES.items() if c == "v"])
    cases = " ".join(f"WHEN endswith({token}, {quote(e)}) AND length({token}) >= {len(e) + 2} AND {tag} IN {verbs} "
                     f"THEN left({token}, length({token}) - {len(e)})"
                     for e in sorted(endings, key=lambda s: (-len(s), s)))
    return f"CASE {cases} ELSE {token} END"


def words(text: str = "text", lowercase: bool = True) -> Column:
    """Array of word tokens; typographic apostrophes become plain ones."""
    return F.expr(_words(text, lowercase))


def content_words_sql(text: str, stop, lowercase: bool = True) -> str:
    """SQL for the array of the words that are no punctuation, plain number or stop word."""
    return _content(text, stop, lowercase)


def content_words(text: str, stop, lowercase: bool = True) -> Column:
    """Array of the words that are no punctuation, plain number or stop word."""
    return F.expr(content_words_sql(text, stop, lowercase))


def content_lemmas(text: str, stop, lowercase: bool = True) -> Column:
    """Array of the lemmas of the content words, by rule."""
    found = _content(text, stop, lowercase)
    return F.expr(f"transform({found}, t -> {_lemma('t', _tag('t'))})")


def tagged_lemmas(text: str, stop, lowercase: bool = True) -> Column:
    """Array of (lemma, tag) of the content words, by rule."""
    found = _content(text, stop, lowercase)
    tagged = f"transform({found}, t -> named_struct('token', t, 'tag', {_tag('t')}))"
    return F.expr(f"transform({tagged}, x -> named_struct('lemma', {_lemma('x.token', 'x.tag')}, 'tag', x.tag))")


def rouge_words(text: str, stop=None, stem: bool = True, length: int = None) -> Column:
    """Array of the lowercase words, the first `length` only if given, without stop words, stemmed by rule."""
    out = f"filter({_words(text, True)}, t -> rlike(t, {quote(WORD_CHARACTER)}))"
    if length is not None:
        out = f"slice({out}, 1, {int(length)})"
    if stop:
        out = f"filter({out}, t -> NOT ({_stop('t', stop, True)}))"
    if stem:
        out = f"transform({out}, t -> {_lemma('t', _tag('t'))})"
    return F.expr(out)


def _aside(abbreviations) -> list[tuple[str, str]]:
    """(pattern, replacement) for the rules of `kept_marks`, the same places found from the mark, which is rare, by looking around.

    Abbreviations that are no plain words stay with the patterns of `kept_marks`: a look behind needs a known length.
    """
    inside, acronym, short = [(rf"[{m}](?=[\p{{L}}\p{{N}}])", a) for m, a in zip(MARKS, ASIDE)], kept_marks(())[-1], []
    if abbreviations and all(a.isalpha() for a in abbreviations):
        # U+10000 is a letter and changes nothing, but with it a look behind counts letters of two units as one.
        short = [(r"[.](?<=(?:^|[^\p{L}\p{N}" + "\U00010000" + rf"])(?:{'|'.join(abbreviations)})[.])", ASIDE[0])]
    elif abbreviations:
        short = [(kept_marks(abbreviations)[-1][0], f"$1{ASIDE[0]}")]
    return [*inside, (acronym[0], f"$1{acronym[1]}"), *short]


def split_sentences(text: Column, abbreviations=ABBREVIATIONS) -> Column:
    """Array of trimmed sentences; a mark ends one before anything but a letter or digit, unless it closes an abbreviation.

    The private characters U+E000 to U+E002 in a text come out as the marks that they stand for.
    """
    for pattern, replacement in _aside(abbreviations):
        text = F.regexp_replace(text, pattern, replacement)
    return F.transform(find_all(text, SENTENCE), lambda s: F.trim(F.translate(s, ASIDE, MARKS)))


def is_stop(token: str, stop, lowered: bool = False) -> Column:
    """Whether the lowercased token is in a list of stop words."""
    return F.expr(_stop(token, stop, lowered))


def is_numeric(token: str) -> Column:
    """Whether the token is digits with at most one point."""
    return F.expr(f"rlike({token}, {quote(NUMERIC)})")


def rule_tag(token: str, suffix_tags=None, default=vocab.DEFAULT_TAG) -> Column:
    """Part-of-speech tag by rule: punctuation is its own tag, then numbers, capitals, the longest suffix."""
    return F.expr(_tag(token, suffix_tags, default))


def rule_lemma(token: str, tag: str, endings=None) -> Column:
    """Lemma by rule: verbs lose a known ending when two letters remain; other words stay."""
    return F.expr(_lemma(token, tag, endings))


def pairs(items: Column) -> Column:
    """Neighbouring items joined by a space."""
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), n), F.slice(items, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def ngrams(items: Column, n: int) -> Column:
    """Runs of n neighbouring items joined by a space."""
    if n == 1:
        return items
    out = items
    for width in range(2, n + 1):
        count = F.greatest(F.size(items) - (width - 1), F.lit(0))
        out = F.zip_with(F.slice(out, F.lit(1), count), F.slice(items, F.lit(width), count),
                         lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def skip_pairs(items: Column, reach: int) -> Column:
    """Every item with each of the next `reach` items, joined by a space."""
    return F.flatten(F.transform(items, lambda x, i: F.transform(
        F.slice(items, i + 2, F.lit(reach)), lambda y: F.concat(x, F.lit(" "), y))))


def histogram(items: str) -> Column:
    """Array of (item, first): every occurrence once, `first` = 1 on one occurrence of each item.

    Exploding it gives total and per-row distinct counts from one aggregate, without grouping by row first.
    """
    return F.expr(f"zip_with(sort_array({items}), slice(concat(array(cast(NULL AS string)), sort_array({items})), 1, "
                  f"size({items})), (x, y) -> named_struct('item', x, 'first', if(x <=> y, 0, 1)))")
